"""Driver-table queries: EDA summaries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from cadenza.operators import moments, profile
from cadenza.plans.registry import r6, register, t

FEATS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
BOX_FEATS = ["l_quantity", "l_extendedprice"]


def _pairs():
    return [(a, b) for i, a in enumerate(FEATS) for b in FEATS[i + 1:]]


@register("corr_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
    for a, b in _pairs()))
def corr_matrix(spark, sf):
    c = profile.corr_matrix(t(spark, sf, "lineitem"), FEATS)
    return c.select("feature_a", "feature_b", r6("corr").alias("corr"))


@register("box_summary", " UNION ALL ".join(
    f"""SELECT l_returnflag, '{f}' AS feature, round(min({f}), 6) AS min,
       round(quantile_cont({f}, 0.25), 6) AS q1, round(quantile_cont({f}, 0.5), 6) AS median,
       round(quantile_cont({f}, 0.75), 6) AS q3, round(max({f}), 6) AS max,
       round(quantile_cont({f}, 0.25) - 1.5 * (quantile_cont({f}, 0.75) - quantile_cont({f}, 0.25)), 6) AS lower,
       round(quantile_cont({f}, 0.75) + 1.5 * (quantile_cont({f}, 0.75) - quantile_cont({f}, 0.25)), 6) AS upper
    FROM lineitem GROUP BY l_returnflag""" for f in BOX_FEATS))
def box_summary(spark, sf):
    b = profile.box_summary(t(spark, sf, "lineitem"), "l_returnflag", BOX_FEATS)
    return b.select("l_returnflag", "feature",
                    *[r6(c).alias(c) for c in ["min", "q1", "median", "q3", "max", "lower", "upper"]])


@register("class_profile", f"""
SELECT l_returnflag, count(*) AS n, {", ".join(f"round(avg({f}), 6) AS mean_{f}" for f in FEATS)}
FROM lineitem GROUP BY l_returnflag
""")
def class_profile(spark, sf):
    p = profile.class_profile(t(spark, sf, "lineitem"), "l_returnflag", FEATS)
    return p.select("l_returnflag", "n", *[r6(f"mean_{f}").alias(f"mean_{f}") for f in FEATS])


@register("class_variance", " UNION ALL ".join(
    f"SELECT l_returnflag, '{f}' AS feature, round(var_pop({f}), 6) AS var_pop "
    f"FROM lineitem GROUP BY l_returnflag" for f in FEATS))
def class_variance(spark, sf):
    v = profile.class_variance(t(spark, sf, "lineitem"), "l_returnflag", FEATS)
    return v.select("l_returnflag", "feature", r6("var_pop").alias("var_pop"))


@register("variance_split", " UNION ALL ".join(
    f"""SELECT '{f}' AS feature, round(avg(v), 6) AS within_var, round(var_pop(m), 6) AS between_var
    FROM (SELECT var_pop({f}) AS v, avg({f}) AS m FROM lineitem GROUP BY l_returnflag)"""
    for f in FEATS))
def variance_split(spark, sf):
    v = profile.variance_split(t(spark, sf, "lineitem"), "l_returnflag", FEATS)
    return v.select("feature", r6("within_var").alias("within_var"),
                    r6("between_var").alias("between_var"))


@register("top_bottom", """
WITH m AS (SELECT o_custkey, avg(o_totalprice) AS mean FROM orders GROUP BY o_custkey),
tp AS (SELECT 'top' AS side, row_number() OVER (ORDER BY mean DESC, o_custkey) AS rank, o_custkey, mean FROM m),
bt AS (SELECT 'bottom' AS side, row_number() OVER (ORDER BY mean ASC, o_custkey) AS rank, o_custkey, mean FROM m)
SELECT side, rank, o_custkey, round(mean, 6) AS mean FROM tp WHERE rank <= 5
UNION ALL SELECT side, rank, o_custkey, round(mean, 6) AS mean FROM bt WHERE rank <= 5
""")
def top_bottom(spark, sf):
    tb = profile.top_bottom(t(spark, sf, "orders"), "o_custkey", "o_totalprice", 5)
    return tb.select("side", F.col("rank").cast("long").alias("rank"), "o_custkey",
                     r6("mean").alias("mean"))


@register("dataset_totals", """
SELECT count(DISTINCT source) AS n_groups, count(*) AS n_rows FROM documents
""")
def dataset_totals(spark, sf):
    return profile.totals(t(spark, sf, "documents"), "source")


@register("corr_vectors", """
WITH x AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)
SELECT CAST(a.i AS INTEGER) AS feature_a, CAST(b.i AS INTEGER) AS feature_b, round(corr(a.v, b.v), 6) AS corr
FROM x a JOIN x b ON a.vec_id = b.vec_id AND a.i < b.i GROUP BY ALL
""")
def corr_vectors(spark, sf):
    """Correlations of all pairs of embedding components from shared scans."""
    c = moments.correlations(t(spark, sf, "embeddings"), "embedding")
    i, j = np.triu_indices(len(c), 1)
    return spark.createDataFrame(list(zip(i.tolist(), j.tolist(), [round(float(x), 6) for x in c[i, j]])),
                                 "feature_a int, feature_b int, corr double")
