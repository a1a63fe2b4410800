"""Driver-table queries: fences, outlier filter, scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.operators import clean
from cadenza.plans.registry import r6, register, t

LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
EVENT_FEATURES = ["value", "user_id"]
# keys and one measure dropped before scaling (B1); the rest are picked by dtype (B2)
LINE_DROP = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_tax"]


def _fence_sql(table: str, feats: list[str], t_: float = 1.5) -> str:
    parts = []
    for f in feats:
        parts.append(
            f"SELECT '{f}' AS feature, quantile_cont({f}, 0.25) AS q1, "
            f"quantile_cont({f}, 0.75) AS q3 FROM {table}")
    u = " UNION ALL ".join(parts)
    return (f"SELECT feature, q1, q3, q3 - q1 AS iqr, q1 - {t_} * (q3 - q1) AS lower, "
            f"q3 + {t_} * (q3 - q1) AS upper FROM ({u})")


@register("iqr_fences", f"""
SELECT feature, round(q1, 6) AS q1, round(q3, 6) AS q3, round(iqr, 6) AS iqr,
       round(lower, 6) AS lower, round(upper, 6) AS upper
FROM ({_fence_sql('lineitem', LINE_FEATURES)})
""")
def iqr_fences(spark, sf):
    f = clean.iqr_fences(t(spark, sf, "lineitem"), LINE_FEATURES)
    return f.select("feature", *[r6(c).alias(c) for c in ["q1", "q3", "iqr", "lower", "upper"]])


def _keep_sql(feats):
    conds = [f"(e.{f} IS NULL OR (e.{f} >= (SELECT lower FROM fe WHERE feature = '{f}') "
             f"AND e.{f} <= (SELECT upper FROM fe WHERE feature = '{f}')))" for f in feats]
    return " AND ".join(conds)


@register("iqr_filter", f"""
WITH fe AS ({_fence_sql('events', EVENT_FEATURES)})
SELECT e.event_id, e.event_type, e.value FROM events e WHERE {_keep_sql(EVENT_FEATURES)}
""")
def iqr_filter(spark, sf):
    ev = t(spark, sf, "events")
    return clean.remove_outliers(ev, EVENT_FEATURES).select("event_id", "event_type", "value")


@register("outlier_report", f"""
WITH fe AS ({_fence_sql('documents', ['n_chars'])}),
k AS (SELECT count(*) AS n_total,
             count(*) FILTER (WHERE NOT {_keep_sql(['n_chars'])}) AS n_outliers
      FROM documents e)
SELECT n_total, n_outliers,
       round(CASE WHEN n_total = 0 THEN 0.0 ELSE n_outliers * 100.0 / n_total END, 6) AS pct_outliers
FROM k
""")
def outlier_report(spark, sf):
    rep = clean.outlier_report(t(spark, sf, "documents"), ["n_chars"])
    return rep.select("n_total", "n_outliers", r6("pct_outliers").alias("pct_outliers"))


def _scale_features(df):
    return clean.numeric_columns(clean.drop_features(df, LINE_DROP))


SCALED = ["l_quantity", "l_extendedprice", "l_discount"]   # what the dtype pick yields


def _stats_sql():
    parts = [f"SELECT '{f}' AS feature, avg({f}) AS mean, stddev_pop({f}) AS std FROM lineitem"
             for f in SCALED]
    return " UNION ALL ".join(parts)


@register("scale_stats", f"""
SELECT feature, round(mean, 6) AS mean, round(std, 6) AS std FROM ({_stats_sql()})
""")
def scale_stats(spark, sf):
    li = t(spark, sf, "lineitem")
    st = clean.feature_stats(li, _scale_features(li))
    return st.select("feature", r6("mean").alias("mean"), r6("std").alias("std"))


def _z_sql(f):
    return (f"round(({f} - (SELECT mean FROM s WHERE feature = '{f}')) / "
            f"(SELECT CASE WHEN std = 0 THEN 1 ELSE std END FROM s WHERE feature = '{f}'), 6) AS z_{f}")


@register("scale_features", f"""
WITH s AS ({_stats_sql()})
SELECT l_orderkey, l_linenumber, {", ".join(_z_sql(f) for f in SCALED)} FROM lineitem
""")
def scale_features(spark, sf):
    li = t(spark, sf, "lineitem")
    feats = _scale_features(li)
    scaled, _ = clean.scale(li, feats, suffix="__z")
    return scaled.select("l_orderkey", "l_linenumber",
                         *[r6(f + "__z").alias("z_" + f) for f in feats])


@register("scale_inverse", f"""
SELECT l_orderkey, l_linenumber, {", ".join(f"round({f}, 6) AS {f}" for f in SCALED)} FROM lineitem
""")
def scale_inverse(spark, sf):
    li = t(spark, sf, "lineitem")
    feats = _scale_features(li)
    z, stats = clean.scale(li.select("l_orderkey", "l_linenumber", *feats), feats)
    back = clean.inverse_scale(z, feats, stats)
    return back.select("l_orderkey", "l_linenumber", *[r6(f).alias(f) for f in feats])
