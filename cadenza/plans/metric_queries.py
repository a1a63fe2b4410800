"""Driver-table queries: contingency, ARI/NMI, centroid profiles, inertia,
silhouette, classification report (C8, D8-D17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.operators import clusters, metrics
from cadenza.plans.registry import r6, register, t


def agreement_sql(ct_sql: str) -> str:
    """ARI and NMI from a contingency CTE body producing (u, v, n)."""
    return f"""
WITH ct AS ({ct_sql}),
a AS (SELECT u, sum(n) AS a FROM ct GROUP BY u),
b AS (SELECT v, sum(n) AS b FROM ct GROUP BY v),
tot AS (SELECT CAST(sum(n) AS DOUBLE) AS tot_n,
               sum(CAST(n AS DOUBLE) * (CAST(n AS DOUBLE) - 1.0) / 2.0) AS s_ij FROM ct),
sa AS (SELECT sum(CAST(a AS DOUBLE) * (CAST(a AS DOUBLE) - 1.0) / 2.0) AS s_a, count(*) AS k_u FROM a),
sb AS (SELECT sum(CAST(b AS DOUBLE) * (CAST(b AS DOUBLE) - 1.0) / 2.0) AS s_b, count(*) AS k_v FROM b),
hu AS (SELECT -sum(a / tot_n * ln(a / tot_n)) AS h_u FROM a, tot),
hv AS (SELECT -sum(b / tot_n * ln(b / tot_n)) AS h_v FROM b, tot),
mi AS (SELECT sum(ct.n / tot_n * (ln(ct.n) + ln(tot_n) - ln(a.a) - ln(b.b))) AS mi
       FROM ct JOIN a ON ct.u = a.u JOIN b ON ct.v = b.v, tot),
z AS (SELECT *, tot_n * (tot_n - 1.0) / 2.0 AS pairs, s_a * s_b / (tot_n * (tot_n - 1.0) / 2.0) AS ex,
             (s_a + s_b) / 2.0 AS mx,
             CASE WHEN k_u <= 1 OR k_v <= 1 THEN 0.0 ELSE greatest(coalesce(mi, 0.0), 0.0) END AS mic
      FROM tot, sa, sb, hu, hv, mi)
SELECT round(CASE WHEN coalesce(pairs, 0) = 0 THEN 1.0 WHEN mx = ex THEN 1.0
                  ELSE (s_ij - ex) / (mx - ex) END, 6) AS ari,
       round(CASE WHEN k_u = k_v AND k_u <= 1 THEN 1.0 WHEN mic = 0 THEN 0.0
                  ELSE mic / ((h_u + h_v) / 2.0) END, 6) AS nmi
FROM z
"""


def _cust_region(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = t(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    r = t(spark, sf, "region").select("r_regionkey", "r_name")
    return (c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
            .select(F.col("r_name").alias("cluster"), F.col("c_mktsegment").alias("class")))


_CUST_REGION_SQL = """SELECT r.r_name AS cluster, c.c_mktsegment AS class
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey"""


@register("crosstab_long", f"""
SELECT cluster, class, count(*) AS n FROM ({_CUST_REGION_SQL})
WHERE cluster IS NOT NULL AND class IS NOT NULL GROUP BY cluster, class
""")
def crosstab_long(spark, sf):
    return metrics.contingency(_cust_region(spark, sf), "cluster", "class")


@register("crosstab_pct", f"""
WITH ct AS (SELECT cluster, class, count(*) AS n FROM ({_CUST_REGION_SQL})
            WHERE cluster IS NOT NULL AND class IS NOT NULL GROUP BY cluster, class)
SELECT cluster, class, n, round(n * 100.0 / sum(n) OVER (PARTITION BY class), 6) AS pct FROM ct
""")
def crosstab_pct(spark, sf):
    ct = metrics.contingency(_cust_region(spark, sf), "cluster", "class")
    return metrics.contingency_pct(ct, "cluster", "class").withColumn("pct", r6("pct"))


_FLAGS_CT = ("SELECT l_returnflag AS u, l_linestatus AS v, count(*) AS n FROM lineitem "
             "WHERE l_returnflag IS NOT NULL AND l_linestatus IS NOT NULL GROUP BY 1, 2")


@register("ari_nmi", agreement_sql(_FLAGS_CT))
def ari_nmi(spark, sf):
    li = t(spark, sf, "lineitem")
    res = metrics.cluster_agreement(li, "l_returnflag", "l_linestatus")
    return res.select(r6("ari").alias("ari"), r6("nmi").alias("nmi"))


_CROSSTAB_AGREEMENT_CT = (f"SELECT cluster AS u, class AS v, count(*) AS n FROM ({_CUST_REGION_SQL}) "
                          "WHERE cluster IS NOT NULL AND class IS NOT NULL GROUP BY 1, 2")


@register("ari_nmi_segments", agreement_sql(_CROSSTAB_AGREEMENT_CT))
def ari_nmi_segments(spark, sf):
    res = metrics.cluster_agreement(_cust_region(spark, sf), "cluster", "class")
    return res.select(r6("ari").alias("ari"), r6("nmi").alias("nmi"))


# ---- embeddings: cluster = nearest class mean ---------------------------------

_EMB_NEAREST = """
e AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x,
             generate_subscripts(embedding, 1) AS i FROM embeddings),
cm AS (SELECT label AS c, i, avg(x) AS m FROM e GROUP BY label, i),
dd AS (SELECT e.vec_id, cm.c, sum((e.x - cm.m) * (e.x - cm.m)) AS d2
       FROM e JOIN cm ON e.i = cm.i GROUP BY e.vec_id, cm.c),
asg AS (SELECT vec_id, arg_min(c, d2) AS cluster, min(d2) AS d2 FROM dd GROUP BY vec_id)"""


def _nearest(spark, sf):
    emb = t(spark, sf, "embeddings")
    cents = clusters.collect_centroids(clusters.group_means(emb, "label", "embedding"), "label")
    return clusters.assign_nearest(emb, "embedding", cents)


@register("cluster_eval", agreement_sql(
    f"WITH {_EMB_NEAREST.strip()} SELECT a.cluster AS u, e.label AS v, count(*) AS n "
    "FROM asg a JOIN embeddings e ON a.vec_id = e.vec_id GROUP BY 1, 2"))
def cluster_eval(spark, sf):
    res = metrics.cluster_agreement(_nearest(spark, sf), "cluster", "label")
    return res.select(r6("ari").alias("ari"), r6("nmi").alias("nmi"))


@register("cluster_profiles", f"""
WITH {_EMB_NEAREST.strip()}
SELECT asg.cluster, e.i - 1 AS dim, round(avg(e.x), 6) AS mean
FROM e JOIN asg ON e.vec_id = asg.vec_id GROUP BY asg.cluster, e.i
""")
def cluster_profiles(spark, sf):
    prof = clusters.cluster_profiles(_nearest(spark, sf), "cluster", "embedding")
    return prof.select("cluster", "dim", r6("mean").alias("mean"))


@register("inertia", f"""
WITH {_EMB_NEAREST.strip()}
SELECT count(*) AS n, round(sum(d2), 6) AS inertia FROM asg
""")
def inertia(spark, sf):
    res = clusters.inertia(_nearest(spark, sf))
    return res.select("n", r6("inertia").alias("inertia"))


@register("silhouette", """
WITH e AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x,
                  generate_subscripts(embedding, 1) AS i FROM embeddings),
d AS (SELECT p.vec_id AS va, p.label AS la, q.label AS lb,
             sqrt(sum((p.x - q.x) * (p.x - q.x))) AS dist
      FROM e p JOIN e q ON p.i = q.i GROUP BY p.vec_id, p.label, q.vec_id, q.label),
m AS (SELECT va, la, lb, sum(dist) AS s, count(*) AS c FROM d GROUP BY va, la, lb),
r AS (SELECT va, max(CASE WHEN lb = la AND c > 1 THEN s / (c - 1) END) AS a,
             max(CASE WHEN lb = la THEN c END) AS n_own,
             min(CASE WHEN lb <> la THEN s / c END) AS b FROM m GROUP BY va)
SELECT round(avg(CASE WHEN n_own <= 1 OR b IS NULL THEN 0.0
                      ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM r
""")
def silhouette(spark, sf):
    emb = t(spark, sf, "embeddings")
    res = metrics.silhouette(emb, "vec_id", "label", "embedding")
    return res.select(r6("silhouette").alias("silhouette"))


@register("silhouette_squared", """
WITH e AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x,
                  generate_subscripts(embedding, 1) AS i FROM embeddings),
d AS (SELECT p.vec_id AS va, p.label AS la, q.label AS lb,
             sum((p.x - q.x) * (p.x - q.x)) AS dist
      FROM e p JOIN e q ON p.i = q.i GROUP BY p.vec_id, p.label, q.vec_id, q.label),
m AS (SELECT va, la, lb, sum(dist) AS s, count(*) AS c FROM d GROUP BY va, la, lb),
r AS (SELECT va, max(CASE WHEN lb = la AND c > 1 THEN s / (c - 1) END) AS a,
             max(CASE WHEN lb = la THEN c END) AS n_own,
             min(CASE WHEN lb <> la THEN s / c END) AS b FROM m GROUP BY va)
SELECT round(avg(CASE WHEN n_own <= 1 OR b IS NULL THEN 0.0
                      ELSE (b - a) / greatest(a, b) END), 6) AS silhouette_squared FROM r
""")
def silhouette_squared(spark, sf):
    """The linear-time variant: squared distances, its own name."""
    emb = clusters.to_vector(t(spark, sf, "embeddings"), "embedding").withColumn("label", F.col("label").cast("double"))
    score = metrics.silhouette_squared(emb, "label", "features")
    return spark.createDataFrame([(round(score, 6),)], "silhouette_squared double")


# ---- classification: labels.quality as truth, labels.toxic as prediction -------

_TP = "SELECT CAST(quality AS VARCHAR) AS t, CAST(toxic AS VARCHAR) AS p FROM labels"


def _truth_pred(spark, sf):
    lab = t(spark, sf, "labels")
    return lab.select(F.col("quality").cast("string").alias("t"),
                      F.col("toxic").cast("string").alias("p"))


@register("confusion_report", f"""
WITH x AS ({_TP}),
cls AS (SELECT t AS label FROM x UNION SELECT p FROM x),
sup AS (SELECT t AS label, count(*) AS support FROM x GROUP BY t),
np AS (SELECT p AS label, count(*) AS n_pred FROM x GROUP BY p),
tp AS (SELECT t AS label, count(*) AS tp FROM x WHERE t = p GROUP BY t),
s AS (SELECT c.label, coalesce(sup.support, 0) AS support, coalesce(np.n_pred, 0) AS n_pred,
             coalesce(tp.tp, 0) AS tp
      FROM cls c LEFT JOIN sup ON c.label = sup.label LEFT JOIN np ON c.label = np.label
      LEFT JOIN tp ON c.label = tp.label),
pc AS (SELECT label, CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS precision,
              CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall, support, tp FROM s),
f AS (SELECT *, CASE WHEN precision + recall > 0
                     THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM pc),
tot AS (SELECT CAST(sum(support) AS BIGINT) AS n, sum(tp) AS tp, avg(precision) AS mp,
               avg(recall) AS mr, avg(f1) AS mf, sum(precision * support) AS wp,
               sum(recall * support) AS wr, sum(f1 * support) AS wf FROM f)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(tp / n, 6), n FROM tot
UNION ALL SELECT 'macro avg', round(mp, 6), round(mr, 6), round(mf, 6), n FROM tot
UNION ALL SELECT 'weighted avg', round(wp / n, 6), round(wr / n, 6), round(wf / n, 6), n FROM tot
""")
def confusion_report(spark, sf):
    rep = metrics.classification_report(_truth_pred(spark, sf), "t", "p")
    return rep.select("label", r6("precision").alias("precision"), r6("recall").alias("recall"),
                      r6("f1").alias("f1"), "support")


@register("balanced_accuracy", f"""
WITH x AS ({_TP})
SELECT round(avg(CASE WHEN t = p THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       round((SELECT avg(r) FROM (SELECT avg(CASE WHEN t = p THEN 1.0 ELSE 0.0 END) AS r
                                 FROM x GROUP BY t)), 6) AS balanced_accuracy
FROM x
""")
def balanced_accuracy(spark, sf):
    res = metrics.accuracy_scores(_truth_pred(spark, sf), "t", "p")
    return res.select(r6("accuracy").alias("accuracy"),
                      r6("balanced_accuracy").alias("balanced_accuracy"))


@register("crosstab_wide", """
SELECT lang, count(*) FILTER (WHERE quality = 0) AS q0, count(*) FILTER (WHERE quality = 1) AS q1
FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY lang
""")
def crosstab_wide(spark, sf):
    """The contingency table with one column a class."""
    j = t(spark, sf, "documents").select("doc_id", "lang").join(t(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    wide = metrics.contingency_wide(metrics.contingency(j, "lang", "quality"), "lang", "quality", [0, 1])
    return wide.select("lang", F.col("0").alias("q0"), F.col("1").alias("q1"))
