"""Driver-table queries: class support, weights, balance, split, spread sample
(B11, C7, D4-D6, D18, E5-E7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.functions.vocab import SEED
from cadenza.operators import sampling
from cadenza.plans.registry import r6, register, sql_hash, t

_CLASS_SQL = "'q' || CAST(l.quality AS VARCHAR) || '_t' || CAST(l.toxic AS VARCHAR)"
_LABELLED_SQL = f"SELECT d.doc_id, {_CLASS_SQL} AS class FROM documents d JOIN labels l ON d.doc_id = l.doc_id"


def _labelled_docs(spark, sf):
    docs = t(spark, sf, "documents").select("doc_id")
    lab = t(spark, sf, "labels")
    cls = F.concat(F.lit("q"), F.col("quality").cast("string"),
                   F.lit("_t"), F.col("toxic").cast("string"))
    return docs.join(lab, "doc_id").select("doc_id", cls.alias("class"))


@register("class_counts", f"SELECT class, count(*) AS n FROM ({_LABELLED_SQL}) GROUP BY class")
def class_counts(spark, sf):
    return sampling.class_counts(_labelled_docs(spark, sf), "class")


@register("class_summary", f"""
WITH c AS (SELECT class, count(*) AS n FROM ({_LABELLED_SQL}) WHERE class IS NOT NULL GROUP BY class)
SELECT count(*) AS n_classes, CAST(floor(quantile_cont(n, 0.5)) AS BIGINT) AS cap,
       min(n) AS min_n, max(n) AS max_n, round(max(n) / min(n), 6) AS imbalance FROM c
""")
def class_summary(spark, sf):
    s = sampling.class_summary(_labelled_docs(spark, sf), "class")
    return s.withColumn("imbalance", r6("imbalance"))


@register("support_filter", f"""
WITH x AS ({_LABELLED_SQL}), c AS (SELECT class FROM x GROUP BY class HAVING count(*) >= 30)
SELECT x.doc_id, x.class FROM x WHERE x.class IN (SELECT class FROM c)
""")
def support_filter(spark, sf):
    return sampling.support_filter(_labelled_docs(spark, sf), "class", 30)


@register("dropped_classes", f"""
SELECT class, count(*) AS n FROM ({_LABELLED_SQL}) GROUP BY class HAVING count(*) < 30
""")
def dropped_classes(spark, sf):
    return sampling.dropped_classes(_labelled_docs(spark, sf), "class", 30)


@register("class_weights", f"""
WITH x AS ({_LABELLED_SQL}), c AS (SELECT class, count(*) AS nc FROM x GROUP BY class),
tot AS (SELECT sum(nc) AS n, count(*) AS k FROM c)
SELECT x.doc_id, x.class, round(tot.n / (tot.k * c.nc), 6) AS weight
FROM x JOIN c ON x.class = c.class CROSS JOIN tot
""")
def class_weights(spark, sf):
    w = sampling.class_weights(_labelled_docs(spark, sf), "class")
    return w.select("doc_id", "class", r6("weight").alias("weight"))


@register("balance_classes", f"""
WITH d AS (SELECT doc_id, lang FROM documents WHERE lang IS NOT NULL),
c AS (SELECT lang, count(*) AS n FROM d GROUP BY lang),
cap AS (SELECT floor(quantile_cont(n, 0.5)) AS cap FROM c),
r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {sql_hash(SEED, 'doc_id')}) AS rn FROM d)
SELECT r.doc_id, r.lang FROM r, cap WHERE r.rn <= cap.cap
""")
def balance_classes(spark, sf):
    docs = t(spark, sf, "documents").select("doc_id", "lang")
    return sampling.balance_classes(docs, "lang", "doc_id", SEED)


@register("stratified_split", f"""
WITH c AS (SELECT label, count(*) AS nc FROM embeddings GROUP BY label),
tt AS (SELECT sum(nc) AS n FROM c),
q0 AS (SELECT label, nc, n, n - ceil(CAST(0.2 AS DOUBLE) * n) AS n_train FROM c, tt),
q1 AS (SELECT *, CAST(nc AS DOUBLE) / n * n_train AS ex FROM q0),
q2 AS (SELECT *, floor(ex) AS fl, ex - floor(ex) AS rem FROM q1),
q3 AS (SELECT *, n_train - sum(fl) OVER () AS lft,
              row_number() OVER (ORDER BY rem DESC, label) AS r FROM q2),
q AS (SELECT label, nc - (fl + CASE WHEN r <= lft THEN 1 ELSE 0 END) AS quota FROM q3),
rk AS (SELECT vec_id, label,
              row_number() OVER (PARTITION BY label ORDER BY {sql_hash(SEED, 'vec_id')}) AS rn
       FROM embeddings)
SELECT rk.vec_id, rk.label, CASE WHEN rk.rn <= q.quota THEN 'test' ELSE 'train' END AS split
FROM rk JOIN q ON rk.label = q.label
""")
def stratified_split(spark, sf):
    emb = t(spark, sf, "embeddings").select("vec_id", "label")
    return sampling.stratified_split(emb, "label", "vec_id", 0.2, SEED)


@register("split_sizes", f"""
WITH c AS (SELECT label, count(*) AS nc FROM embeddings GROUP BY label),
tt AS (SELECT sum(nc) AS n FROM c),
q0 AS (SELECT label, nc, n, n - ceil(CAST(0.2 AS DOUBLE) * n) AS n_train FROM c, tt),
q1 AS (SELECT *, CAST(nc AS DOUBLE) / n * n_train AS ex FROM q0),
q2 AS (SELECT *, floor(ex) AS fl, ex - floor(ex) AS rem FROM q1),
q3 AS (SELECT *, n_train - sum(fl) OVER () AS lft,
              row_number() OVER (ORDER BY rem DESC, label) AS r FROM q2)
SELECT label, nc AS n, CAST(nc - (fl + CASE WHEN r <= lft THEN 1 ELSE 0 END) AS BIGINT) AS quota FROM q3
""")
def split_sizes(spark, sf):
    emb = t(spark, sf, "embeddings").select("vec_id", "label")
    q = sampling.split_quotas(emb, "label", 0.2)
    n = emb.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    return n.join(q, "label").select("label", "n", "quota")


@register("spread_sample", f"""
WITH r AS (SELECT p_partkey, p_type, p_brand,
                  row_number() OVER (PARTITION BY p_type, p_brand
                                     ORDER BY {sql_hash(SEED, 'p_partkey')}, p_partkey) AS pick_rank
           FROM part WHERE p_type IS NOT NULL)
SELECT p_partkey, p_type, p_brand, pick_rank FROM r WHERE pick_rank <= 2
ORDER BY {sql_hash(SEED, 'p_type')}, p_type, p_brand, pick_rank LIMIT 100
""")
def spread_sample(spark, sf):
    part = t(spark, sf, "part").select("p_partkey", "p_type", "p_brand")
    s = sampling.spread_sample(part, "p_type", "p_brand", "p_partkey", 100, 2, SEED)
    return s.select("p_partkey", "p_type", "p_brand", "pick_rank")
