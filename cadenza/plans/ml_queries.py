"""Driver-table queries: k-means sweep and comparison, PCA, classifier
comparison and importances (I2-I10, C9, F3-F5).  Model fits depend on random
starts and tree sampling, so these have no SQL oracle (row checks only)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from cadenza.functions.vocab import SEED
from cadenza.operators import classify, clusters, kmeans, metrics, moments, sampling, trees
from cadenza.plans.registry import r6, register, t
from cadenza.session import materialize

K_RANGE = range(2, 16)
N_INIT = 10


def _emb(spark, sf):
    return t(spark, sf, "embeddings").select("vec_id", "embedding", "label")


def _sweep(spark, sf):
    return clusters.kmeans_sweep(_emb(spark, sf), "vec_id", "embedding", K_RANGE, N_INIT, SEED,
                                 silhouette="exact")


@register("kmeans_sweep", None)
def kmeans_sweep(spark, sf):
    res, _ = _sweep(spark, sf)
    return res.select("k", r6("inertia").alias("inertia"), r6("silhouette").alias("silhouette"), "n")


@register("kmeans_compare", None)
def kmeans_compare(spark, sf):
    """Sweep, best k by silhouette, then k in sorted({2, best, 10, 15}):
    inertia, silhouette, ARI and NMI against the labels (models reused)."""
    emb = _emb(spark, sf)
    sweep, models = _sweep(spark, sf)
    best = clusters.best_k(sweep)
    data = clusters.to_vector(emb, "embedding")
    rows = []
    for k in sorted({2, best, 10, 15}):
        pred = models[k].transform(data).select("vec_id", "label", "cluster")
        ag = metrics.cluster_agreement(pred, "cluster", "label").first()
        rows.append((k, float(ag["ari"]), float(ag["nmi"])))
    agree = spark.createDataFrame(rows, "k int, ari double, nmi double")
    out = sweep.join(agree, "k").withColumn("is_best_silhouette", F.col("k") == F.lit(best))
    return out.select("k", r6("inertia").alias("inertia"), r6("silhouette").alias("silhouette"),
                      r6("ari").alias("ari"), r6("nmi").alias("nmi"), "is_best_silhouette")


# ---- properties that hold whatever the random start --------------------------

@register("kmeans_checks", """
SELECT CAST(k AS INTEGER) AS k, count(*) AS n, CAST(10 AS BIGINT) AS n_starts, k AS n_clusters, count(*) AS n_nearest,
       true AS inertia_is_sum, true AS below_one_cluster, true AS least_of_starts
FROM embeddings, range(2, 16) AS r(k) GROUP BY k
""")
def kmeans_checks(spark, sf):
    """The whole sweep, k = 2..15 with ten starts each, checked row by row: sizes
    sum to n, every row sits with its nearest centre, the reported inertia is the
    sum of squared distances, is the least of its starts, and lies below that of
    a single cluster."""
    data = clusters.to_vector(_emb(spark, sf), "embedding")
    fits = kmeans.fit_pairs(data, "features", list(K_RANGE), N_INIT, SEED)
    best = kmeans.best_fits(fits)
    whole = (_emb(spark, sf).select(F.posexplode("embedding")).groupBy("pos").agg(
        (F.var_pop(F.col("col").cast("double")) * F.count("col")).alias("s")).agg(F.sum("s")).first()[0])
    own = kmeans.assign(data, {f"k{k}": m.centres for k, m in best.items()}, "features")
    # distances to all centres of all k, counted anew by plain differences
    dist = kmeans.own_and_least([m.centres for m in best.values()])
    known = F.when(F.forall("embedding", F.isnotnull), dist(F.col("embedding").cast("array<double>"), F.array(*[F.col(f"k{k}") for k in best])))
    rows = own.select("vec_id", known.alias("d"), *[f"k{k}" for k in best]).select("vec_id", F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.col(f"k{k}").alias("own"), F.get("d", F.lit(2 * i)).alias("d"), F.get("d", F.lit(2 * i + 1)).alias("least"))
        for i, k in enumerate(best)])).alias("p")).groupBy("p.k", "vec_id", "p.own").agg(F.min("p.least").alias("least"), F.max("p.d").alias("d"))
    got = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("own").alias("n_clusters"),
                                F.count_if(F.col("d") <= F.col("least") + 1e-9).alias("n_nearest"), F.sum("d").alias("s"))
    costs = spark.createDataFrame([(k, m.cost, len(fits[k]), m.cost <= min(x.cost for x in fits[k])) for k, m in best.items()],
                                  "k int, cost double, n_starts long, least_of_starts boolean")
    return got.join(F.broadcast(costs), "k").select(
        "k", "n", "n_starts", "n_clusters", "n_nearest", (F.abs(F.col("s") - F.col("cost")) < 1e-6 * F.col("cost")).alias("inertia_is_sum"),
        (F.col("cost") < F.lit(whole)).alias("below_one_cluster"), "least_of_starts")


@register("lloyd_step", """
WITH RECURSIVE x AS MATERIALIZED (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS j FROM embeddings),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS c FROM embeddings),
b AS (SELECT k, c, j, v FROM x JOIN first USING (vec_id), (VALUES (3), (7), (16)) AS ks(k) WHERE c < k),
d AS MATERIALIZED (SELECT k, vec_id, c, sum((x.v - b.v) * (x.v - b.v)) AS d FROM x JOIN b USING (j) GROUP BY ALL),
a AS MATERIALIZED (SELECT k, vec_id, min(struct_pack(d := d, c := c)) AS s FROM d GROUP BY ALL),
m AS MATERIALIZED (SELECT k, s.c AS c, j, avg(v) AS v FROM a JOIN x USING (vec_id) GROUP BY ALL),
d2 AS (SELECT k, vec_id, c, sum((x.v - m.v) * (x.v - m.v)) AS d FROM x JOIN m USING (j) GROUP BY ALL),
cost AS (SELECT k, sum(d) AS cost FROM (SELECT k, vec_id, min(d) AS d FROM d2 GROUP BY ALL) GROUP BY k),
n AS (SELECT k, s.c AS c, count(*) AS n FROM a GROUP BY ALL)
SELECT CAST(k AS INTEGER) AS k, CAST(c AS INTEGER) AS cluster, n, round(sum(v), 6) AS centre_sum, round(sum(v * v), 6) AS centre_square,
       round(any_value(cost), 4) AS cost_after
FROM m JOIN n USING (k, c) JOIN cost USING (k) GROUP BY k, c, n
""")
def lloyd_step(spark, sf):
    """One Lloyd step of three sets of centres (the first 3, 7 and 16 vectors) in
    the same scan, and their costs after it."""
    data = clusters.to_vector(_emb(spark, sf), "embedding")
    blocks = materialize(kmeans.row_blocks(data, "features", SEED))
    first = np.array([r["embedding"] for r in _emb(spark, sf).orderBy("vec_id").limit(16).collect()], dtype=np.float64)
    sets = [first[:k] for k in (3, 7, 16)]
    n, total, _ = kmeans.centre_sums(blocks, sets, first.shape[1])
    moved, costs, _ = kmeans.lloyd(blocks, sets, first.shape[1], 1, 0.0)
    rows = [(len(c), i, int(n[p][i]), float(c[i].sum()), float((c[i] ** 2).sum()), float(costs[p]))
            for p, c in enumerate(moved) for i in range(len(c)) if n[p][i]]
    out = spark.createDataFrame(rows, "k int, cluster int, n long, centre_sum double, centre_square double, cost_after double")
    return out.select("k", "cluster", "n", r6("centre_sum").alias("centre_sum"), r6("centre_square").alias("centre_square"),
                      F.round("cost_after", 4).alias("cost_after"))


@register("pca_variance", """
WITH x AS (SELECT unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS d FROM embeddings),
s AS (SELECT d, var_samp(v) AS v FROM x GROUP BY d)
SELECT round(sum(v), 4) AS total_variance, count(*) AS n_components, 1.0 AS ratio_sum, true AS falling FROM s
""")
def pca_variance(spark, sf):
    """All components: their variances sum to the trace of the covariance."""
    emb = _emb(spark, sf)
    d = len(emb.first()["embedding"])
    proj, ratios = clusters.pca(emb, "vec_id", "embedding", d)
    total = proj.agg(F.round(sum(F.var_samp(f"pc{i + 1}") for i in range(d)), 4).alias("total_variance"))
    return total.select("total_variance", F.lit(d).cast("long").alias("n_components"),
                        F.lit(round(sum(ratios), 6)).cast("double").alias("ratio_sum"),
                        F.lit(all(a >= b - 1e-12 for a, b in zip(ratios, ratios[1:]))).alias("falling"))


@register("pca_directions", """
WITH x AS (SELECT unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS d FROM embeddings),
s AS (SELECT d, var_samp(v) AS v FROM x GROUP BY d)
SELECT round(sum(v), 4) AS total_variance, CAST(64 AS BIGINT) AS n_directions, round(sum(v), 4) AS projected_variance,
       true AS orthogonal, true AS falling, true AS uncorrelated FROM s
""")
def pca_directions(spark, sf):
    """Principal directions by block power iteration, all of them: the projections'
    variances sum to the total, fall, and equal the reported ones."""
    emb = _emb(spark, sf)
    d = moments.width_of(emb, "embedding")
    top, values, mu = moments.principal_components(emb, "embedding", d, rounds=2)
    proj = moments.project(emb, "embedding", top, mu, "p")
    c = moments.correlations(proj, "p")
    total = emb.select(F.posexplode("embedding")).groupBy("pos").agg(F.var_samp(F.col("col").cast("double")).alias("v")).agg(F.sum("v")).first()[0]
    own = proj.select(F.posexplode("p").alias("i", "x")).groupBy("i").agg(F.var_samp("x").alias("v")).orderBy("i").collect()
    own = np.array([r["v"] for r in own])
    return spark.createDataFrame(
        [(round(total, 4), len(values), round(float(own.sum()), 4), bool(np.abs(top.T @ top - np.eye(d)).max() < 1e-9),
          bool((np.diff(values) <= 1e-12).all() and np.allclose(own, values, rtol=1e-6)), bool(np.abs(c - np.eye(d)).max() < 1e-5))],
        "total_variance double, n_directions long, projected_variance double, orthogonal boolean, falling boolean, uncorrelated boolean")


@register("label_codes", """
SELECT o_orderpriority, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS DOUBLE) AS label_idx,
       o_orderpriority AS decoded, count(*) AS n FROM orders GROUP BY o_orderpriority
""")
def label_codes(spark, sf):
    """Alphabetical label codes and their way back."""
    enc, indexer = classify.encode_labels(t(spark, sf, "orders").select("o_orderpriority"), "o_orderpriority")
    back = classify.decode_labels(enc, indexer, "label_idx", "decoded")
    return back.groupBy("o_orderpriority", "label_idx", "decoded").agg(F.count(F.lit(1)).alias("n"))


@register("best_rows", """
WITH s AS (SELECT CAST(p_size AS INTEGER) AS k, round(avg(p_retailprice), 6) AS silhouette FROM part GROUP BY 1),
m AS (SELECT p_brand AS model, round(avg(p_retailprice), 6) AS balanced_accuracy FROM part GROUP BY 1)
SELECT (SELECT k FROM s ORDER BY silhouette DESC, k LIMIT 1) AS best_k,
       (SELECT model FROM m ORDER BY balanced_accuracy DESC, model LIMIT 1) AS best_model
""")
def best_rows(spark, sf):
    """The selection rules on score tables: largest score, first on ties."""
    p = t(spark, sf, "part")
    sweep = p.groupBy(F.col("p_size").cast("int").alias("k")).agg(r6(F.avg("p_retailprice")).alias("silhouette"))
    comp = p.groupBy(F.col("p_brand").alias("model")).agg(r6(F.avg("p_retailprice")).alias("balanced_accuracy")).orderBy("model")
    return spark.createDataFrame([(clusters.best_k(sweep), classify.best_model_name(comp))], "best_k int, best_model string")


@register("model_checks", """
WITH c AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label HAVING count(*) >= 30),
n AS (SELECT sum(n) AS n, CAST(ceil(0.2 * sum(n)) AS BIGINT) AS n_test, count(*) AS classes FROM c)
SELECT m.model, n.n_test, n.classes, true AS accuracy_agrees, 1.0 AS importance_sum, true AS importance_falling
FROM n, (VALUES ('RandomForest'), ('GradientBoosting'), ('GBTDeep')) AS m(model)
""")
def model_checks(spark, sf):
    """The three presets: every test row gets a class, the reported accuracy is
    the share of hits counted anew, and importances are sorted and sum to one."""
    train, test, names = _supervised(spark, sf)
    comp, models, indexer = classify.compare_models(train, test, "genre", names)
    rows = []
    for r in comp.collect():
        pred = classify.decode_labels(models[r["model"]].transform(indexer.transform(test)), indexer)
        n_test, hits = pred.agg(F.count("pred_label"), F.count_if(F.col("pred_label") == F.col("genre"))).first()
        imp = [x["importance"] for x in classify.importance_table(spark, models[r["model"]], names).collect()]
        rows.append((r["model"], n_test, len(indexer.labels), abs(r["accuracy"] - hits / n_test) < 1e-9, float(round(sum(imp), 6)),
                     imp == sorted(imp, reverse=True)))
    return spark.createDataFrame(rows, "model string, n_test long, classes long, accuracy_agrees boolean, "
                                       "importance_sum double, importance_falling boolean")


@register("boost_stumps", """
WITH k AS (SELECT CAST(max(label) + 1 AS DOUBLE) AS k, 16777216.0 AS u FROM embeddings),
c AS (SELECT DISTINCT label AS class FROM embeddings),
x AS (SELECT label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS d FROM embeddings),
e AS (SELECT DISTINCT d, unnest(q) AS edge FROM (SELECT d, quantile_disc(v, [{probs}]) AS q FROM x GROUP BY d)),
n AS (SELECT e.d, e.edge, x.label, count(*) AS n FROM e JOIN x ON x.d = e.d AND x.v <= e.edge GROUP BY ALL),
s AS (SELECT d, edge, class, sum(n) AS nl, coalesce(sum(n) FILTER (n.label = c.class), 0) AS hl FROM n, c GROUP BY ALL),
t AS (SELECT class, (SELECT count(*) FROM embeddings) AS n, (SELECT count(*) FROM embeddings m WHERE m.label = c.class) AS h FROM c),
g AS (SELECT s.d, s.edge, s.class, k.u,
        ((nl - hl) * round(1 / k.k * k.u) + hl * round((1 / k.k - 1) * k.u)) / k.u AS gl,
        nl * round(1 / k.k * (1 - 1 / k.k) * 2 * k.u) / k.u AS hess_l,
        ((t.n - nl - t.h + hl) * round(1 / k.k * k.u) + (t.h - hl) * round((1 / k.k - 1) * k.u)) / k.u AS gr,
        (t.n - nl) * round(1 / k.k * (1 - 1 / k.k) * 2 * k.u) / k.u AS hess_r
      FROM s JOIN t USING (class), k),
w AS (SELECT *, gl * gl / (hess_l + 1) + gr * gr / (hess_r + 1) - (gl + gr) * (gl + gr) / (hess_l + hess_r + 1) AS gain
      FROM g WHERE hess_l >= 1 AND hess_r >= 1),
b AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY round(gain, 12) DESC, d, edge) AS rk FROM w)
SELECT CAST(class AS INTEGER) AS class, CAST(d AS INTEGER) AS feature, round(edge, 6) AS threshold, round(gain, 6) AS gain,
       round(-gl / (hess_l + 1), 6) AS left_value, round(-gr / (hess_r + 1), 6) AS right_value FROM b WHERE rk = 1
""".replace("{probs}", ", ".join(f"{i}/64.0" for i in range(1, 64))))
def boost_stumps(spark, sf):
    """The first round of second-order softmax boosting with one split per class,
    chosen by a level job over the whole table."""
    data = clusters.to_vector(_emb(spark, sf), "embedding").withColumn("y", F.col("label"))
    classes = int(data.agg(F.max("y")).first()[0]) + 1
    rules = trees.Rules("newton", 1, l2=1.0, least_hessian=1.0)
    model = trees.fit_boosting(data, "features", "y", None, classes, rules, 1, 1.0, prior=False, double_hessian=True, task_rows=0)
    rows = [(k, t.feature[0], float(model.edges[t.feature[0]][t.bin[0]]), t.gain[0], float(leaf[1]), float(leaf[2]))
            for k, (t, leaf) in enumerate(model.trees[0])]
    out = spark.createDataFrame(rows, "class int, feature int, threshold double, gain double, left_value double, right_value double")
    return out.select("class", "feature", *[r6(c).alias(c) for c in ("threshold", "gain", "left_value", "right_value")])


@register("pca", None)
def pca(spark, sf):
    proj, ratios = clusters.pca(_emb(spark, sf), "vec_id", "embedding", 2)
    return proj.select("vec_id", r6("pc1").alias("pc1"), r6("pc2").alias("pc2"),
                       F.lit(round(ratios[0], 6)).alias("ratio1"),
                       F.lit(round(ratios[1], 6)).alias("ratio2"))


def _supervised(spark, sf):
    emb = _emb(spark, sf).withColumn("genre", F.concat(F.lit("c"), F.col("label").cast("string")))
    kept = sampling.support_filter(emb, "genre", 30)
    split = sampling.stratified_split(kept, "genre", "vec_id", 0.2, SEED)
    data = materialize(clusters.to_vector(split, "embedding"))
    train = sampling.class_weights(data.filter(F.col("split") == "train"), "genre")
    test = data.filter(F.col("split") == "test")
    names = [f"e{i}" for i in range(len(data.first()["embedding"]))]
    return train, test, names


@register("model_compare", None)
def model_compare(spark, sf):
    """Fit the three presets; long table of accuracy / balanced accuracy per
    model plus the feature importances of the best model (by balanced
    accuracy, first on ties), largest first."""
    train, test, names = _supervised(spark, sf)
    comp, models, _ = classify.compare_models(train, test, "genre", names)
    best = classify.best_model_name(comp)
    scores = comp.select(F.lit("score").alias("kind"), "model",
                         F.explode(F.array(
                             F.struct(F.lit("accuracy").alias("name"), F.col("accuracy").alias("value")),
                             F.struct(F.lit("balanced_accuracy").alias("name"),
                                      F.col("balanced_accuracy").alias("value")))).alias("s"))
    scores = scores.select("kind", "model", "s.name", "s.value")
    imp = classify.importance_table(spark, models[best], names).select(
        F.lit("importance").alias("kind"), F.lit(best).alias("model"),
        F.col("feature").alias("name"), F.col("importance").alias("value"))
    return scores.unionByName(imp).select("kind", "model", "name", r6("value").alias("value"))
