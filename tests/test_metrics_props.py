"""Metric properties and brute-force references (no external ML library)."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.operators import metrics, sampling


def brute_ari(u, v):
    n = len(u)
    pairs = list(itertools.combinations(range(n), 2))
    a = sum(1 for i, j in pairs if u[i] == u[j] and v[i] == v[j])
    su = sum(1 for i, j in pairs if u[i] == u[j])
    sv = sum(1 for i, j in pairs if v[i] == v[j])
    tot = len(pairs)
    exp = su * sv / tot
    mx = (su + sv) / 2
    return 1.0 if mx == exp else (a - exp) / (mx - exp)


def brute_nmi(u, v):
    n = len(u)
    cu, cv = {}, {}
    cij = {}
    for x, y in zip(u, v):
        cu[x] = cu.get(x, 0) + 1
        cv[y] = cv.get(y, 0) + 1
        cij[(x, y)] = cij.get((x, y), 0) + 1
    if len(cu) == len(cv) == 1:
        return 1.0
    mi = sum(c / n * math.log(n * c / (cu[x] * cv[y])) for (x, y), c in cij.items())
    hu = -sum(c / n * math.log(c / n) for c in cu.values())
    hv = -sum(c / n * math.log(c / n) for c in cv.values())
    if mi <= 0:
        return 0.0
    return mi / ((hu + hv) / 2)


def agree(spark, u, v):
    df = spark.createDataFrame(list(zip(u, v)), "u string, v string")
    r = metrics.cluster_agreement(df, "u", "v").first()
    return r["ari"], r["nmi"]


def test_ari_nmi_against_brute_force(spark):
    rnd = random.Random(7)
    u = [rnd.choice("abcd") for _ in range(60)]
    v = [rnd.choice("xyz") for _ in range(60)]
    ari, nmi = agree(spark, u, v)
    assert ari == pytest.approx(brute_ari(u, v), abs=1e-12)
    assert nmi == pytest.approx(brute_nmi(u, v), abs=1e-12)


def test_partition_identities(spark):
    u = list("aabbccdd")
    ari, nmi = agree(spark, u, u)
    assert ari == pytest.approx(1.0) and nmi == pytest.approx(1.0)
    relabel = [{"a": "q", "b": "r", "c": "s", "d": "t"}[x] for x in u]
    ari, nmi = agree(spark, u, relabel)
    assert ari == pytest.approx(1.0) and nmi == pytest.approx(1.0)
    ari, nmi = agree(spark, ["a"] * 6, ["z"] * 6)               # one cluster, one class
    assert (ari, nmi) == (1.0, 1.0)
    ari, nmi = agree(spark, ["a"] * 6, list("xxyyzz"))
    assert ari == pytest.approx(0.0) and nmi == 0.0


def brute_silhouette(x, lab):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    out = []
    for i in range(len(x)):
        own = lab == lab[i]
        if own.sum() <= 1:
            out.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, lab == c].mean() for c in set(lab) if c != lab[i])
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


def test_silhouette_blocks_match_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(90, 5))
    lab = np.array([i % 3 for i in range(90)])
    lab[0] = 7                                                    # a singleton cluster
    rows = [(i, int(lab[i]), [float(v) for v in x[i]]) for i in range(90)]
    df = spark.createDataFrame(rows, "k long, c int, v array<double>")
    got = metrics.silhouette(df, "k", "c", "v", block_rows=16).first()["silhouette"]   # 6 blocks
    assert got == pytest.approx(brute_silhouette(x, lab), abs=1e-9)


def test_classification_report_edges(spark):
    truth = ["a", "a", "b", "b", "c"]
    pred = ["a", "b", "b", "b", "d"]               # c never predicted, d not in truth
    df = spark.createDataFrame(list(zip(truth, pred)), "t string, p string")
    rep = {r["label"]: r for r in metrics.classification_report(df, "t", "p").collect()}
    assert rep["c"]["precision"] == 0.0 and rep["c"]["recall"] == 0.0 and rep["c"]["f1"] == 0.0
    assert rep["d"]["support"] == 0 and rep["d"]["precision"] == 0.0
    assert rep["accuracy"]["f1"] == pytest.approx(3 / 5)
    assert rep["macro avg"]["recall"] == pytest.approx((0.5 + 1 + 0 + 0) / 4)
    s = metrics.accuracy_scores(df, "t", "p").first()
    assert s["balanced_accuracy"] == pytest.approx((0.5 + 1.0 + 0.0) / 3)   # classes of truth


def test_take_quota_brute_force_and_skew(spark):
    # one hot class with a third of the rows, quotas that land inside buckets
    rows = [("hot", i) for i in range(3000)] + [(f"c{j}", i) for j in range(6) for i in range(1000)]
    df = spark.createDataFrame(rows, "cls string, k int").withColumn("key", F.concat_ws("-", "cls", "k"))
    df = df.withColumn("h", F.md5(F.concat_ws("|", F.lit("42"), "key")))
    quotas = spark.createDataFrame([("hot", 1234), ("c0", 1000), ("c1", 0), ("c2", 1)] +
                                   [(f"c{j}", 517) for j in range(3, 6)], "cls string, quota long")
    got = sampling.take_quota(df, "cls", quotas, "h").select("key").collect()
    pdf = df.toPandas().merge(quotas.toPandas(), on="cls")
    pdf = pdf.sort_values(["cls", "h"])
    pdf["r"] = pdf.groupby("cls").cumcount() + 1
    want = set(pdf[pdf["r"] <= pdf["quota"]]["key"])
    assert {r["key"] for r in got} == want


def test_split_independent_of_partitioning(spark):
    rows = [(f"c{i % 7}", i) for i in range(700)] + [("c0", 1000 + i) for i in range(500)]
    df = spark.createDataFrame(rows, "cls string, k long")
    a = sampling.stratified_split(df, "cls", "k", 0.2)
    b = sampling.stratified_split(df.repartition(13, "k"), "cls", "k", 0.2)
    ta = sorted(r["k"] for r in a.filter("split = 'test'").collect())
    tb = sorted(r["k"] for r in b.filter("split = 'test'").collect())
    assert ta == tb and len(ta) == math.ceil(0.2 * 1200)
    sizes = {r["cls"]: r["n"] for r in a.filter("split = 'test'").groupBy("cls").count()
             .withColumnRenamed("count", "n").collect()}
    totals = {r["cls"]: r["n"] for r in df.groupBy("cls").count().withColumnRenamed("count", "n").collect()}
    for c, n in totals.items():
        assert abs(sizes.get(c, 0) - 0.2 * n) <= 1


def test_scale_inverse_identity(spark):
    from cadenza.operators import clean
    df = spark.createDataFrame([(float(i), float(i * i)) for i in range(20)], "a double, b double")
    z, st = clean.scale(df, ["a", "b"])
    back = clean.inverse_scale(z, ["a", "b"], st).collect()
    for i, r in enumerate(back):
        assert r["a"] == pytest.approx(i) and r["b"] == pytest.approx(i * i)


@pytest.mark.parametrize("accuracy", [20, 200, 10_000])
def test_quantiles_equal_percentile(spark, accuracy):
    from cadenza.operators.quantiles import quantiles
    from conftest import SF01
    li = spark.read.parquet(f"{SF01}/lineitem.parquet").withColumn(
        "c", F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")))     # a null class
    feats, probs = ["l_extendedprice", "l_quantity", "l_discount"], [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    for group in (None, "c"):
        got = {(r["c"] if group else 0, r["feature"], r["prob"]): r["value"]
               for r in quantiles(li, feats, probs, group, accuracy=accuracy).collect()}
        per = li.groupBy(*([group] if group else [])).agg(*[F.percentile(f, F.array(*[F.lit(p) for p in probs])).alias(f) for f in feats])
        want = {(r["c"] if group else 0, f, p): r[f][i] for r in per.collect() for f in feats for i, p in enumerate(probs)}
        assert set(got) == set(want)
        for k in want:
            assert got[k] == pytest.approx(want[k], rel=1e-12)


def test_quantiles_of_small_tied_and_empty_groups(spark):
    from cadenza.operators.quantiles import quantiles
    rows = [("a", 1.0), ("a", 2.0), ("b", 5.0), ("c", None), ("d", float("nan")), ("d", 3.0), (None, 1.0), (None, 4.0), (None, 9.0)] + [("t", 7.0)] * 50 + [("t", 8.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {(r["g"], r["prob"]): r["value"] for r in quantiles(df, ["x"], [0.25, 0.5, 0.99], "g").collect()}
    assert (got["a", 0.25], got["b", 0.5], got["c", 0.5], got["d", 0.5], got[None, 0.5], got["t", 0.5]) == (1.25, 5.0, None, 3.0, 4.0, 7.0)
    assert got["t", 0.99] == pytest.approx(7.5) and got["a", 0.99] == pytest.approx(1.99)
    assert quantiles(df.limit(0), ["x"], [0.5]).first()["value"] is None


def test_box_summary_has_the_null_class(spark):
    from cadenza.operators import profile
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 2.0), (None, 6.0)], "g string, x double")
    got = {r["g"]: r for r in profile.box_summary(df, "g", ["x"]).collect()}
    assert (got[None]["min"], got[None]["q1"], got[None]["median"], got[None]["max"]) == (2.0, 3.0, 4.0, 6.0)


def test_quantiles_skip_nan(spark):
    from cadenza.operators import clean
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5]] + [(float("nan"),)] * 3, "x double")
    r = clean.iqr_fences(df, ["x"]).first()
    assert (r["q1"], r["q3"]) == (2.0, 4.0)


def test_silhouette_multi_matches_single(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(70, 4))
    rows = [(i, i % 2, i % 5, [float(v) for v in x[i]]) for i in range(70)]
    df = spark.createDataFrame(rows, "k long, a int, b int, v array<double>")
    multi = metrics.silhouette_multi(df, "k", ["a", "b"], "v", block_rows=20)
    for col in ("a", "b"):
        one = metrics.silhouette(df, "k", col, "v", block_rows=20).first()["silhouette"]
        assert multi[col] == pytest.approx(one, abs=1e-12)
        assert multi[col] == pytest.approx(brute_silhouette(x, np.array([r[1 if col == "a" else 2] for r in rows])), abs=1e-9)


def test_silhouette_squared_is_a_separate_metric(spark):
    from cadenza.operators import clusters
    rng = np.random.default_rng(9)
    x = np.vstack([rng.normal(0, 1, size=(40, 3)), rng.normal(6, 1, size=(40, 3))])
    rows = [(i, int(i >= 40), [float(v) for v in x[i]]) for i in range(80)]
    df = spark.createDataFrame(rows, "k long, c int, v array<double>")
    sq = metrics.silhouette_squared(clusters.to_vector(df, "v").withColumn("c", F.col("c").cast("double")),
                                    "c", "features")
    eu = metrics.silhouette(df, "k", "c", "v").first()["silhouette"]
    assert 0 < eu < 1 and 0 < sq <= 1
    assert eu == pytest.approx(brute_silhouette(x, np.array([r[1] for r in rows])), abs=1e-9)


def test_a_pair_of_silhouette_blocks_holds_no_copies_of_its_distances():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from cadenza.operators import metrics
    n, d, held = 1500, 4, 1 << 20
    rng = np.random.default_rng(3)
    x, own = rng.normal(size=(2 * n, d)), rng.integers(0, 3, 2 * n)
    table = pa.table({"key": np.arange(2 * n), "__blk": np.repeat([0, 1], n), "__c0": own.astype(np.int32),
                      "v": pa.ListArray.from_arrays(pa.array(np.arange(2 * n + 1, dtype=np.int32) * d), pa.array(x.ravel()))})
    fn = metrics._pair_kernel("key", ["__c0"], [3], "v", held)
    tracemalloc.start()
    out = fn((pa.scalar(0), pa.scalar(1)), table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.5 * 8 * held                # the distances themselves, and little else
    far = np.sqrt(((x[:n, None] - x[None, n:]) ** 2).sum(2))
    want = np.concatenate([far @ np.eye(3)[own[n:]], far.T @ np.eye(3)[own[:n]]])
    assert np.allclose(np.stack(out.column("__s").to_numpy()), want)


def test_sums_of_a_key_are_added_up_as_arrays():
    import pyarrow as pa
    table = pa.table({"key": pa.array(["b", None, "a", "b", None, "b"]),
                      "__s": pa.array([[float(i), 10.0 * i] for i in range(6)], pa.list_(pa.float64()))})
    got = metrics._add_up("key")(table).to_pydict()
    assert dict(zip(got["key"], got["__s"])) == {"b": [8.0, 80.0], None: [5.0, 50.0], "a": [2.0, 20.0]}


def test_silhouette_shuffles_arrays_not_single_sums(spark):
    """With several blocks a row's sums travel as one array a block pair."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(120, 3))
    df = spark.createDataFrame([(f"r{i}", i % 4, [float(v) for v in r]) for i, r in enumerate(x)], "id string, c int, v array<double>")
    rows = metrics.silhouette_per_row(df, "id", "c", "v", block_rows=25)
    plan = rows._jdf.queryExecution().analyzed().toString()
    assert plan.lower().count("flatmapgroupsinarrow") >= 2
    own = np.arange(120) % 4
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    for r in rows.collect():
        i = int(r["id"][1:])
        means = [far[i, own == c].sum() / ((own == c).sum() - (c == own[i])) for c in range(4)]
        b = min(m for c, m in enumerate(means) if c != own[i])
        assert abs(r["silhouette"] - (b - means[own[i]]) / max(b, means[own[i]])) < 1e-9


@pytest.mark.parametrize("same", [True, False])
def test_a_slice_is_summed_up_only_for_labels_that_it_has(same):
    """Two labellings, one with rows without a label; slices of four rows."""
    import pyarrow as pa
    rng = np.random.default_rng(6)
    n, d = 30, 3
    x, sizes = rng.normal(size=(n, d)), [4, 3]
    own = np.stack([rng.integers(0, 4, n), rng.integers(-1, 3, n)], axis=1)
    blk = np.zeros(n, int) if same else np.repeat([0, 1], [11, 19])
    table = pa.table({"key": [f"r{i}" for i in range(n)], "__blk": blk, "__c0": own[:, 0].astype(np.int32), "__c1": own[:, 1].astype(np.int32),
                      "v": pa.array(x.astype(np.float32).tolist(), pa.list_(pa.float32()))})
    out = metrics._pair_kernel("key", ["__c0", "__c1"], sizes, "v", 16)((pa.scalar(0), pa.scalar(int(not same)), pa.scalar(5)), table)
    x = x.astype(np.float32).astype(float)
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)) * (True if same else blk[:, None] != blk[None])
    marks = np.concatenate([own[:, j, None] == np.arange(s) for j, s in enumerate(sizes)], axis=1)
    assert out.column("key").to_pylist() == table.column("key").to_pylist()
    assert np.allclose(np.stack(out.column("__s").to_numpy()), far @ marks, atol=1e-6)
    assert (np.stack(out.column("__own").to_numpy()) == own).all()


@pytest.mark.parametrize("block_rows", [7, 1000])
def test_silhouettes_of_odd_rows(spark, block_rows):
    """Rows without key or label, a label of one row, one of all rows, rows that
    come twice; a key's sums turn into its scores where they are added up."""
    rng = np.random.default_rng(8)
    rows = [(None if i == 3 else i, None if i == 5 else "abc"[i % 3] if i else "one", "all", [float(v) for v in rng.normal(size=2)]) for i in range(25)]
    rows += rows[10:12]
    df = spark.createDataFrame(rows, "id long, p string, q string, v array<double>")
    got = metrics._silhouettes(df, "id", ["p", "q"], "v", block_rows, None)
    plan = got._jdf.queryExecution().analyzed().toString().lower()
    assert "generate" not in plan and plan.count("flatmapgroupsinarrow") == 2          # no row per cluster, none joined to its label
    x, p = np.array([r[3] for r in rows]), [r[1] for r in rows]
    far, want = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)), {}
    for i, r in enumerate(rows):
        if r[0] is None:
            continue
        want[r[0], 1, "all"] = 0.0
        if p[i] is not None:
            sums = {c: far[i, [q == c for q in p]].sum() / (p.count(c) - (c == p[i])) if c != p[i] or p.count(c) > 1 else None for c in set(p) - {None}}
            a, b = sums.pop(p[i]), min(v for v in sums.values())
            want[r[0], 0, p[i]] = 0.0 if a is None else (b - a) / max(a, b)
    have = {(r["id"], r["__j"], r["__own"]): r["silhouette"] for r in got.collect()}
    assert have.keys() == want.keys() and got.count() == len(want)
    assert all(have[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_every_pair_of_blocks_has_a_partition(spark):
    from cadenza.session import seats
    for n in (1, 3, 28):
        own = seats(spark, n)
        df = spark.createDataFrame([(s,) for s in own], "seat int").repartition(n, "seat")
        assert sorted(len(p) for p in df.rdd.glom().collect()) == [1] * n
