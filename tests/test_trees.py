"""Histogram trees against plain versions: splits, boosting, forests, phases."""

import math
from collections import Counter

import numpy as np
import pytest

from cadenza.operators import trees
from cadenza.operators.trees import Rules


def table(spark, n=300, d=3, levels=6, classes=3, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, levels, (n, d)).astype(float)
    y = ((x[:, 0] * 2 + x[:, 1] + rng.integers(0, 3, n)) // 3 % classes).astype(int)
    w = rng.choice([0.5, 1.0, 2.0], n)
    rows = [(i, [float(v) for v in x[i]], int(y[i]), float(w[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, features array<double>, y int, w double"), x, y, w


def plain_tree(x, stats, worth, open_, least, floor, depth=0):
    """A tree by trying every value of every feature: (feature, value, left, right) or sums."""
    total = stats.sum(0)
    if not open_(total, depth, len(x)):
        return tuple(total)
    best = None
    for f in range(x.shape[1]):
        for v in np.unique(x[:, f])[:-1]:
            m = x[:, f] <= v
            a, b = stats[m].sum(0), stats[~m].sum(0)
            if least(a) and least(b):
                gain = round(worth(a) + worth(b) - worth(total), 12)
                if gain > floor and (best is None or gain > best[0]):
                    best = (gain, f, v, m)
    if best is None:
        return tuple(total)
    _, f, v, m = best
    return (f, v, plain_tree(x[m], stats[m], worth, open_, least, floor, depth + 1), plain_tree(x[~m], stats[~m], worth, open_, least, floor, depth + 1))


def plain_leaf(tree, row):
    while len(tree) == 4 and isinstance(tree[2], tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def shape(tree: trees.Tree, edges, i=0):
    if tree.feature[i] < 0:
        return None
    f = tree.feature[i]
    return (f, edges[f][tree.bin[i]], shape(tree, edges, tree.left[i]), shape(tree, edges, tree.left[i] + 1))


def plain_shape(tree):
    if not (len(tree) == 4 and isinstance(tree[2], tuple)):
        return None
    return (tree[0], tree[1], plain_shape(tree[2]), plain_shape(tree[3]))


@pytest.mark.parametrize("kind", ["newton", "mse"])
def test_boosting_equals_plain_version(spark, kind):
    df, x, y, w = table(spark)
    newton = kind == "newton"
    rules = Rules(kind, 3, l2=1.0 if newton else 0.0, least_hessian=1.0 if newton else 0.0)
    model = trees.fit_boosting(df, "features", "y", "w", 3, rules, 4, 0.3, prior=not newton, double_hessian=newton)
    share = np.array([w[y == k].sum() for k in range(3)]) / w.sum()
    scores = np.tile(np.zeros(3) if newton else np.log(share), (len(x), 1))
    for r in range(4):
        p = np.exp(scores) / np.exp(scores).sum(1, keepdims=True)
        step = np.zeros_like(scores)
        for k in range(3):
            h = p[:, k] * (1 - p[:, k]) * (2 if newton else 1)
            stats = np.stack([(p[:, k] - (y == k)) * w, h * w, w], axis=1)
            low = (lambda s: s[1] + 1.0) if newton else (lambda s: s[2])
            plain = plain_tree(x, stats, lambda s: s[0] ** 2 / low(s), lambda s, dep, n: n >= 2 and dep < 3,
                               lambda s: s[1] >= 1 if newton else s[2] > 0, 1e-9)
            tree, leaf = model.trees[r][k]
            assert shape(tree, model.edges) == plain_shape(plain)
            for i, row in enumerate(x):
                s = plain_leaf(plain, row)
                step[i, k] = -0.3 * (s[0] / (s[1] + 1.0) if newton else 2 / 3 * s[0] / s[1])
        scores += step
    got = model.scores_of(trees.cut(x, model.edges))
    assert np.abs(got - scores).max() < 1e-4
    want = dict(zip(range(len(x)), got.argmax(1)))
    assert {r["id"]: int(r["prediction"]) for r in model.transform(df).collect()} == want
    assert abs(sum(model.featureImportances) - 1) < 1e-9


@pytest.mark.parametrize("kind", ["newton", "mse"])
def test_level_jobs_and_tasks_grow_the_same_trees(spark, kind):
    df, x, _, _ = table(spark, n=500, d=4, levels=40)
    rules = Rules(kind, 4, l2=1.0)
    models = [trees.fit_boosting(df.repartition(p), "features", "y", "w", 3, rules, 3, 0.3, prior=True, task_rows=t)
              for p, t in ((3, 0), (1, 10_000))]
    binned = trees.cut(x, models[0].edges)
    assert (models[0].scores_of(binned) == models[1].scores_of(binned)).all()
    assert models[0].featureImportances == models[1].featureImportances


@pytest.mark.parametrize("kind", ["newton", "mse"])
def test_small_nodes_of_a_large_table_are_finished_in_tasks(spark, kind, monkeypatch):
    """Boosting deals the rows of nodes that fit a task: fewer level jobs than levels,
    no job for the roots' sums, the class shares once per block, the same trees."""
    df, x, _, _ = table(spark, n=500, d=4, levels=40)
    rules, jobs = Rules(kind, 5, l2=1.0), []
    whole = trees.level
    monkeypatch.setattr(trees, "level", lambda *a: jobs.append(a[2]) or whole(*a))
    monkeypatch.setattr(trees, "_root_sums", lambda *a: pytest.fail("a job for sums that the level job knows"))
    both = trees.fit_boosting(df.repartition(3), "features", "y", "w", 3, rules, 2, 0.3, prior=True, task_rows=300)
    assert 2 <= len(jobs) < 2 * 5
    one = trees.fit_boosting(df.repartition(1), "features", "y", "w", 3, rules, 2, 0.3, prior=True, task_rows=10_000)
    binned = trees.cut(x, one.edges)
    assert (both.scores_of(binned) == one.scores_of(binned)).all()
    assert np.allclose(both.featureImportances, one.featureImportances, rtol=1e-12)
    for (a, _), (b, _) in zip(both.trees[1], one.trees[1]):
        assert shape(a, one.edges) == shape(b, one.edges)
    b, recent = trees.Block(binned.astype(np.uint8), np.zeros(500, np.int64), np.ones(500, np.int64), None, np.zeros((500, 3))), one.trees
    trees.boost_stats(b, recent, 0, 1024.0, False)
    monkeypatch.setattr(trees, "boost_scores", lambda *a: pytest.fail("scores worked out again for another class"))
    trees.boost_stats(b, recent, 1, 1024.0, False)


def test_scores_are_folded_into_the_blocks(spark, monkeypatch):
    df, x, _, _ = table(spark)
    args = ("features", "y", "w", 3, Rules("newton", 3, l2=1.0), 5, 0.3, False)
    want = trees.fit_boosting(df, *args).scores_of(trees.cut(x, trees.bin_edges(df, "features")))
    monkeypatch.setattr(trees, "FOLD", 2)
    model = trees.fit_boosting(df, *args)
    assert np.allclose(model.scores_of(trees.cut(x, model.edges)), want, rtol=0, atol=1e-9)


def gini_tree(x, y, w, classes):
    stats = np.zeros((len(x), classes))
    stats[np.arange(len(x)), y] = w
    return plain_tree(x, stats, lambda s: (s * s).sum() / s.sum(), lambda s, dep, n: n >= 2 and (s > 0).sum() > 1, lambda s: s.sum() > 0, -math.inf)


@pytest.mark.parametrize("task_rows", [10_000, 40, 0])
def test_forest_equals_plain_trees_at_any_depth(spark, task_rows):
    df, x, y, w = table(spark, n=250, levels=9)
    rules = Rules("gini", None, seed=3)
    model = trees.fit_forest(df, "features", "y", "w", 3, 4, rules, task_rows=task_rows)
    h = np.array([r["h"] for r in df.orderBy("id").selectExpr("xxhash64(id, features, y, w) as h").collect()], np.int64)
    votes = np.zeros((len(x), 3))
    for t in range(4):
        count = trees.bootstrap(h, t, 3)
        own = count > 0
        plain = gini_tree(x[own], y[own], (w * count)[own], 3)
        for i, row in enumerate(x):
            s = np.array(plain_leaf(plain, row))
            votes[i] += s / s.sum()
    want = votes.argmax(1)
    got = {r["id"]: int(r["prediction"]) for r in model.transform(df).collect()}
    # equal votes may differ in the last digit
    close = np.sort(votes, axis=1)
    clear = close[:, -1] - close[:, -2] > 1e-5
    assert all(got[i] == want[i] for i in np.flatnonzero(clear)) and clear.mean() > 0.9
    assert abs(sum(model.featureImportances) - 1) < 1e-9


def test_forest_is_the_same_in_both_phases_with_drawn_features(spark, monkeypatch):
    df, x, _, _ = table(spark, n=400, d=6, levels=30)
    out = []
    for t, p in ((10_000, 2), (60, 5), (0, 1)):
        m = trees.fit_forest(df.repartition(p), "features", "y", "w", 3, 5, Rules("gini", None, tries=2, seed=9), task_rows=t)
        out.append(([r["prediction"] for r in m.transform(df).orderBy("id").collect()], np.round(m.featureImportances, 9).tolist()))
    assert out[0] == out[1] == out[2]
    monkeypatch.setattr(trees, "PASS_BYTES", m.subtrees.selectExpr("sum(length(data))").first()[0] // 12)      # many scoring passes
    assert 10 < len(list(m.passes())) < 40
    assert [r["prediction"] for r in m.transform(df).orderBy("id").collect()] == out[0][0]


def test_deep_trees(spark):
    """A chain that only a tree deeper than 30 separates."""
    n = 62
    rows = [(4 * i + j, [float(i)], i % 2) for i in range(n) for j in range(4)]
    df = spark.createDataFrame(rows, "id long, features array<double>, y int")
    model = trees.fit_forest(df, "features", "y", None, 2, 15, Rules("gini", None))
    hits = model.transform(df).filter("prediction = y").count()
    assert hits / len(rows) > 0.9
    chain = trees.Tree()
    chain.add(np.array([1, 1]), 1, 0)
    stats = np.ones((n, 1))
    # weights that make the best split cut off one end each time
    w = 4.0 ** -np.arange(20)
    x = np.arange(20, dtype=np.uint8)[:, None]
    chain.sums[0] = np.array([w[::2].sum(), w[1::2].sum()]) * 4**20
    trees.finish(chain, np.zeros(20, np.int64), x, (w * 4**20)[:, None], np.arange(20) % 2, Rules("gini", None), 1.0, 64, [0])
    assert max(chain.depth) > 15 and sum(f < 0 for f in chain.feature) == 20 and len(stats) == n


def test_bootstrap_counts_are_poisson_and_fixed():
    h = np.arange(200_000, dtype=np.int64) * 7919
    c = Counter(trees.bootstrap(h, 3, 42).tolist())
    for k in range(4):
        assert abs(c[k] / len(h) - math.exp(-1) / math.factorial(k)) < 0.005
    assert (trees.bootstrap(h[:10], 3, 42) == trees.bootstrap(h, 3, 42)[:10]).all()
    assert not (trees.bootstrap(h, 3, 42) == trees.bootstrap(h, 4, 42)).all()


def test_missing_values_go_right_and_null_rows_do_not_crash(spark):
    rows = [(i, [float(i % 5), float("nan") if i % 3 else 1.0], i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, features array<double>, y int")
    model = trees.fit_boosting(df, "features", "y", None, 2, Rules("mse", 2), 2, 0.1, prior=True)
    assert model.transform(df).filter("prediction is null").count() == 0


def test_a_sibling_gets_the_rest_of_its_parents_sums(monkeypatch):
    """Boosting sums up the child with fewer rows only, with the numbers that gains need."""
    rng = np.random.default_rng(4)
    n, looked, whole = 3000, [], trees._sums_by_bin
    x = rng.integers(0, 64, (n, 5)).astype(np.uint8)
    s = np.rint(np.stack([rng.normal(size=n) + (x[:, 0] > 20), rng.random(n), rng.random(n)], axis=1) * 1e6)

    def grown(held):
        monkeypatch.setattr(trees, "HELD", held)
        tree = trees.Tree()
        tree.add(s.sum(0).astype(np.int64), 1, 0)
        trees.finish(tree, np.zeros(n, np.int64), x, s, None, Rules("newton", 5, l2=1.0), 1024.0, 64, [0])
        return tree
    small = grown(1)                 # one node at a time, nothing kept of the level above
    monkeypatch.setattr(trees, "_sums_by_bin", lambda b, rows, *a: looked.append((len(rows), len(a[1]))) or whole(b, rows, *a))
    tree = grown(1 << 22)
    assert tree.__dict__.keys() == small.__dict__.keys() and tree.feature == small.feature and tree.bin == small.bin and tree.gain == small.gain
    assert (np.array(tree.sums) == np.array(small.sums)).all()
    assert max(tree.depth) == 5 and sum(k for k, _ in looked) <= n + 4 * n / 2 and {k for _, k in looked} == {2}


@pytest.mark.parametrize("classes, weights", [(2, [1]), (5, [1, 2, 5]), (11, [3])])
def test_few_rows_are_split_as_by_their_bins(classes, weights):
    rng = np.random.default_rng(classes)
    nodes, f = 200, 4
    n = rng.integers(1, 12, nodes)
    local = np.repeat(np.arange(nodes), n)
    b = rng.integers(0, rng.choice([2, 8, 64], nodes)[local][:, None], (len(local), f)).astype(np.uint8)
    cls, w = rng.integers(0, classes, len(local)), rng.choice(weights, len(local)).astype(float)
    rules = Rules("gini", None)
    hist = trees.histogram(b, local, np.tile(np.arange(f), (nodes, 1)), w[:, None], cls, 64, classes)
    want = trees.best_splits(hist, rules, 1.0)
    got = trees.best_among_rows(b, local, w, cls, nodes, rules, 1.0, 64, classes)
    real = np.isfinite(want[0])
    assert (want[0] == got[0]).all() and (want[1][real] == got[1][real]).all() and (want[2][real] == got[2][real]).all()
    assert real.any() and not real.all()


def test_a_class_keeps_its_rows_over_the_rounds(spark, monkeypatch):
    """Only shares are dealt in a round: the rows of a class lie in a partition of their own."""
    df, x, y, _ = table(spark, n=400)
    kept, rounds, whole = [], [], trees._copies
    monkeypatch.setattr(trees, "_copies", lambda *a: kept.append((a[1], whole(*a))) or kept[-1][1])
    monkeypatch.setattr(trees, "level", lambda *a: pytest.fail("a job for a level of a table that fits a task"))
    trees.fit_boosting(df.repartition(3), "features", "y", "w", 3, Rules("newton", 3, l2=1.0), 2, 0.3, prior=False)
    (seats, rows), = kept
    parts = [{r["seat"] for r in p} for p in rows.rdd.glom().collect()]
    assert sorted(parts, key=min) == [{s} for s in sorted(seats)]
    plan = rows.groupBy("seat").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    monkeypatch.setattr(trees, "TASK_BYTES", 100 * 3)          # 100 rows of three features: level jobs again
    monkeypatch.setattr(trees, "level", lambda *a: rounds.append(1) or (_ for _ in ()).throw(RuntimeError("level job")))
    with pytest.raises(RuntimeError, match="level job"):
        trees.fit_boosting(df, "features", "y", "w", 3, Rules("newton", 3, l2=1.0), 1, 0.3, prior=False)
    assert rounds


def test_a_task_holds_one_pass_of_small_subtrees(spark, monkeypatch):
    """Leaves of one class take no list of weights, and a scoring plan has one pass at most."""
    df, x, y, w = table(spark, n=400, d=4, levels=50, classes=7)
    m = trees.fit_forest(df, "features", "y", "w", 7, 6, Rules("gini", None, tries=2, seed=1))
    import pickle
    packed = [pickle.loads(r["data"]) for r in m.subtrees.collect()]
    nodes = sum(len(p["feature"]) for p in packed)
    assert nodes > 500 and sum(v.nbytes for p in packed for v in p.values()) <= 8 * nodes
    whole = [r["prediction"] for r in m.transform(df).orderBy("id").collect()]
    assert np.mean(np.array(whole) == y) > 0.9
    monkeypatch.setattr(trees, "PASS_BYTES", 1)                 # a subtree a pass
    got = m.transform(df)
    assert got._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert [r["prediction"] for r in got.orderBy("id").collect()] == whole


def test_leaves_of_several_classes_keep_their_shares(spark):
    rows = [(i, [float(i % 2)], int(i % 5 == 0) + i % 2) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, features array<double>, y int")
    m = trees.fit_forest(df, "features", "y", None, 3, 3, Rules("gini", None))
    import pickle
    assert all(len(pickle.loads(r["data"])["mixed"]) == 2 for r in m.subtrees.collect())
    assert {(r["id"] % 2, r["prediction"]) for r in m.transform(df).collect()} == {(0, 0.0), (1, 1.0)}
