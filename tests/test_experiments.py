"""End-to-end experiments on a folder of track CSVs (small model settings)."""

import numpy as np
import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def prep(spark, track_folder):
    from cadenza.plans.experiments import prepare_training_data
    return prepare_training_data(spark, track_folder[0])


def test_preparation_equals_plain_python(prep, track_folder):
    _, rows, labels = track_folder
    kept = [r for r in rows if labels.get(r["artist_name"].lower()) not in (None, "", "N/A")]
    x = np.array([[r[f] for f in prep["features"]] for r in kept], float)
    q1, q3 = np.percentile(x, [25, 75], axis=0)
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside = ((x >= low) & (x <= high)).all(axis=1)
    rep = prep["report"].first()
    assert prep["raw"].count() == len(rows)
    assert (rep["n_total"], rep["n_labelled"], rep["n_dropped"]) == (len(rows), len(kept), len(rows) - len(kept))
    assert rep["n_outliers"] == (~inside).sum() > 0 and prep["df"].count() == inside.sum()
    for i, f in enumerate(prep["features"]):
        assert prep["fences"][f] == pytest.approx((low[i], high[i]))
        assert prep["stats"][f] == pytest.approx((x[inside][:, i].mean(), x[inside][:, i].std()))
    assert prep["raw"].filter("artist_name = '1991'").count() == sum(r["artist_name"] == "1991" for r in rows)


def test_unsupervised(spark, prep):
    from cadenza.operators import sampling
    from cadenza.plans.experiments import unsupervised_experiment
    res = unsupervised_experiment(spark, prep, k_values=[2, 3, 10], n_init=2)
    counts = [r["n"] for r in sampling.class_counts(prep["df"], "primary_genre").collect()]
    cap = int(np.floor(np.median(counts)))
    n = res["balanced"].count()
    assert n == sum(min(c, cap) for c in counts)
    sweep = {r["k"]: r for r in res["sweep"].collect()}
    assert set(sweep) == {2, 3, 10}
    assert all(-1 <= r["silhouette"] <= 1 and r["inertia"] > 0 for r in sweep.values())
    assert sweep[10]["inertia"] < sweep[2]["inertia"]
    summ = {r["k"]: r for r in res["summary"].collect()}
    assert res["best_k"] in sweep and 2 in summ and 10 in summ
    assert all(0 <= r["nmi"] <= 1 for r in summ.values())
    prof = res["profiles"][2].collect()
    assert len(prof) == 2 and all(95 <= r["tempo"] <= 176 for r in prof)   # original units
    ct = res["crosstabs"][2].agg(F.sum("n")).first()[0]
    assert ct == n


def test_supervised(spark, prep):
    from cadenza.operators.classify import Preset
    from cadenza.plans.experiments import supervised_experiment
    presets = (Preset("RandomForest", "forest", n_trees=10, max_depth=8),
               Preset("GradientBoosting", "boost", n_trees=2, max_depth=3, step=0.1))
    res = supervised_experiment(spark, prep, presets=presets, min_support=200)
    comp = {r["model"]: r for r in res["comparison"].collect()}
    assert set(comp) == {"RandomForest", "GradientBoosting"}
    assert all(0 <= r["accuracy"] <= 1 and 0 <= r["balanced_accuracy"] <= 1 for r in comp.values())
    imp = res["importances"].collect()
    assert len(imp) == 6 and abs(sum(r["importance"] for r in imp) - 1) < 1e-9
    n = {r["primary_genre"]: r["count"] for r in prep["df"].groupBy("primary_genre").count().collect()}
    assert {r["primary_genre"] for r in res["dropped"].collect()} == {g for g, k in n.items() if k < 200} != set()
    assert res["summary"].first()["n_classes"] == sum(k >= 200 for k in n.values()) > 1
    rep = {r["label"]: r for r in res["reports"]["RandomForest"].collect()}
    assert {"accuracy", "macro avg", "weighted avg"} <= set(rep)
    assert rep["accuracy"]["f1"] == pytest.approx(comp["RandomForest"]["accuracy"])


def test_coverage_report(spark):
    from cadenza.plans.experiments import coverage_report
    rows = [("techno", [("Techno", 10), ("seen live", 3)]), ("house", []),
            ("house, bass", [("chill", 5), ("deep house", 2)])]
    df = spark.createDataFrame(rows, "genre string, tags array<struct<name:string,count:int>>")
    rep = coverage_report(df)
    c = rep["coverage"].first()
    assert (c["n_items"], c["n_with_tags"], c["n_with_relevant"]) == (3, 2, 2)
    assert c["decision"] == "proceed"
    by = {r["primary"]: (r["covered"], r["n"]) for r in rep["by_class"].collect()}
    assert by == {"techno": (1, 1), "house": (1, 2)}
    top = {(r["kind"], r["tag"]): r["n"] for r in rep["top"].collect()}
    assert top[("genre", "techno")] == 1 and top[("noise", "chill")] == 1


def test_supervised_fit_on_train(spark, prep):
    from cadenza.operators.classify import Preset
    from cadenza.plans.experiments import supervised_experiment
    res = supervised_experiment(spark, prep, presets=(Preset("RandomForest", "forest", 5, 5),),
                                fit_on="train")
    r = res["comparison"].first()
    assert r["model"] == "RandomForest" and 0 <= r["balanced_accuracy"] <= 1


def test_sweep_squared_silhouette_option(spark):
    from cadenza.operators import clusters
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(0, 1, (30, 3)), rng.normal(8, 1, (30, 3))])
    df = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(60)], "k long, v array<double>")
    res, _ = clusters.kmeans_sweep(df, "k", "v", [2, 3], n_init=2, silhouette="squared")
    assert res.columns == ["k", "inertia", "silhouette", "silhouette_squared", "n"]
    rows = {r["k"]: r for r in res.collect()}
    assert rows[2]["silhouette"] is None and rows[2]["silhouette_squared"] > 0.5
    assert clusters.best_k(res) == 2
