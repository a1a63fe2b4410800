"""Correlations and principal directions against numpy."""

import numpy as np

from cadenza.operators import moments


def frame(spark, x, parts=3):
    rows = [(i, [None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, v array<double>").repartition(parts)


def test_correlations_with_missing_values(spark, monkeypatch):
    rng = np.random.default_rng(0)
    x = rng.normal(1e6, 1, (400, 7)) @ rng.normal(0, 1, (7, 7))
    x[:, 6] = 3.0                                   # constant: undefined
    x[rng.random(x.shape) < 0.1] = np.nan
    import pandas as pd
    want = pd.DataFrame(x).corr().to_numpy()
    for held in (1 << 21, 50):
        monkeypatch.setattr(moments, "HELD", held)
        got = moments.correlations(frame(spark, x), "v")
        assert np.allclose(got[:6, :6], want[:6, :6], atol=1e-8) and np.isnan(got[6]).all()


def test_principal_directions_of_wide_vectors(spark):
    rng = np.random.default_rng(1)
    base, _ = np.linalg.qr(rng.normal(size=(3000, 4)))
    x = rng.normal(size=(120, 4)) * [50, 30, 20, 10] @ base.T + rng.normal(0, 0.05, (120, 3000)) + 7
    top, values, mu = moments.principal_components(frame(spark, x), "v", 4)
    c = x - x.mean(0)
    _, s, vt = np.linalg.svd(c, full_matrices=False)
    assert np.allclose(mu, x.mean(0)) and np.allclose(values, s[:4] ** 2 / 119, rtol=1e-8)
    assert np.allclose(np.abs(np.sum(top * vt[:4].T, axis=0)), 1, atol=1e-8)
    p = moments.project(frame(spark, x), "v", top, mu, "p").orderBy("id").collect()
    assert np.allclose(np.array([r["p"] for r in p]), c @ top, atol=1e-6)
    assert (top[np.abs(top).argmax(0), np.arange(4)] > 0).all()


def test_null_and_no_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, None), (3, [2.0, 1.0])], "id long, v array<double>")
    assert np.allclose(moments.correlations(df, "v"), [[1, -1], [-1, 1]])
    assert moments.correlations(df.filter("id = 2"), "v").shape == (0, 0)
    assert moments.project(df, "v", np.eye(2), np.zeros(2), "p").filter("p is null").count() == 1
