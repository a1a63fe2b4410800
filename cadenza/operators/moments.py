"""Co-moments of vector columns in shared scans: correlations of hundreds of
features, principal components of tens of thousands.

A task turns its rows into matrix products and emits one flat array; Spark adds
the arrays place by place.  What reaches the driver depends on the number of
features alone: d * d numbers for all pairs, d * l for l wanted directions.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.vocab import SEED

# task functions travel by value: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Numbers of a vector column that a task holds at once.
HELD = 1 << 21


def width_of(df: DataFrame, vec: str) -> int:
    first = df.filter(F.col(vec).isNotNull()).select(F.size(vec).alias("d")).first()
    return 0 if first is None else first["d"]


def added(df: DataFrame, vec: str, d: int, size: int, part: Callable) -> np.ndarray:
    """The sum of ``part(x)`` (a flat array of ``size``) over all slices ``x`` of
    rows; nulls of ``vec`` are no rows, null components are NaN."""
    rows = max(1, HELD // max(1, d))

    def run(batches):
        total = np.zeros(size)
        for batch in batches:
            for a in range(0, batch.num_rows, rows):
                flat = batch.column("v").slice(a, rows).flatten()
                total += part(flat.to_numpy(zero_copy_only=False).reshape(-1, d))
        yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, size], pa.int32()), pa.array(total))], names=["s"])
    got = (df.filter(F.col(vec).isNotNull()).select(F.col(vec).cast("array<double>").alias("v")).mapInArrow(run, "s array<double>")
           .select(F.posexplode("s").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x")).toArrow())
    out = np.zeros(size)
    out[got.column("at").to_numpy()] = got.column("x").to_numpy()
    return out


def means(df: DataFrame, vec: str, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Non-missing rows and mean of every component."""
    s = added(df, vec, d, 2 * d, lambda x: np.concatenate([(~np.isnan(x)).sum(0), np.nansum(x, axis=0)]))
    return s[:d], np.divide(s[d:], s[:d], out=np.zeros(d), where=s[:d] > 0)


def correlations(df: DataFrame, vec: str) -> np.ndarray:
    """Pearson correlation of every pair of components over the rows where both
    are present (d x d; NaN where undefined): two scans for any d."""
    d = width_of(df, vec)
    _, mu = means(df, vec, d)

    def products(x):
        there = (~np.isnan(x)).astype(np.float64)
        c = np.where(there > 0, x - mu, 0.0)          # centred: no cancellation
        return np.concatenate([m.ravel() for m in (there.T @ there, c.T @ there, (c * c).T @ there, c.T @ c)])
    n, s, q, p = added(df, vec, d, 4 * d * d, products).reshape(4, d, d)
    with np.errstate(divide="ignore", invalid="ignore"):
        cov = p - s * s.T / n
        var = q - s * s / n
        out = cov / np.sqrt(var * var.T)
    return np.clip(np.where(np.isfinite(out), out, np.nan), -1, 1)


def principal_components(df: DataFrame, vec: str, k: int, extra: int = 10, rounds: int = 6, seed: int = SEED
                         ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first ``k`` principal directions (d x k), their variances and the mean,
    by block power iteration from random directions.

    A round is one scan that multiplies a block of k + ``extra`` directions by the
    covariance matrix, which is never formed: a task adds up ``X'(X Q)``, d x (k +
    extra) numbers.  Signs: the largest entry of a direction is positive.
    """
    d = width_of(df, vec)
    wide = min(d, k + extra)
    n, mu = means(df, vec, d)
    rows = n.max() if d else 0
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, wide)))
    values, turned = np.zeros(wide), q
    for _ in range(rounds):
        def times(x, q=q):
            c = x - mu
            return (c.T @ (c @ q)).ravel()
        z = added(df, vec, d, d * wide, times).reshape(d, wide) / max(rows - 1, 1)
        # Rayleigh-Ritz in the block: its best directions and their variances
        values, turn = np.linalg.eigh((q.T @ z + z.T @ q) / 2)
        order = np.argsort(values)[::-1]
        values, turned = values[order], q @ turn[:, order]
        q, _ = np.linalg.qr(z)
    top = turned[:, :k]
    top = top * np.where(top[np.abs(top).argmax(0), np.arange(top.shape[1])] >= 0, 1.0, -1.0)
    return top, values[:k], mu


def project(df: DataFrame, vec: str, directions: np.ndarray, mean: np.ndarray, out: str) -> DataFrame:
    """``df`` with the coordinates of the centred vectors along ``directions``."""
    @F.pandas_udf("array<double>")
    def along(v: pd.Series) -> pd.Series:
        real = v.notna()
        got = pd.Series([None] * len(v), index=v.index, dtype=object)
        if real.any():
            rows = (np.stack(v[real].to_numpy()).astype(np.float64) - mean) @ directions
            for i, r in zip(np.flatnonzero(real.to_numpy()), rows):
                got.iat[i] = r
        return got
    return df.withColumn(out, along(F.col(vec).cast("array<double>")))
