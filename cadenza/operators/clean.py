"""Feature selection, IQR outlier fences and standardisation.

Fences and scaler statistics are aggregates over the whole table, computed
eagerly with a few small actions (one row per feature comes back to the
driver) and applied as literals, which lets Catalyst push the outlier
predicate into the Parquet scan.  Quantiles are exact without holding a
column in one buffer (see ``quantiles``).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from cadenza.functions.exprs import safe_scale
from cadenza.functions.vocab import DROP_FEATURES, IQR_THRESHOLD
from cadenza.operators.quantiles import _num, quantiles


def drop_features(df: DataFrame, cols: Iterable[str] = DROP_FEATURES) -> DataFrame:
    """Drop the listed columns that exist (missing ones are ignored)."""
    present = [c for c in cols if c in df.columns]
    return df.drop(*present)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns in schema order (``select_dtypes(np.number)``)."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in ex]


def iqr_fences(df: DataFrame, features: Sequence[str], threshold: float = IQR_THRESHOLD,
               method: str = "exact", accuracy: int = 10000) -> DataFrame:
    """Q1, Q3, IQR and fences per feature, long form (one row per feature).

    Quantiles interpolate linearly between order statistics (as pandas
    ``quantile``); NaN is treated as missing.  ``exact`` takes two scans
    whatever the number of features (``quantiles.quantiles``); ``approx`` is one
    ``percentile_approx`` sketch (not equal to the exact value).
    """
    probs = (0.25, 0.75)
    if method == "exact":
        q = quantiles(df, features, probs, accuracy=accuracy)
    elif method == "approx":
        wide = df.agg(*[F.percentile_approx(_num(c), F.array(*[F.lit(p) for p in probs]), accuracy).alias(f"f{i}")
                        for i, c in enumerate(features)])
        q = wide.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.lit(p).alias("prob"), F.get(F.col(f"f{i}"), F.lit(j)).alias("value"))
            for i, c in enumerate(features) for j, p in enumerate(probs)])).alias("s")).select("s.*")
    else:
        raise ValueError(f"unknown quantile method {method!r}")
    both = q.groupBy("feature").agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n)
                                      for n, p in (("q1", 0.25), ("q3", 0.75))])
    iqr = F.col("q3") - F.col("q1")
    return both.select("feature", "q1", "q3", iqr.alias("iqr"), (F.col("q1") - threshold * iqr).alias("lower"),
                       (F.col("q3") + threshold * iqr).alias("upper"))


def collect_fences(fences: DataFrame) -> dict[str, tuple[float, float]]:
    """Bring the (bounded: one row per feature) fence table to the driver."""
    return {r["feature"]: (r["lower"], r["upper"]) for r in fences.collect()}


def _inside(c: str, lo: float | None, hi: float | None, dtype=None):
    """Keep-predicate of one feature, written so Parquet can use it.

    Missing values are kept, and so are NaNs (pandas compares NaN as False).
    Integral features compare with integer bounds (``ceil(lo)``,
    ``floor(hi)``: same rows, no cast on the column), so the whole test is
    pushed to the scan.  For floating features ``x IS NULL OR x >= lo`` is
    pushed (NaN passes it: it sorts above every number) and the upper bound,
    which carries the NaN test, runs after the scan.
    """
    import math

    from pyspark.sql.types import DoubleType, FloatType, IntegralType
    x = F.col(c)
    if lo is None or hi is None:          # empty table: nothing is an outlier
        return F.lit(True)
    if isinstance(dtype, IntegralType):
        lo_i = F.lit(math.ceil(lo)).cast(dtype) if math.isfinite(lo) else None
        hi_i = F.lit(math.floor(hi)).cast(dtype) if math.isfinite(hi) else None
        rng = F.lit(True)
        if lo_i is not None:
            rng = x >= lo_i
        if hi_i is not None:
            rng = rng & (x <= hi_i)
        return x.isNull() | rng
    if dtype is not None and not isinstance(dtype, (DoubleType, FloatType)):
        return x.isNull() | ((x >= F.lit(lo)) & (x <= F.lit(hi)))
    return (x.isNull() | (x >= F.lit(lo))) & F.coalesce(F.isnan(x) | (x <= F.lit(hi)), F.lit(True))


def keep_predicate(fences: dict[str, tuple[float, float]], schema=None):
    pred = F.lit(True)
    for c, (lo, hi) in fences.items():
        dtype = schema[c].dataType if schema is not None and c in schema.fieldNames() else None
        pred = pred & _inside(c, lo, hi, dtype)
    return pred


def remove_outliers(df: DataFrame, features: Sequence[str], threshold: float = IQR_THRESHOLD,
                    fences: dict[str, tuple[float, float]] | None = None,
                    method: str = "exact") -> DataFrame:
    """Drop a row when any feature lies outside its inclusive fences.

    All fences come from the same, unfiltered input.  Null / NaN kept.
    """
    if fences is None:
        fences = collect_fences(iqr_fences(df, features, threshold, method))
    return df.filter(keep_predicate({c: fences[c] for c in features}, df.schema))


def outlier_report(df: DataFrame, features: Sequence[str], threshold: float = IQR_THRESHOLD,
                   fences: dict[str, tuple[float, float]] | None = None,
                   method: str = "exact") -> DataFrame:
    """One row: n_total, n_outliers, pct_outliers (0 for an empty input)."""
    if fences is None:
        fences = collect_fences(iqr_fences(df, features, threshold, method))
    keep = keep_predicate({c: fences[c] for c in features}, df.schema)
    agg = df.agg(F.count(F.lit(1)).alias("n_total"), F.count_if(~keep).alias("n_outliers"))
    return agg.withColumn(
        "pct_outliers",
        F.coalesce(F.try_divide(F.col("n_outliers") * F.lit(100.0), F.col("n_total")), F.lit(0.0)))


def feature_stats(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean and population standard deviation per feature, long form."""
    aggs = []
    for c in features:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"{c}__mean").alias("mean"),
                     F.col(f"{c}__std").alias("std")) for c in features]
    return wide.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def collect_stats(stats: DataFrame) -> dict[str, tuple[float, float]]:
    return {r["feature"]: (r["mean"], r["std"]) for r in stats.collect()}


def scale(df: DataFrame, features: Sequence[str],
          stats: dict[str, tuple[float, float]] | None = None,
          suffix: str = "") -> tuple[DataFrame, dict[str, tuple[float, float]]]:
    """Standardise features: (x - mean) / std, std = 0 -> 1.  Returns the stats
    (the fitted "scaler") so they can be reused and inverted."""
    if stats is None:
        stats = collect_stats(feature_stats(df, features))
    out = df
    for c in features:
        mu, sd = stats[c]
        out = out.withColumn(c + suffix, (F.col(c) - F.lit(mu)) / safe_scale(F.lit(sd)))
    return out, stats


def inverse_scale(df: DataFrame, features: Sequence[str],
                  stats: dict[str, tuple[float, float]], suffix: str = "") -> DataFrame:
    out = df
    for c in features:
        mu, sd = stats[c]
        out = out.withColumn(c + suffix, F.col(c) * safe_scale(F.lit(sd)) + F.lit(mu))
    return out
