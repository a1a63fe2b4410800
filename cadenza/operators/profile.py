"""Exploratory summaries: correlations, box statistics, class profiles,
variance decomposition, top/bottom groups, totals.

Each is one aggregation pass producing a result whose size depends on the
number of features / classes, not on the row count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def corr_matrix(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Pearson correlation for every feature pair (i < j), long form."""
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i + 1:]]
    wide = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    rows = [F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"),
                     F.col(f"{a}__{b}").alias("corr")) for a, b in pairs]
    return wide.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def box_summary(df: DataFrame, cls: str, features: Sequence[str],
                threshold: float = 1.5) -> DataFrame:
    """Per class and feature: min, Q1, median, Q3, max and the IQR fences.

    Quantiles are exact (``quantiles.quantiles``: two scans for all classes
    and features, no class's values in one buffer); a null class is a class.
    """
    from cadenza.operators.quantiles import quantiles
    names = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    q = quantiles(df, features, list(names.values()), group=cls).groupBy(
        F.col(cls).alias("__c"), F.col("feature").alias("__f")).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for n, p in names.items()])
    mm = df.groupBy(cls).agg(*[F.min(c).cast("double").alias(f"{c}__min") for c in features],
                             *[F.max(c).cast("double").alias(f"{c}__max") for c in features])
    longs = [F.struct(F.lit(c).alias("feature"), F.col(f"{c}__min").alias("min"),
                      F.col(f"{c}__max").alias("max")) for c in features]
    mm = mm.select(cls, F.explode(F.array(*longs)).alias("s")).select(cls, "s.*")
    out = mm.join(q, F.col(cls).eqNullSafe(F.col("__c")) & (F.col("feature") == F.col("__f")), "left") \
            .select(cls, "feature", "min", "q1", "median", "q3", "max")
    iqr = F.col("q3") - F.col("q1")
    return out.withColumn("lower", F.col("q1") - threshold * iqr) \
              .withColumn("upper", F.col("q3") + threshold * iqr)


def class_profile(df: DataFrame, cls: str, features: Sequence[str]) -> DataFrame:
    """Mean of every feature per class (radar-chart data)."""
    return df.groupBy(cls).agg(F.count(F.lit(1)).alias("n"),
                               *[F.avg(c).alias(f"mean_{c}") for c in features])


def class_variance(df: DataFrame, cls: str, features: Sequence[str]) -> DataFrame:
    """Per class population variance of each feature, long form."""
    wide = df.groupBy(cls).agg(*[F.var_pop(c).alias(c) for c in features])
    rows = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("var_pop")) for c in features]
    return wide.select(cls, F.explode(F.array(*rows)).alias("s")).select(cls, "s.*")


def variance_split(df: DataFrame, cls: str, features: Sequence[str]) -> DataFrame:
    """Per feature: mean within-class variance and the variance of the class
    means (low between-class variance = non-discriminative feature)."""
    per = df.groupBy(cls).agg(*[F.var_pop(c).alias(f"{c}__v") for c in features],
                              *[F.avg(c).alias(f"{c}__m") for c in features])
    wide = per.agg(*[F.avg(f"{c}__v").alias(f"{c}__w") for c in features],
                   *[F.var_pop(f"{c}__m").alias(f"{c}__b") for c in features])
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"{c}__w").alias("within_var"),
                     F.col(f"{c}__b").alias("between_var")) for c in features]
    return wide.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def top_bottom(df: DataFrame, group: str, feature: str, n: int = 5) -> DataFrame:
    """Groups with the highest and lowest mean ``feature`` (ties by key).

    The per-group means are one aggregation; the two rankings run over that
    small table with global top-k (``orderBy().limit()``).
    """
    means = df.groupBy(group).agg(F.avg(feature).alias("mean"))
    top = means.orderBy(F.desc("mean"), F.asc(group)).limit(n)
    bot = means.orderBy(F.asc("mean"), F.asc(group)).limit(n)
    wt = Window.orderBy(F.desc("mean"), F.asc(group))
    wb = Window.orderBy(F.asc("mean"), F.asc(group))
    return (top.select(F.lit("top").alias("side"), F.row_number().over(wt).alias("rank"), group, "mean")
            .unionByName(bot.select(F.lit("bottom").alias("side"),
                                    F.row_number().over(wb).alias("rank"), group, "mean")))


def totals(df: DataFrame, group: str) -> DataFrame:
    """Distinct groups (artists) and rows (tracks)."""
    return df.agg(F.countDistinct(group).alias("n_groups"), F.count(F.lit(1)).alias("n_rows"))
