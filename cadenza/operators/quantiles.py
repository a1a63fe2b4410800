"""Exact quantiles of any number of features and groups in two scans.

The first scan takes, per group and feature, a quantile sketch: two values that
bracket every wanted quantile.  The second counts, for every bracket, the rows
below it, keeps each distinct value inside it with its count, and the nearest
value on either side.  Both scans are partial aggregations, so a hot group is
combined where its rows are, and no values are collected.  The ranks of the
values inside a bracket are running counts: over the bracket where the sketch
proves that it holds at most ``WINDOW_ROWS`` rows, else over range-split chunks
of it, so that no task sorts more than its share.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.operators.ingest import running_sum

#: Bracket rows (groups x features x quantiles) that may be broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20
#: Rows of a bracket whose running counts may be taken by one task.
WINDOW_ROWS = 1_000_000


def _num(c: str):
    """Feature as double with NaN -> null (pandas skips NaN in quantiles;
    Spark would sort NaN above every number)."""
    x = F.col(c).cast("double")
    return F.when(F.isnan(x), F.lit(None)).otherwise(x)


def quantiles(df: DataFrame, features: Sequence[str], probs: Sequence[float],
              group: str | None = None, accuracy: int = 10_000) -> DataFrame:
    """One row per (group,) feature and prob with the exact ``value``, linearly
    interpolated between order statistics; null where a group has no number.

    A null group is a group.  The sketch's error is at most ``1 / accuracy`` of
    the rows and the bracket is three times as wide; should a bracket ever miss
    its rank the query fails instead of giving a wrong value.
    """
    from cadenza.session import materialize
    key = F.lit(0) if group is None else F.col(group)
    near = [(max(0.0, p - 3.0 / accuracy), min(1.0, p + 3.0 / accuracy)) for p in probs]
    sketch = df.groupBy(*([] if group is None else [key.alias("g")])).agg(*[
        F.struct(F.count(_num(c)).alias("n"), F.percentile_approx(
            _num(c), F.array(*[F.lit(f) for pair in near for f in pair]), accuracy).alias("q")).alias(f"f{i}")
        for i, c in enumerate(features)])
    if group is None:
        sketch = sketch.withColumn("g", F.lit(0))
    brackets = [F.struct(F.lit(i).alias("f"), F.lit(j).alias("j"), F.col(f"f{i}.n").alias("n"),
                         F.get(F.col(f"f{i}.q"), F.lit(2 * j)).alias("lo"), F.get(F.col(f"f{i}.q"), F.lit(2 * j + 1)).alias("hi"))
                for i in range(len(features)) for j in range(len(probs))]
    table = materialize(sketch.select("g", F.explode(F.array(*brackets)).alias("b")).select("g", "b.*"))

    values = df.select(key.alias("vg"), F.explode(F.array(*[
        F.struct(F.lit(i).alias("vf"), _num(c).alias("x")) for i, c in enumerate(features)])).alias("v")).select(
        "vg", "v.*").filter("x is not null")
    n_brackets, largest, size = table.agg(F.count(F.lit(1)), F.max("n"), F.sum(F.octet_length(F.col("g").cast("string")))).first()
    small = n_brackets <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES
    dim = F.broadcast(table) if small else table
    side = F.when(F.col("x") < F.col("lo"), -1).when(F.col("x") > F.col("hi"), 1).otherwise(0)
    seen = (values.join(dim, F.col("vg").eqNullSafe(F.col("g")) & (F.col("vf") == F.col("f")))
            .groupBy("g", "f", "j", "n", side.alias("side"), F.when(side == 0, F.col("x")).alias("inside"))
            .agg(F.count(F.lit(1)).alias("c"), F.min("x").alias("low"), F.max("x").alias("high")))
    # in value order: all rows below count once, at the largest of them
    if (largest or 0) * 8 / accuracy <= WINDOW_ROWS:
        by = Window.partitionBy("g", "f", "j").orderBy("side", "inside")
        ranked = seen.withColumn("upto", F.sum("c").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    else:
        ranked = running_sum(seen, ["g", "f", "j"], ["side", "inside"], "c", "upto")
    prob = F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("j") + 1)
    pos = (F.col("n") - 1) * prob
    k0 = F.floor(pos)
    k1 = F.least(k0 + 1, F.col("n") - 1)

    def at(k):
        """Value of the k-th row (from 0): known inside the bracket and right
        beside it."""
        first = F.col("upto") - F.col("c")
        holds = (F.col("upto") > k) & (first <= k)
        beside = ((F.col("side") == -1) & (F.col("upto") - 1 == k)) | ((F.col("side") == 1) & (first == k))
        value = F.when(F.col("side") == -1, F.col("high")).when(F.col("side") == 1, F.col("low")).otherwise(F.col("inside"))
        return F.max(F.when(holds & ((F.col("side") == 0) | beside), value))

    got = (ranked.withColumn("k0", k0).withColumn("k1", k1).withColumn("pos", pos)
           .groupBy("g", "f", "j", "n", "k0", "k1", "pos").agg(at(F.col("k0")).alias("v0"), at(F.col("k1")).alias("v1")))
    missed = F.raise_error(F.lit("a quantile lies outside its bracket"))
    exact = (F.when(F.col("v0").isNull(), missed).when(F.col("k0") == F.col("k1"), F.col("v0"))
             .when(F.col("pos") == F.col("k0"), F.col("v0")).when(F.col("v1").isNull(), missed)
             .otherwise((F.col("k1") - F.col("pos")) * F.col("v0") + (F.col("pos") - F.col("k0")) * F.col("v1")))
    got = got.select(F.col("g").alias("vg"), F.col("f").alias("vf"), F.col("j").alias("vj"), exact.alias("value"))
    out = table.join(got, F.col("g").eqNullSafe(F.col("vg")) & (F.col("f") == F.col("vf")) & (F.col("j") == F.col("vj")), "left")
    name = F.element_at(F.array(*[F.lit(c) for c in features]), F.col("f") + 1)
    cols = [name.alias("feature"), prob.alias("prob"), "value"]
    return out.select(*([] if group is None else [F.col("g").alias(group)]), *cols)
