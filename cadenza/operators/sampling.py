"""Class support, weights, balancing, stratified split and spread samples.

Random choices are replaced by a deterministic hash order
``md5(seed|key)``: the same rows are chosen whatever the partitioning, and
the choice can be reproduced in SQL.

Skew: a single class may hold a third of all rows.  Taking "the first q rows
of a class in hash order" with one window per class would sort that third in
one task.  ``take_quota`` instead counts rows per (class, hash bucket) —
a partial aggregation — finds for every class the bucket where the quota is
reached, keeps every row of earlier buckets without any sort, and ranks only
the rows of that one boundary bucket (about n_class / 65536 rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions.exprs import hash_bucket, hash_key
from cadenza.functions.vocab import MIN_CLASS_SUPPORT, SEED, TEST_FRACTION
from cadenza.operators.ingest import fresh

_BUCKET_DIGITS = 4          # 16**4 = 65,536 hash buckets per class
#: Rows of a class table that may be broadcast to the fact rows.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20


def join_classes(facts: DataFrame, classes: DataFrame, cls: str, how: str) -> DataFrame:
    """Join a per-class table to the facts, null-safe on ``cls``.

    The class table is written once and measured; up to ``BROADCAST_ROWS`` rows
    and ``BROADCAST_BYTES`` of class names it is broadcast, so the facts are not
    shuffled and a hot class stays where its rows are.  A larger one is joined by a shuffle, whose hot partitions
    AQE splits.  Both give the same rows.
    """
    from cadenza.session import materialize
    own = fresh([*facts.columns, *classes.columns], "__cls")
    table = materialize(classes.withColumnRenamed(cls, own))
    rows, size = table.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.col(own).cast("string")))).first()
    side = F.broadcast(table) if rows <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES else table
    return facts.join(side, facts[cls].eqNullSafe(side[own]), how).drop(own)


def class_counts(df: DataFrame, cls: str) -> DataFrame:
    """Rows per class, largest first (ties by class name)."""
    return (df.groupBy(cls).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc(cls)))


def class_summary(df: DataFrame, cls: str) -> DataFrame:
    """One row: classes, median-count cap, smallest, largest, imbalance ratio."""
    counts = df.filter(F.col(cls).isNotNull()).groupBy(cls).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.count(F.lit(1)).alias("n_classes"),
        F.floor(F.percentile(F.col("n"), F.lit(0.5))).cast("long").alias("cap"),
        F.min("n").alias("min_n"),
        F.max("n").alias("max_n"),
        F.try_divide(F.max("n").cast("double"), F.min("n")).alias("imbalance"))


def support_filter(df: DataFrame, cls: str, min_support: int = MIN_CLASS_SUPPORT) -> DataFrame:
    """Keep rows of classes with at least ``min_support`` rows (semi join; the
    null class goes)."""
    valid = (df.groupBy(cls).agg(F.count(F.lit(1)).alias("__n"))
             .filter((F.col("__n") >= min_support) & F.col(cls).isNotNull()).select(cls))
    return join_classes(df, valid, cls, "left_semi")


def dropped_classes(df: DataFrame, cls: str, min_support: int = MIN_CLASS_SUPPORT) -> DataFrame:
    """Classes removed by the support filter, with their sizes."""
    return (df.groupBy(cls).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") < min_support).orderBy(F.desc("n"), F.asc(cls)))


def class_weights(df: DataFrame, cls: str, out_col: str = "weight") -> DataFrame:
    """Balanced sample weight n / (K * n_class) on every row."""
    counts = df.groupBy(cls).agg(F.count(F.lit(1)).alias("__nc"))
    every = Window.partitionBy()            # over the class table: one row per class
    w = counts.select(cls, (F.sum("__nc").over(every)
                            / (F.count(F.lit(1)).over(every) * F.col("__nc"))).alias(out_col))
    return join_classes(df, w.filter(F.col(cls).isNotNull()), cls, "left")


def take_quota(df: DataFrame, cls: str, quotas, order_key: str,
               flag_col: str | None = None) -> DataFrame:
    """Exact "first ``quota`` rows of each class in ``order_key`` order".

    ``quotas`` is a DataFrame ``(cls, quota)`` or a function from the class
    counts ``(cls, nc)`` to one; the counts come from the same per-bucket
    aggregation, so the input is counted once.  ``order_key`` is an md5 hex
    string column (uniform).  With ``flag_col`` every row is returned with a
    boolean flag instead of filtering.  See the module doc for the skew plan.
    """
    from cadenza.session import materialize
    # names of our own that no column of the caller has
    b_, nb, cum, q_, eb, need, take, qc = (fresh(df.columns, x) for x in (
        "__b", "__nb", "__cum", "__quota", "__eb", "__need", "__take", "__qc"))
    rows = df.withColumn(b_, hash_bucket(order_key, _BUCKET_DIGITS))
    # the aggregated counts (at most classes x 65,536 rows) feed the class
    # sizes, the quotas and the boundaries: checkpoint them once so the input
    # is counted in one pass and the rest reads the small table
    per_bucket = materialize(rows.groupBy(cls, b_).agg(F.count(F.lit(1)).alias(nb)))
    if callable(quotas):
        quotas = quotas(per_bucket.groupBy(cls).agg(F.sum(nb).alias("nc")))
    w = Window.partitionBy(cls).orderBy(b_).rowsBetween(Window.unboundedPreceding, 0)
    q = quotas.select(F.col(cls).alias(qc), F.col("quota").alias(q_))
    sums = per_bucket.withColumn(cum, F.sum(nb).over(w))
    sums = sums.join(q, sums[cls].eqNullSafe(q[qc]), "inner").drop(qc)   # null is a class too
    # per class: its quota and the boundary bucket (first bucket whose running
    # count reaches the quota) with the rows still needed from it
    reach = F.col(cum) >= F.col(q_)
    per_class = sums.groupBy(cls).agg(
        F.first(q_).alias(q_),
        F.min(F.when(reach, F.col(b_))).alias(eb),
        F.min_by(F.when(reach, F.col(q_) - F.col(cum) + F.col(nb)),
                 F.when(reach, F.col(b_))).alias(need))
    # one row per class: rows off the edge are decided without any row shuffle
    marked = join_classes(rows, per_class, cls, "left")
    no_quota = F.col(q_).isNull() | (F.col(q_) <= 0)
    at_edge = ~no_quota & F.col(eb).isNotNull() & (F.col(b_) == F.col(eb))
    # classes never reaching the quota have no edge: every row is taken
    before = ~no_quota & (F.col(eb).isNull() | (F.col(b_) < F.col(eb)))
    settled = marked.filter(~at_edge).withColumn(take, before)
    rank_w = Window.partitionBy(cls, b_).orderBy(order_key)
    edge_rows = marked.filter(at_edge).withColumn(
        take, F.row_number().over(rank_w) <= F.col(need))
    out = settled.unionByName(edge_rows).drop(b_, q_, eb, need)
    if flag_col:
        return out.withColumnRenamed(take, flag_col)
    return out.filter(take).drop(take)


def _median_cap() -> "F.Column":
    """Floor of the median class size, as a window over the class table."""
    return F.floor(F.percentile(F.col("nc"), F.lit(0.5)).over(Window.partitionBy())).cast("long")


def balance_classes(df: DataFrame, cls: str, key: str, seed: int = SEED,
                    cap: int | None = None) -> DataFrame:
    """Downsample every class to ``cap`` rows (default: floor of the median
    class size); smaller classes are kept whole; null class dropped.

    Class sizes, the median cap and the per-class quotas all derive from one
    per-bucket count, which runs (and is checkpointed) when this is called.
    """
    base = df.filter(F.col(cls).isNotNull())

    def quotas(counts: DataFrame) -> DataFrame:
        limit = _median_cap() if cap is None else F.lit(int(cap))
        return counts.select(cls, F.least(F.col("nc"), limit).alias("quota"))

    h = fresh(df.columns, "__h")
    return take_quota(base.withColumn(h, hash_key(seed, key)), cls, quotas, h).drop(h)


def quotas_from_counts(counts: DataFrame, cls: str, test_fraction: float = TEST_FRACTION) -> DataFrame:
    """Per-class test quota from class counts ``(cls, nc)``.

    As in the reference library: ``n_test = ceil(f * n)``; the training
    share ``n - n_test`` is allocated by largest remainder of
    ``nc / n * n_train`` (ties to the class that sorts first), and each class
    gives the rest of its rows to the test split.  Runs over the class table
    only (one row per class).
    """
    c = counts.withColumn("n", F.sum("nc").over(Window.partitionBy()))   # class table only
    n_test = F.ceil(F.lit(float(test_fraction)) * F.col("n"))
    c = c.withColumn("n_train", F.col("n") - n_test)
    exact = F.col("nc") / F.col("n") * F.col("n_train")   # same float order as the reference library
    c = c.withColumn("fl", F.floor(exact)).withColumn("rem", exact - F.floor(exact))
    w_all = Window.partitionBy()
    c = c.withColumn("left", F.col("n_train") - F.sum("fl").over(w_all))
    w_rank = Window.partitionBy().orderBy(F.desc("rem"), F.asc(cls))
    c = c.withColumn("r", F.row_number().over(w_rank))
    train = F.col("fl") + F.when(F.col("r") <= F.col("left"), 1).otherwise(0)
    return c.select(cls, (F.col("nc") - train).cast("long").alias("quota"))


def split_quotas(df: DataFrame, cls: str, test_fraction: float = TEST_FRACTION) -> DataFrame:
    """Per-class test quotas of a table (see ``quotas_from_counts``)."""
    counts = df.groupBy(cls).agg(F.count(F.lit(1)).alias("nc"))
    return quotas_from_counts(counts, cls, test_fraction)


def stratified_split(df: DataFrame, cls: str, key: str, test_fraction: float = TEST_FRACTION,
                     seed: int = SEED, out_col: str = "split") -> DataFrame:
    """Label every row 'test' or 'train': ``ceil(test_fraction * n)`` test rows
    in all; each class keeps its largest-remainder share of the training rows
    and gives the rest to test, chosen in hash order (``quotas_from_counts``)."""
    h, test = fresh(df.columns, "__h"), fresh(df.columns, "__t")
    flagged = take_quota(df.withColumn(h, hash_key(seed, key)), cls,
                         lambda counts: quotas_from_counts(counts, cls, test_fraction),
                         h, flag_col=test)
    return flagged.withColumn(out_col, F.when(F.col(test), "test").otherwise("train")).drop(test, h)


def spread_sample(df: DataFrame, cls: str, group: str, key: str, target: int = 100,
                  per_group: int = 2, seed: int = SEED) -> DataFrame:
    """Walk classes in shuffled order and groups (artists) inside them, take up
    to ``per_group`` random rows of each group, stop after ``target`` rows.

    ``row_number() <= per_group`` lets Spark insert a partial window-group
    limit before the shuffle, so a huge group ships only ``per_group`` rows
    per map task.  The final ``orderBy().limit()`` is a distributed top-k.
    """
    h = hash_key(seed, key)
    w = Window.partitionBy(cls, group).orderBy("__h", key)
    picked = (df.filter(F.col(cls).isNotNull()).withColumn("__h", h)
              .withColumn("pick_rank", F.row_number().over(w))
              .filter(F.col("pick_rank") <= per_group))
    picked = picked.withColumn("class_order", hash_key(seed, cls))
    return (picked.orderBy("class_order", cls, group, "pick_rank")
            .limit(target).drop("__h"))


def example_rows(df: DataFrame, key: str, n: int = 10, seed: int = SEED) -> DataFrame:
    """``n`` rows in deterministic pseudo-random order (distributed top-k)."""
    return df.withColumn("__h", hash_key(seed, key)).orderBy("__h", key).limit(n).drop("__h")
