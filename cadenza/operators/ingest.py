"""Collection-side operators: dedupe, caps, batching, first-label-wins,
lookup joins with status, incremental anti joins.

"First" always means smallest explicit ordinal (page number, position,
label order); nothing relies on row order or monotonically increasing ids.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions.exprs import norm_key
from cadenza.functions.vocab import LOOKUP_BATCH, SEARCH_CAP


#: Items on more than one of so many rows are heavy.
HEAVY = 1000


def fresh(columns: Sequence[str], name: str) -> str:
    """``name``, with underscores appended until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def _cols(cs):
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def name_key(name_col: str) -> Column:
    """Dedupe key of a (possibly very long) name: sha-256 of lower+strip.

    The whole text is hashed; grouping shuffles 32 bytes instead of the text.
    """
    return F.sha2(norm_key(name_col), 256)


def first_occurrence(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str]) -> DataFrame:
    """Keep the first row (smallest ``order``) of every key.

    One aggregation with ``min_by`` (partial aggregation before the shuffle:
    a hot key ships one candidate per map task, not all its rows).
    """
    cols = df.columns
    return (df.groupBy(*_cols(keys))
            .agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("__r"))
            .select("__r.*"))


def dedupe_by_name(df: DataFrame, group: Sequence[str], name_col: str,
                   order: Sequence[str], keep_name: bool = True) -> DataFrame:
    """First occurrence per (group, normalised name) in arrival order.

    ``keep_name=False`` drops the name before the shuffle (only its hash
    travels), for long texts whose value is not needed downstream.
    """
    keyed = df.withColumn("__nk", name_key(name_col))
    if not keep_name:
        keyed = keyed.drop(name_col)
    return first_occurrence(keyed, [*group, "__nk"], order).drop("__nk")


def cap_per_group(df: DataFrame, group: Sequence[str], order: Sequence[str],
                  cap: int | None = SEARCH_CAP, ordinal_col: str | None = None,
                  ordinal_limit: int | None = None, rank_col: str = "rank") -> DataFrame:
    """First ``cap`` rows per group by ``order``; optionally only rows whose
    source ordinal is below ``ordinal_limit`` (results the source serves).

    ``cap=None`` means unlimited; ``cap=0`` is rejected (ambiguous).  The
    ``row_number() <= cap`` filter is planned with a partial window-group
    limit before the shuffle, so a hot group ships at most ``cap`` rows per
    map task.
    """
    if cap is not None and cap <= 0:
        raise ValueError("cap must be positive or None (unlimited)")
    out = df
    if ordinal_col is not None and ordinal_limit is not None:
        out = out.filter(F.col(ordinal_col) < ordinal_limit)
    if cap is None:                      # every row ranked: no window over a whole group
        return rank_in_group(out, group, order, rank_col)
    w = Window.partitionBy(*group).orderBy(*order)
    return out.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= cap)


def running_sum(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str | Column,
                out: str, partitions: int | None = None) -> DataFrame:
    """Inclusive running sum of ``value`` within each group by ``order``, for
    groups of any size: a group is never sorted in one task.

    Rows are range-partitioned on (group, order), so a huge group spreads
    over many partitions in order.  Sums per (partition, group) are taken
    (a small table), prefix sums over partitions give each chunk's offset,
    and every chunk is summed locally.  ``order`` must make rows unique
    within a group for the sums to be deterministic.  A null group is a group.
    """
    from cadenza.session import materialize
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    pid, part, off, run = (fresh(df.columns, x) for x in ("__pid", "__p", "__off", "__run"))
    keys = [fresh(df.columns, f"__g{i}") for i in range(len(group))]
    v = F.col(value) if isinstance(value, str) else value
    # The range boundaries come from a sample, so the ranged rows are written
    # once, with their chunk, and sums and chunks read the same rows.
    ranged = materialize(df.repartitionByRange(n, *group, *order).withColumn(pid, F.spark_partition_id()))
    chunks = ranged.groupBy(pid, *group).agg(F.sum(v).alias(off))
    before = Window.partitionBy(*group).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    offsets = chunks.select(F.col(pid).alias(part), *[F.col(g).alias(k) for g, k in zip(group, keys)],
                            F.coalesce(F.sum(off).over(before), F.lit(0)).alias(off))
    local = Window.partitionBy(pid, *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    same = F.col(pid) == F.col(part)
    for g, k in zip(group, keys):
        same = same & F.col(g).eqNullSafe(F.col(k))
    return (ranged.withColumn(run, F.sum(v).over(local)).join(offsets, same, "inner")
            .withColumn(out, F.col(off) + F.col(run)).drop(pid, part, run, off, *keys))


def rank_in_group(df: DataFrame, group: Sequence[str], order: Sequence[str],
                  rank_col: str = "rank", partitions: int | None = None) -> DataFrame:
    """1-based ``row_number`` within each group by ``order``, for groups of any
    size (``running_sum`` of ones)."""
    return running_sum(df, group, order, F.lit(1), rank_col, partitions)


def soft_cap(df: DataFrame, group: Sequence[str], unit: str, unit_order: Sequence[str],
             cap: int) -> DataFrame:
    """Keep whole units (albums) in order while fewer than ``cap`` rows were
    taken before the unit: the last unit may overshoot the cap.

    Rows are counted per (group, unit) first; the running sum over that table
    splits a group of many units over tasks (``running_sum``), and the kept
    units are semi-joined back.  Null groups and units are groups and units.
    """
    n = fresh(df.columns, "__nu")
    upto = fresh(df.columns, "__upto")
    order = [*unit_order, *([] if unit in unit_order else [unit])]
    per_unit = df.groupBy(*group, unit, *[c for c in unit_order if c != unit]) \
                 .agg(F.count(F.lit(1)).alias(n))
    names = {c: fresh(df.columns, f"__k{i}") for i, c in enumerate([*group, unit])}
    kept = (running_sum(per_unit, group, order, n, upto).filter(F.col(upto) - F.col(n) < cap)
            .select(*[F.col(c).alias(k) for c, k in names.items()]))
    same = [F.col(c).eqNullSafe(F.col(k)) for c, k in names.items()]
    return df.join(kept, functools.reduce(lambda x, y: x & y, same), "left_semi")


def batch_numbers(df: DataFrame, group: Sequence[str], rank_col: str = "rank",
                  size: int = LOOKUP_BATCH, out: str = "batch_no") -> DataFrame:
    """Batch number ``floor((rank - 1) / size)`` from a 1-based rank."""
    return df.withColumn(out, F.floor((F.col(rank_col) - 1) / size).cast("long"))


def batches(df: DataFrame, group: Sequence[str], id_col: str, rank_col: str = "rank",
            size: int = LOOKUP_BATCH) -> DataFrame:
    """One row per lookup batch: ids in rank order (at most ``size`` each)."""
    b = batch_numbers(df, group, rank_col, size)
    return b.groupBy(*group, "batch_no").agg(
        F.count(F.lit(1)).alias("n_ids"),
        F.transform(F.array_sort(F.collect_list(F.struct(rank_col, id_col))),
                    lambda s: s[id_col]).alias("ids"))


def first_hit(df: DataFrame, query_col: str, pos_col: str, value: str | Column,
              out: str = "hit") -> DataFrame:
    """First search result per query (``items[0]``): value at the smallest position."""
    v = F.col(value) if isinstance(value, str) else value
    return df.groupBy(query_col).agg(F.min_by(v, F.col(pos_col)).alias(out))


def first_label_wins(df: DataFrame, item: str, label: str) -> DataFrame:
    """Labels are processed in sorted order; an item already seen under an
    earlier label is not taken by a later one.  Duplicates of the item inside
    its first label all survive.  A null item is an item like any other; rows
    without a label are not taken.

    The per-item minimum is a partial aggregation, and so is the count by which
    heavy items are found: those on more than 1 / ``HEAVY`` of the rows, fewer
    than ``HEAVY`` of them, meet their rows by a broadcast; the others' rows are
    shuffled by the item.
    """
    first, key, n = (fresh(df.columns, x) for x in ("__first", "__item", "__n"))
    per_item = df.groupBy(F.col(item).alias(key)).agg(F.min(label).alias(first), F.count(F.lit(1)).alias(n))
    rows = df.count()
    heavy = per_item.filter(F.col(n) * HEAVY > F.lit(rows)).drop(n)
    light = per_item.filter(F.col(n) * HEAVY <= F.lit(rows)).drop(n)
    won = F.col(item).eqNullSafe(F.col(key)) & (F.col(label) == F.col(first))
    # one column per heavy item decides where a row goes
    hot = df.join(F.broadcast(heavy), won, "inner")
    cold = df.join(F.broadcast(heavy.select(key)), F.col(item).eqNullSafe(F.col(key)), "left_anti").join(light, won, "inner")
    return hot.unionByName(cold).drop(key, first)


def label_stats(candidates: DataFrame, kept: DataFrame, label: str, playlist: str,
                has_features: str | Column, all_labels: DataFrame | None = None) -> DataFrame:
    """Per label: playlists found, new rows taken, rows with features; zero
    for labels that got nothing."""
    feat = F.col(has_features) if isinstance(has_features, str) else has_features
    labels_ = all_labels if all_labels is not None else candidates.select(label).distinct()
    pl = candidates.groupBy(label).agg(F.countDistinct(playlist).alias("n_playlists"))
    tr = kept.groupBy(label).agg(F.count(F.lit(1)).alias("n_tracks"),
                                 F.count_if(feat).alias("n_with_features"))
    return (labels_.join(pl, label, "left").join(tr, label, "left")
            .na.fill(0, ["n_playlists", "n_tracks", "n_with_features"]))


def lookup_status(items: DataFrame, id_map: DataFrame, item_key: str, map_key: str,
                  features: DataFrame, feat_key: str, ext_col: str) -> DataFrame:
    """Every item with a status: 'no_id' (no external id), 'no_features'
    (id found, no feature row) or 'collected'.  Two left joins, no anti pass."""
    m = id_map.select(F.col(map_key).alias("__mk"), F.col(ext_col).alias("__ext"),
                      F.lit(True).alias("__has_id"))
    f = features.select(F.col(feat_key).alias("__fk"), F.lit(True).alias("__has_f"))
    j = items.join(m, items[item_key] == m["__mk"], "left")
    j = j.join(f, j["__ext"] == f["__fk"], "left")
    status = (F.when(F.col("__has_id").isNull(), F.lit("no_id"))
              .when(F.col("__has_f").isNull(), F.lit("no_features"))
              .otherwise(F.lit("collected")))
    return j.withColumn("status", status).drop("__mk", "__ext", "__has_id", "__fk", "__has_f")


def status_counts(df: DataFrame, status: str = "status") -> DataFrame:
    return df.groupBy(status).agg(F.count(F.lit(1)).alias("n"))


def pending(roster: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Roster entries not yet collected (bag semantics, ``left_anti``)."""
    return roster.join(done.select(key), on=key, how="left_anti")
