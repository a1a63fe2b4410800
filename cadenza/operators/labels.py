"""Label dimension: join, lookup with default, primary label, consolidation.

The label dimension (artist -> genre list) is joined without a broadcast
hint: with AQE on, Spark measures the dimension at runtime and broadcasts it
only when it is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``; a
large dimension falls back to a sort-merge join instead of failing.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.exprs import (
    consolidate, first_token, is_missing_label, split_tokens,
)
from cadenza.functions.vocab import GENRE_CONSOLIDATION, MISSING_LABEL


def attach_labels(facts: DataFrame, labels: DataFrame, fact_key: str = "artist_name",
                  label_key: str = "artist_name", label_col: str = "genre",
                  out_col: str = "genres", extra_cols: Sequence[str] = ()) -> DataFrame:
    """Case-insensitive left join fact -> label dimension (fan-out on dup keys).

    Matching is ``lower`` only (no trim, no accent folding).  The join key is
    not kept; the label column is renamed to ``out_col``; ``extra_cols`` of
    the dimension (e.g. labels already consolidated there) come along.
    """
    dim = labels.select(F.lower(F.col(label_key)).alias("__lk"),
                        F.col(label_col).alias(out_col), *extra_cols)
    joined = facts.join(dim, F.lower(facts[fact_key]) == dim["__lk"], "left")
    return joined.drop("__lk")


def keep_labelled(df: DataFrame, col: str = "genres",
                  missing: Iterable[str] = (MISSING_LABEL,)) -> DataFrame:
    """Rows whose label is present (not null, not empty, not a missing marker)."""
    return df.filter(~is_missing_label(col, missing))


def label_drop_report(df: DataFrame, col: str = "genres",
                      missing: Iterable[str] = (MISSING_LABEL,)) -> DataFrame:
    """One row: rows before, rows kept, rows dropped for lack of a label."""
    miss = is_missing_label(col, missing)
    return df.agg(F.count(F.lit(1)).alias("n_total"),
                  F.count_if(~miss).alias("n_labelled"),
                  F.count_if(miss).alias("n_dropped"))


def lookup_with_default(df: DataFrame, dim: DataFrame, key: str, dim_key: str,
                        value_col: str, out_col: str,
                        default: str = MISSING_LABEL,
                        order_col: str | None = None) -> DataFrame:
    """Dictionary lookup ``d.get(lower(key), default)``; last duplicate wins.

    Duplicate keys in the dimension are first reduced to one value per key
    (partial aggregation, no sort), so the lookup never fans out.  "Last" is
    the largest ``order_col`` (an explicit file/row ordinal); without one the
    largest value is taken so the result stays deterministic.
    """
    order = F.col(order_col) if order_col else F.col(value_col)
    d = (dim.groupBy(F.lower(F.col(dim_key)).alias("__lk"))
         .agg(F.max_by(F.col(value_col), order).alias("__v")))
    out = df.join(d, F.lower(df[key]) == d["__lk"], "left")
    return out.withColumn(out_col, F.coalesce(F.col("__v").cast("string"), F.lit(default))) \
        .drop("__lk", "__v")


def primary_label(df: DataFrame, col: str = "genres_consolidated",
                  out_col: str = "primary_genre") -> DataFrame:
    """First token of the label list, stripped (single-label evaluation)."""
    return df.withColumn(out_col, first_token(col))


def consolidate_labels(df: DataFrame, col: str = "genres",
                       mapping: Mapping[str, str] = GENRE_CONSOLIDATION,
                       out_col: str = "genres_consolidated") -> DataFrame:
    """Map subgenres to families with order-keeping dedupe, joined with ', '."""
    return df.withColumn(out_col, consolidate(col, mapping))


def distinct_tokens(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-empty tokens of a label-list column, sorted."""
    return (df.select(F.explode(split_tokens(col, keep_empty=False)).alias("token"))
            .distinct().orderBy("token"))


def token_counts(df: DataFrame, before_col: str = "genres",
                 after_col: str = "genres_consolidated", approx: bool = False) -> DataFrame:
    """Distinct token count before and after consolidation (one row).

    Both counts come from one scan: tokens are exploded once with a tag
    telling which column they came from, then counted per tag.
    """
    tagged = df.select(F.explode(F.array(
        F.struct(F.lit("before").alias("side"), F.col(before_col).alias("v")),
        F.struct(F.lit("after").alias("side"), F.col(after_col).alias("v")),
    )).alias("s")).select("s.side", F.explode(split_tokens("s.v", keep_empty=False)).alias("t"))
    if approx:
        counted = tagged.groupBy("side").agg(F.approx_count_distinct("t").alias("n"))
    else:
        counted = tagged.groupBy("side").agg(F.countDistinct("t").alias("n"))
    return counted.agg(
        F.coalesce(F.max(F.when(F.col("side") == "before", F.col("n"))), F.lit(0)).alias("n_before"),
        F.coalesce(F.max(F.when(F.col("side") == "after", F.col("n"))), F.lit(0)).alias("n_after"))


def unique_label_tokens(labels: DataFrame, col: str = "genre", sep: str = ", ",
                        missing: Iterable[str] = (MISSING_LABEL,)) -> DataFrame:
    """Sorted unique label tokens of the label file; empty and missing skipped."""
    kept = labels.filter(~is_missing_label(col, missing))
    toks = kept.select(F.explode(split_tokens(col, sep, keep_empty=False)).alias("genre"))
    return toks.distinct().orderBy("genre")


def duplicate_keys(labels: DataFrame, key: str = "artist_name") -> DataFrame:
    """Label keys that occur more than once after lower-casing (fan-out check)."""
    return (labels.groupBy(F.lower(F.col(key)).alias("key"))
            .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))
