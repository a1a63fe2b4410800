"""CSV records whose quoted fields hold line breaks, from files read in splits.

Spark reads such files either line by line (records torn apart) or one whole
file per task.  Here every split is read by its own task: a line maps "inside a
quoted field or not" at its start to the same at its end, the maps of a split's
lines compose to one of four, and the state at each split's start follows from
those of the splits before it.  With that, every task cuts its own lines into
records; only the pieces of records that reach over a split's border meet again.

A quote opens a field only at the field's start, as in the common CSV dialect;
a doubled quote inside a quoted field is a quote.  A file that ends inside a
quoted field gives what it holds as its last record.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# task functions travel by value: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_FIELD = r'(?:"(?:[^"]|"")*+"[^,]*+|(?!")[^,]*+)'
#: A line that starts outside quotes and ends outside.
CLOSED = rf"(?s)^{_FIELD}(?:,{_FIELD})*+$"
_REST = re.compile(rf'(?s)(?:[^"]|"")*+"[^,]*+(?:,{_FIELD})*+\Z')
_WHOLE = re.compile(rf"(?s){_FIELD}(?:,{_FIELD})*+\Z")


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted field is open after ``line``, given that before it."""
    if '"' not in line:
        return inside
    if not inside:
        return _WHOLE.match(line) is None
    if _REST.match(line):
        return False
    # either no closing quote, or a later field that stays open
    return True


def lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The lines of all files with file_path, file_name and the split's start."""
    return (spark.read.option("lineSep", "\n").text(paths if isinstance(paths, str) else list(paths))
            .select("value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"),
                    F.col("_metadata.file_block_start").alias("blk")))


def closed(line: str | Column) -> Column:
    """True where a line is a record by itself if it starts outside quotes."""
    c = F.col(line) if isinstance(line, str) else line
    return ~F.contains(c, F.lit('"')) | c.rlike(CLOSED)


def broken_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Files with a line that is no record by itself (JVM only, one scan)."""
    return lines(spark, paths).filter(~closed("value")).select("file_path").distinct()


def _split_maps(rows: DataFrame) -> DataFrame:
    """file_path, blk and the state at the split's end for both states at its start."""
    def run(batches):
        key, state, out = None, None, []
        for batch in batches:
            for value, path, blk in zip(*[batch.column(c).to_pylist() for c in ("value", "file_path", "blk")]):
                if (path, blk) != key:
                    if key is not None:
                        out.append((*key, *state))
                    key, state = (path, blk), (False, True)
                state = (ends_inside(value, state[0]), ends_inside(value, state[1]) if state[0] != state[1] else ends_inside(value, state[0]))
        if key is not None:
            out.append((*key, *state))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["file_path", "blk", "from_out", "from_in"])
    return rows.mapInArrow(run, "file_path string, blk long, from_out boolean, from_in boolean")


def split_states(rows: DataFrame) -> DataFrame:
    """file_path, blk, inside: whether the split starts inside a quoted field.

    Maps compose like this: a constant one sets the state, a swap turns it; the
    state is the last constant before, turned by the swaps since.
    """
    by = Window.partitionBy("file_path").orderBy("blk")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    same = F.col("from_out") == F.col("from_in")
    swap = (F.col("from_out") & ~F.col("from_in")).cast("int")
    got = _split_maps(rows).withColumn("turns", F.sum(swap).over(by))
    last = F.last(F.when(same, F.struct(F.col("from_out").alias("state"), F.col("turns").alias("at"))), ignorenulls=True).over(before)
    got = got.withColumn("before", F.coalesce(F.col("turns") - swap, F.lit(0))).withColumn("set", last)
    since = (F.col("before") - F.coalesce(F.col("set.at"), F.lit(0))) % 2
    return got.select("file_path", "blk", (F.coalesce(F.col("set.state"), F.lit(False)).cast("int") + since == 1).alias("inside"))


def records(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """file_path, file_name, blk, pos, record: every record with the split and
    place where it starts; line breaks inside quotes are kept as written."""
    rows = lines(spark, paths)
    # one row per split of some 100 MB
    states = split_states(rows.select("value", "file_path", "blk"))
    own = rows.join(F.broadcast(states), ["file_path", "blk"])

    def run(batches):
        key, inside, held, pos, start, first = None, False, [], 0, 0, True

        def piece(kind):
            return (*key, start, kind, "\n".join(held))
        for batch in batches:
            out = []
            for value, path, name, blk, was in zip(*[batch.column(c).to_pylist() for c in ("value", "file_path", "file_name", "blk", "inside")]):
                if (path, name, blk) != key:
                    if held:
                        out.append(piece("between" if first and opened else "open"))
                    key, inside, held, pos, start, first, opened = (path, name, blk), was, [], 0, 0, was, was
                if not held:
                    start = pos
                held.append(value)
                pos += 1
                inside = ends_inside(value, inside)
                if not inside:
                    # the first piece of a split that starts inside closes an older record
                    out.append(piece("end" if first else "whole"))
                    held, first = [], False
            if out:
                yield _table(out)
        if held:
            yield _table([piece("between" if first and opened else "open")])

    pieces = own.select("value", "file_path", "file_name", "blk", "inside").mapInArrow(
        run, "file_path string, file_name string, blk long, pos long, kind string, record string")
    whole = pieces.filter("kind = 'whole'").drop("kind")
    # pieces over borders: each belongs to the last record opened before it
    by = Window.partitionBy("file_path").orderBy("blk", "pos")
    torn = pieces.filter("kind != 'whole'").withColumn(
        "opened", F.last(F.when(F.col("kind") == "open", F.struct("blk", "pos")), ignorenulls=True).over(by))
    joined = (torn.groupBy("file_path", "file_name", "opened")
              .agg(F.array_sort(F.collect_list(F.struct("blk", "pos", "record"))).alias("p"))
              .select("file_path", "file_name", F.col("opened.blk").alias("blk"), F.col("opened.pos").alias("pos"),
                      F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record")))
    return whole.unionByName(joined).withColumn("record", F.regexp_replace("record", r"\r$", ""))


def _table(rows):
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["file_path", "file_name", "blk", "pos", "kind", "record"])
