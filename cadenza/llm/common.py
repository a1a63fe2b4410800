"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.session import ensure_checkpoint_dir, read_table

__all__ = ["MIX1", "MIX2", "WHITE", "adam", "anti", "arrow_map", "byte_hashes", "held_out", "joined", "lowest", "mix64",
           "possibly", "read_table", "release", "released", "row_chunks", "saved", "semi", "sigmoid", "tables", "temperature", "text_batches", "texts_of",
           "training_rows", "work_path"]

#: ASCII white space of the contracts: space and tab to carriage return.
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

MIX1 = np.uint64(0xFF51AFD7ED558CCD)
MIX2 = np.uint64(0xC4CEB9FE1A85EC53)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)


def work_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder of ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back (lineage is cut)."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tables(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names, so that further
    columns of the caller can't clash."""
    return df.select(*[F.col(f"`{c}`").alias(name) for name, c in columns.items()])


#: Bitmaps of 32,768 bits in a key filter: 4 MB in all, whatever the input.
FILTER_MAPS = 1024


def possibly(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """``rows`` with a column ``__maybe``: false where the key is surely not
    among ``keys``.

    The keys' hashes fill at most FILTER_MAPS bitmaps, the only thing that is
    broadcast; rows without a chance need not travel to a join.  With many more
    keys than bits ever more rows pass, and nothing is lost.
    """
    def bits(name: str) -> tuple[Column, Column]:
        h = F.xxhash64(name)
        return F.pmod(h, F.lit(FILTER_MAPS)), F.pmod(F.shiftright(h, 24), F.lit(32768))
    table = (keys.select(*[c.alias(n) for c, n in zip(bits(on), ("__map", "__bit"), strict=True)])
             .groupBy("__map").agg(F.bitmap_construct_agg("__bit").alias("__bits")))
    bucket, bit = bits(on)
    byte = F.conv(F.hex(F.substring(F.col("__bits"), (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return rows.withColumn("__map", bucket).join(F.broadcast(table), "__map", "left").withColumn(
        "__maybe", F.coalesce(byte.bitwiseAND(F.pow(F.lit(2), F.pmod(bit, F.lit(8))).cast("int")) != 0,
                              F.lit(False))).drop("__map", "__bits")


def semi(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is among ``keys``; only possible ones are shuffled."""
    return possibly(rows, keys, on).filter("__maybe").drop("__maybe").join(keys.select(on), on, "left_semi")


def anti(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is not among ``keys``; only doubtful ones are shuffled."""
    marked = possibly(rows, keys, on)
    return marked.filter("not __maybe").drop("__maybe").unionByName(
        marked.filter("__maybe").drop("__maybe").join(keys.select(on), on, "left_anti"))


def texts_of(batch: pa.RecordBatch | pa.Table, name: str) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    col = batch.column(name)
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return [b"" if x is None else x for x in col.cast(pa.large_binary()).to_pylist()]


def row_chunks(sizes: list[int], most: int) -> Iterator[slice]:
    """Slices of consecutive rows of at most ``most`` bytes (one row at least),
    so that the working arrays of a task stay bounded."""
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > most:
            yield slice(start, i)
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield slice(start, len(sizes))


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array, a space after each, and their starts."""
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    sizes = np.fromiter((len(x) + 1 for x in texts), dtype=np.int64, count=len(texts))
    return data, np.cumsum(sizes) - sizes


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64."""
    x = x ^ (x >> np.uint64(33))
    x = x * MIX1
    x = x ^ (x >> np.uint64(33))
    x = x * MIX2
    return x ^ (x >> np.uint64(33))


class byte_hashes:
    """Hashes of any byte spans of one array from a single prefix sum.

    A span's hash is the sum of ``table[byte] * base**offset`` modulo 2**64,
    finalised; equal bytes give equal hashes wherever they stand.
    """

    _table = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    _powers = np.ones(1, dtype=np.uint64)
    _inverse = np.ones(1, dtype=np.uint64)

    def __init__(self, data: np.ndarray, values: np.ndarray | None = None):
        """``values``: one number a position instead of those of the byte table."""
        n = len(data) + 1
        cls = type(self)
        # tables for usual sizes stay; those of a very long text go with it
        keeper = cls if n <= 1 << 22 else self
        if len(cls._powers) < n:
            size = max(n, 1 << 20)
            for name, base in (("_powers", _BASE), ("_inverse", _BASE_INV)):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(keeper, name, np.multiply.accumulate(steps, out=steps))
        self.prefix = np.zeros(n, dtype=np.uint64)
        np.cumsum((cls._table[data] if values is None else values) * self._powers[: n - 1], out=self.prefix[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.prefix[ends] - self.prefix[starts]) * self._inverse[starts]
        return mix64(raw + (ends - starts).astype(np.uint64))


def release() -> None:
    """Give the memory that a task has freed back to the system: Python workers
    stay for later tasks, several on an executor, and keep what they once took."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def released(run: Callable) -> Callable:
    """``run`` over batches, then ``release``."""
    def whole(batches):
        try:
            yield from run(batches)
        finally:
            release()
    return whole


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def text_batches(spark: SparkSession, rows: int = 256) -> None:
    """Fewer rows in an Arrow batch, where the session has the default: a row is a
    whole text here, and ten thousand of them take a worker's memory."""
    if spark.conf.get(_BATCH_ROWS, "10000") == "10000":
        spark.conf.set(_BATCH_ROWS, str(rows))


def arrow_map(df: DataFrame, rows: Callable, schema: str, most: int = 2 << 20,
              text: str = "text") -> DataFrame:
    """``mapInArrow`` over bounded chunks: ``rows(batch, texts)`` gets some rows
    and the UTF-8 bytes of their text column and returns a dict of columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    text_batches(df.sparkSession)
    with_spark = _parse_datatype_string(schema)
    out = to_arrow_schema(with_spark)

    def run(batches):
        for batch in batches:
            texts = texts_of(batch, text)
            for part in row_chunks([len(x) for x in texts], most):
                got = rows(batch.slice(part.start, part.stop - part.start), texts[part])
                if got is not None:
                    yield pa.RecordBatch.from_arrays(
                        [a if isinstance(a, pa.Array) and a.type == f.type else pa.array(a, f.type)
                         for a, f in zip((got[f.name] for f in out), out, strict=True)], schema=out)

    return df.mapInArrow(released(run), with_spark)


def held_out(doc_id: str | Column, folds: int, fold: int) -> Column:
    """True for rows whose crc32(doc_id as text) modulo ``folds`` is ``fold``; a
    null id is never held out."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % F.lit(folds) == F.lit(fold), F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int,
                  most: int) -> tuple[DataFrame, dict[int, float]]:
    """A bounded sample of labelled documents for fitting: doc_id, text, label.

    Rows of each class in the order of a hash, ``most`` of each at most, none of
    them held out; an id with several labels takes the largest; rows repeated
    with their text count once; null ids and labels are no training rows.  Also
    the weight of each class (all labelled ids / sampled ids).  A hash threshold that about twice
    the wanted rows pass comes first, so that no task sends more than its share
    to the driver; only the ids, at most ``2 * most``, are broadcast.
    """
    spark = docs.sparkSession
    own = saved(labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
                .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out("doc_id", folds, fold))
                .groupBy("doc_id").agg(F.max("label").alias("label")), "labels")
    sizes = {r["label"]: r["n"] for r in own.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = [lowest(own.filter(F.col("label") == c), F.xxhash64("doc_id"), sizes.get(c, 0), most, ["doc_id"]) for c in (0, 1)]
    ids = [(r["doc_id"], r["label"]) for p in picked for r in p.select("doc_id", "label").collect()]
    chosen = F.broadcast(spark.createDataFrame(ids, "doc_id long, label int"))
    rows = docs.withColumn("doc_id", F.col("doc_id").cast("long")).join(chosen, "doc_id")
    weights = {c: n / min(n, most) for c, n in sizes.items()}
    # an id may stand on any number of rows: repeated ones count once, others are bounded as well
    rows = rows.select("doc_id", "text", "label").dropDuplicates(["doc_id", "text"]).withColumn("h", F.xxhash64("doc_id", "text"))
    places = saved(rows.select("doc_id", "label", "h"), "training-places")
    told = {r["label"]: r["n"] for r in places.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    kept = [lowest(places.filter(F.col("label") == c), F.col("h"), told.get(c, 0), most, ["doc_id"]).select("doc_id", "h") for c in (0, 1)]
    return rows.join(F.broadcast(kept[0].unionByName(kept[1])), ["doc_id", "h"]).select("doc_id", "text", "label"), weights


def lowest(rows: DataFrame, key: Column, n: int, most: int, ties: list[str]) -> DataFrame:
    """The ``most`` of ``n`` rows with the smallest uniform 64-bit ``key``.  A
    threshold that twice as many rows pass on average comes before the sort; should
    too few pass, all rows are sorted."""
    if n > 4 * most:
        border = -(1 << 63) + int((1 << 64) * (2 * most / n))
        near = rows.filter(key <= F.lit(border))
        if near.limit(most).count() == most:
            rows = near
    return rows.orderBy(key, *ties).limit(most)


def adam(gradient: Callable, params: list[np.ndarray], steps: int, rate: float) -> list[np.ndarray]:
    """Adam with a cosine schedule; ``gradient(step, params)`` returns one array a parameter."""
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for t in range(1, steps + 1):
        lr = rate * 0.5 * (1 + np.cos(np.pi * t / steps))
        for i, g in enumerate(gradient(t, params)):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            params[i] = params[i] - lr * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return params


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def temperature(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The divisor of the logits ``z`` with the least weighted log loss."""
    grid = np.exp(np.linspace(np.log(0.2), np.log(20), 120))
    sign = np.where(y > 0, z, -z)
    return float(grid[np.argmin([(weight * np.logaddexp(0, -sign / t)).sum() for t in grid])])
