"""Whole-number vectors in blocks, for the operators on embeddings.

Vectors are cut to whole numbers (``floor(scale * x)``), so that distances and
sums are exact and do not depend on the order of rows.  A block holds up to
``BLOCK`` vectors of one task in one row: ids, a label each, and the numbers as
bytes, two or four each.

Components may lie between -LIMIT and LIMIT after scaling, where every square and
product of the operators fits 64 bits; a larger one is an error that names it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import released

BLOCK, LIMIT = 8192, 1 << 24
#: Fixed pieces of generated SQL: floor of a / b for whole numbers, b positive.
SQL_FLOOR = "(({a}) - ((({a}) % ({b})) + ({b})) % ({b})) // ({b})"


def whole(vec: str | Column) -> Column:
    """True for vectors without null or non-finite components; null is false."""
    v = F.col(vec) if isinstance(vec, str) else vec
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & good, F.lit(False))


def scaled(vec: str, scale: int) -> Column:
    """``floor(scale * x)`` of every component, in double precision."""
    return F.transform(vec, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def checked(ints: np.ndarray) -> np.ndarray:
    if ints.size and (ints.max() > LIMIT or ints.min() < -LIMIT):
        raise ValueError(f"a vector component is beyond {LIMIT} after scaling")
    return ints.astype(np.int64)


def numbers(column: pa.Array, width: int, scale: int) -> np.ndarray:
    """n x width whole numbers of a list column whose vectors are all ``whole``."""
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return checked(np.floor(flat.reshape(-1, width) * float(scale)))


def packed(ints: np.ndarray) -> bytes:
    """Two bytes a number where they all fit, else four."""
    small = not ints.size or (ints.max() < 1 << 15 and ints.min() >= -(1 << 15))
    return ints.astype("<i2" if small else "<i4").tobytes()


def unpacked(data: bytes, rows: int, width: int) -> np.ndarray:
    kind = "<i2" if len(data) == 2 * rows * width else "<i4"
    return np.frombuffer(data, kind).reshape(rows, width).astype(np.int64)


def full_batches(batches: Iterator[pa.RecordBatch], rows: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``rows`` (the last may be smaller), whatever
    the session's Arrow batches."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            table = pa.Table.from_batches(held).combine_chunks()
            whole_rows = n - n % rows
            for at in range(0, whole_rows, rows):
                yield table.slice(at, rows).to_batches()[0]
            rest = table.slice(whole_rows).to_batches()
            held, n = list(rest), n - whole_rows
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def blocks(rows: DataFrame, width: int, scale: int) -> DataFrame:
    """Blocks of ``rows`` (vec_id, label, v; every ``v`` whole and ``width``
    long): ids, labels, data, and an empty ``codes``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    kind = rows.schema["label"].dataType.simpleString()
    out = rows.sparkSession.createDataFrame([], f"ids array<long>, labels array<{kind}>, data binary, codes binary").schema
    arrow = to_arrow_schema(out)

    def one(column: pa.Array, to: pa.DataType) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column.cast(to.value_type)).cast(to)

    def run(batches):
        for batch in full_batches(batches):
            ints = numbers(batch.column("v"), width, scale)
            yield pa.RecordBatch.from_arrays(
                [one(batch.column("vec_id"), arrow.field("ids").type), one(batch.column("label"), arrow.field("labels").type),
                 pa.array([packed(ints)], pa.binary()), pa.array([b""], pa.binary())], schema=arrow)
    return rows.mapInArrow(released(run), out)
