"""Product codes of vectors by ball k-means.

A vector is cut into equal consecutive parts; every part position has its own
codebook, refined by Lloyd rounds on whole numbers.  Each entry with its parts is
a ball: its radius is the distance of its farthest part, and only entries whose
centre lies within twice that radius can take a part away (its neighbours).  A
part nearer to its own centre than half the way to the nearest neighbour is in
the ball's stable core and is not looked at; the others lie in rings between the
half ways to the neighbours in the order of distance, and a part in the m-th ring
is compared with the first m neighbours only.  Where neither an entry nor one of
its neighbours has moved since the last round, the whole ball is skipped.  All
tests are on whole numbers and keep ties, so the codes equal those of a full
search.

On Spark a task holds a block of parts with their codes from the last round, and
the balls are those of the block: their radii are at most the whole ball's, so
the neighbours are the needed ones and no pass is spent on radii.  A round is
one narrow map over the blocks and one sum of ``parts * entries`` rows; the last
round's blocks are kept (memory, then disk) and a lost one is mapped anew from
the table, since the codebooks travel with the maps.

Defined cases: null vectors and those with null or non-finite components are
dropped, and so are vectors of another length than that of the smallest vec_id
whose length divides into the parts; null ids are encoded but start no entry;
equal ids start entries in the order of their vectors; with fewer vectors than
entries the codebooks are smaller; an empty table gives no rows; null labels are
one label; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import released, saved
from cadenza.llm.vectors import SQL_FLOOR, blocks, checked, scaled, unpacked, whole
from cadenza.operators.sampling import join_classes

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096


def ball_search(x: np.ndarray, centres: np.ndarray, code: np.ndarray, moved: np.ndarray | None = None
                ) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centre of every row (ties: the lower number), its squared
    distance, and how many distances to other centres were needed.

    ``code`` is the guess that forms the balls.  ``moved`` marks the centres
    that moved since ``code`` was right; None if it never was.
    """
    k = len(centres)
    gap = ((centres[:, None] - centres[None]) ** 2).sum(2)
    code = code.copy()
    own = ((x - centres[code]) ** 2).sum(1)
    by_ball = np.argsort(code, kind="stable")
    cut = np.searchsorted(code[by_ball], np.arange(k + 1))
    looked = 0
    for i in range(k):
        rows = by_ball[cut[i]:cut[i + 1]]
        if not len(rows):
            continue
        order = np.argsort(gap[i], kind="stable")
        order = order[order != i]
        # a centre beyond twice the radius is farther from every part of the ball
        near = order[gap[i][order] <= 4 * own[rows].max()]
        if not len(near) or moved is not None and not moved[i] and not moved[near].any():
            continue
        ring = np.searchsorted(gap[i][near], 4 * own[rows], side="right")
        rows, ring = rows[ring > 0], ring[ring > 0]
        if not len(rows):
            continue
        first = np.cumsum(ring) - ring
        owner = np.repeat(np.arange(len(rows)), ring)
        rival = near[np.arange(len(owner)) - first[owner]]
        far = ((x[rows[owner]] - centres[rival]) ** 2).sum(1)
        best = np.minimum(np.minimum.reduceat(far * k + rival, first), own[rows] * k + i)
        code[rows], own[rows] = best % k, best // k
        looked += len(owner)
    return code, own, looked


def part_sums(x: np.ndarray, code: np.ndarray, k: int) -> np.ndarray:
    """k x (1 + d): rows and component sums of every entry."""
    return np.stack([np.bincount(code, minlength=k)] + [
        np.bincount(code, weights=x[:, j], minlength=k).astype(np.int64) for j in range(x.shape[1])], axis=1)


def search_blocks(state: DataFrame, books: np.ndarray, moved: np.ndarray | None, sums: bool) -> DataFrame:
    """The blocks with their codes under ``books`` (parts x entries x d) and, if
    asked for, with the sums of every part and entry."""
    from pyspark.sql.pandas.types import to_arrow_schema
    parts, k, d = books.shape
    kept = state.select("ids", "labels", "data", "codes")
    out = kept.withColumn("sums", F.lit(None).cast("array<long>")).schema if sums else kept.schema
    arrow = to_arrow_schema(out)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                n = len(row.column("ids")[0])
                x = unpacked(row.column("data")[0].as_py(), n, parts * d)
                old = row.column("codes")[0].as_py()
                codes = np.frombuffer(old, np.uint8).reshape(parts, n) if old else np.zeros((parts, n), np.uint8)
                new, told = [], []
                for p in range(parts):
                    own = x[:, p * d:(p + 1) * d]
                    code, _, _ = ball_search(own, books[p], codes[p].astype(np.int64), None if moved is None else moved[p])
                    new.append(code.astype(np.uint8))
                    if sums:
                        told.append(part_sums(own, code, k).ravel())
                cols = [row.column("ids"), row.column("labels"), row.column("data"), pa.array([b"".join(c.tobytes() for c in new)], pa.binary())]
                if sums:
                    flat = np.concatenate(told)
                    cols.append(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), pa.array(flat)).cast(arrow.field("sums").type))
                yield pa.RecordBatch.from_arrays([c if c.type == f.type else c.cast(f.type) for c, f in zip(cols, arrow, strict=True)],
                                                 schema=arrow)
    return kept.mapInArrow(released(run), out)


def coded(state: DataFrame, books: np.ndarray, label: str) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error of every vector."""
    from pyspark.sql.pandas.types import to_arrow_schema
    parts, _, d = books.shape
    out = state.sparkSession.createDataFrame([], f"vec_id long, label {label}, code string, error long").schema
    arrow = to_arrow_schema(out)
    digits = np.array([f"{i:02x}" for i in range(256)])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, labels = batch.column("ids")[i].values, batch.column("labels")[i].values
                x = unpacked(batch.column("data")[i].as_py(), len(ids), parts * d)
                codes = np.frombuffer(batch.column("codes")[i].as_py(), np.uint8).reshape(parts, -1)
                error = sum(((x[:, p * d:(p + 1) * d] - books[p][codes[p]]) ** 2).sum(1) for p in range(parts))
                text = digits[codes[0]]
                for c in codes[1:]:
                    text = np.char.add(text, digits[c])
                yield pa.RecordBatch.from_arrays([ids, labels.cast(arrow.field("label").type), pa.array(text.tolist(), pa.string()),
                                                  pa.array(error, pa.int64())], schema=arrow)
    return state.select("ids", "labels", "data", "codes").mapInArrow(released(run), out)


def vector_width(rows: DataFrame, parts: int) -> int | None:
    """Length of the vector with the smallest id that ``parts`` divides."""
    fits = rows.filter((F.size("v") > 0) & (F.size("v") % parts == 0) & F.col("vec_id").isNotNull())
    found = fits.agg(F.min(F.struct("vec_id", F.size("v").alias("n"))).alias("x")).first()["x"]
    return None if found is None else found["n"]


def train(rows: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
          scale: int = SCALE) -> tuple[np.ndarray, DataFrame]:
    """Codebooks (parts x entries x d) and the kept blocks with their final codes."""
    first = rows.filter("vec_id is not null").select("vec_id", scaled("v", scale).alias("v")).orderBy("vec_id", "v").limit(entries)
    start = checked(np.array([r["v"] for r in first.collect()], dtype=np.float64))
    d = width // parts
    books = start.reshape(len(start), parts, d).transpose(1, 0, 2).copy()
    state, moved = blocks(rows, width, scale), None
    old = None
    for _ in range(rounds):
        state = search_blocks(state, books, moved, True).persist(StorageLevel.MEMORY_AND_DISK)
        told = (state.select(F.posexplode("sums").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x")).toArrow())
        total = np.zeros(books.shape[0] * books.shape[1] * (d + 1), np.int64)
        total[told.column("at").to_numpy()] = told.column("x").to_numpy()
        total = total.reshape(books.shape[0], books.shape[1], d + 1)
        n = total[:, :, :1]
        better = np.where(n > 0, total[:, :, 1:] // np.maximum(n, 1), books)
        moved, books = (better != books).any(2), better
        if old is not None:
            old.unpersist()
        old = state
    return books, search_blocks(state, books, moved, False).persist(StorageLevel.MEMORY_AND_DISK)


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """One row per kept vector: vec_id, code, error, label_error, codebooks_sha256."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{label}`").alias("label"),
                          F.col(f"`{vector}`").alias("v")).filter(whole("v"))
    kind = rows.schema["label"].dataType.simpleString()
    width = vector_width(rows, parts)
    if width is None:
        own = vectors.sparkSession.createDataFrame([], f"vec_id long, label {kind}, code string, error long")
        books = np.zeros((parts, 0, 0), np.int64)
    else:
        books, state = train(rows.filter(F.size("v") == width), width, parts, entries, rounds, scale)
        own = saved(coded(state, books, kind), "codes")
        state.unpersist()
    sha = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    per_label = own.groupBy("label").agg(F.sum("error").alias("label_error"))
    return join_classes(own, per_label, "label", "left").select(
        "vec_id", "code", "error", "label_error", F.lit(sha).alias("codebooks_sha256"))


def sql(table: str = "embeddings", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same rows in DuckDB SQL, a full search in every round."""
    mean = SQL_FLOOR.format(a="sum(x.v)", b="count(*)")
    steps = [f"""kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS r, vec_id, label, embedding AS e FROM {table}
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
flat AS (SELECT r, generate_subscripts(e, 1) - 1 AS i, len(e) // {parts} AS d, CAST(floor({scale} * CAST(unnest(e) AS DOUBLE)) AS BIGINT) AS v FROM kept),
x AS MATERIALIZED (SELECT r, i // d AS p, i % d AS j, v FROM flat),
b0 AS MATERIALIZED (SELECT p, r AS k, j, v FROM x WHERE r < {entries})"""]
    for t in range(rounds + 1):
        steps.append(f"""a{t} AS MATERIALIZED (SELECT r, p, min(struct_pack(d := d, k := k)) AS s FROM (
  SELECT x.r, x.p, b.k, CAST(sum((x.v - b.v) * (x.v - b.v)) AS BIGINT) AS d FROM x JOIN b{t} b USING (p, j) GROUP BY ALL) GROUP BY ALL)""")
        if t < rounds:
            steps.append(f"""m{t} AS (SELECT x.p, a.s.k AS k, x.j, CAST({mean} AS BIGINT) AS v FROM x JOIN a{t} a USING (r, p) GROUP BY ALL),
b{t + 1} AS MATERIALIZED (SELECT p, k, j, coalesce(m.v, b.v) AS v FROM b{t} b LEFT JOIN m{t} m USING (p, k, j))""")
    steps.append(f"""c AS (SELECT r, string_agg(printf('%02x', s.k), '' ORDER BY p) AS code, CAST(sum(s.d) AS BIGINT) AS error FROM a{rounds} GROUP BY r),
h AS (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY p, k, j)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN c USING (r), h""")
    return "WITH " + ",\n".join(steps)


SQL = sql()
