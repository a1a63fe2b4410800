"""Centroid clustering by the equal-average equal-variance nearest-centroid search.

Centroids are sorted by the sum of their components.  A vector's search starts
where its own sum falls and goes outward, always to the nearer side.  With width
w, sums S, and Q = w * sum(x^2) - S^2 (w times the squared deviation), every
centroid c obeys

    w * d(x, c)^2  >=  (S_x - S_c)^2 + (sqrt(Q_x) - sqrt(Q_c))^2

Once the first term alone exceeds w times the best distance, all centroids
further out are rejected at once; otherwise the second term may reject this one.
What is left gets its exact whole-number distance.  The first test is on whole
numbers; the second one, in floating point, is made weaker by more than its
rounding error.  Both keep ties, so the clusters equal those of a full search.

A Lloyd round is one scan: tasks add up their rows and emit at most one row per
centroid, which Spark adds.  Only centroids and their sums reach the driver.

Defined cases: null vectors, vectors of another width and those with null or
non-finite components are dropped; a null id starts no centroid; equal ids start
centroids in the order of their vectors; with fewer vectors than centroids there
are fewer; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import released, saved
from cadenza.llm.vectors import SQL_FLOOR, checked, full_batches, numbers, scaled, whole

WIDTH, CENTROIDS, ROUNDS, SCALE, SEED = 64, 16, 3, 64, 1


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centre of every row (ties: the smaller number), its squared
    distance, and how many distances were worked out."""
    n, width = x.shape
    k = len(centres)
    sums = centres.sum(1)
    order = np.lexsort((np.arange(k), sums))
    s_c, c = sums[order], centres[order]
    dev_c = np.sqrt((width * (c * c).sum(1) - s_c * s_c).astype(np.float64))
    s_x = x.sum(1)
    dev_x = np.sqrt((width * (x * x).sum(1) - s_x * s_x).astype(np.float64))
    most = np.iinfo(np.int64).max
    best, number = np.full(n, most), np.full(n, k)
    high = np.searchsorted(s_c, s_x)
    low = high - 1
    rows, looked = np.arange(n), 0
    while len(rows):
        # the side whose next centroid has the nearer sum
        up = np.where(high[rows] < k, np.abs(s_c[np.minimum(high[rows], k - 1)] - s_x[rows]), most)
        down = np.where(low[rows] >= 0, np.abs(s_c[np.maximum(low[rows], 0)] - s_x[rows]), most)
        step, rises = np.minimum(up, down), up < down
        # no side left, or every further centroid is farther by its mean
        bound = np.where(best[rows] == most, most, best[rows] * np.where(best[rows] == most, 1, width))
        go = (step < most) & (np.where(step < most, step, 0) ** 2 <= bound)
        rows, step, rises, bound = rows[go], step[go], rises[go], bound[go]
        at = np.where(rises, high[rows], low[rows])
        high[rows] += rises
        low[rows] -= ~rises
        least = step.astype(np.float64) ** 2 + (dev_x[rows] - dev_c[at]) ** 2
        near = least * (1 - 1e-9) - 1 <= bound
        picked, at = rows[near], at[near]
        d = ((x[picked] - c[at]) ** 2).sum(1)
        looked += len(picked)
        own = order[at]
        better = (d < best[picked]) | ((d == best[picked]) & (own < number[picked]))
        best[picked[better]], number[picked[better]] = d[better], own[better]
    return number, best, looked


def cluster_sums(rows: DataFrame, centres: np.ndarray, width: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and component sums of every centroid's vectors, over all rows."""
    k = len(centres)
    schema = "cluster int, n long, " + ", ".join(f"s{j} long" for j in range(width))

    def run(batches):
        n, total = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for batch in full_batches(batches):
            x = numbers(batch.column("v"), width, scale)
            own, _, _ = nearest(x, centres)
            n += np.bincount(own, minlength=k)
            by = np.argsort(own, kind="stable")
            seen, at = np.unique(own[by], return_index=True)
            total[seen] += np.add.reduceat(x[by], at, axis=0)
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(n[seen]), *[pa.array(t) for t in total[seen].T]],
                                         names=["cluster", "n", *[f"s{j}" for j in range(width)]])
    got = rows.select("v").mapInArrow(released(run), schema).groupBy("cluster").agg(
        F.sum("n").alias("n"), *[F.sum(f"s{j}").alias(f"s{j}") for j in range(width)]).toArrow()
    n, total = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
    at = got.column("cluster").to_numpy()
    n[at] = got.column("n").to_numpy()
    for j in range(width):
        total[at, j] = got.column(f"s{j}").to_numpy()
    return n, total


def starts(rows: DataFrame, centroids: int, scale: int, seed: int) -> np.ndarray:
    """Vectors with the smallest sha256 of ``seed:vec_id``, in that order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = (rows.filter("vec_id is not null").select(key.alias("key"), scaled("v", scale).alias("v"))
             .orderBy("key", "v").limit(centroids).collect())
    return checked(np.array([r["v"] for r in first], dtype=np.float64))


def fit(rows: DataFrame, width: int = WIDTH, centroids: int = CENTROIDS, rounds: int = ROUNDS, scale: int = SCALE,
        seed: int = SEED) -> np.ndarray:
    """Centroids after ``rounds`` Lloyd rounds over ``rows`` (vec_id, v; kept ones only)."""
    centres = starts(rows, centroids, scale, seed)
    for _ in range(rounds if len(centres) else 0):
        n, total = cluster_sums(rows, centres, width, scale)
        centres = np.where(n[:, None] > 0, total // np.maximum(n, 1)[:, None], centres)
    return centres


def assign(rows: DataFrame, centres: np.ndarray, scale: int = SCALE) -> DataFrame:
    """vec_id, cluster and squared distance of every row."""
    width = centres.shape[1]

    def run(batches):
        for batch in full_batches(batches):
            own, d, _ = nearest(numbers(batch.column("v"), width, scale), centres)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(own.astype(np.int32)), pa.array(d)],
                                             names=["vec_id", "cluster", "distance"])
    return rows.select("vec_id", "v").mapInArrow(released(run), "vec_id long, cluster int, distance long")


def cluster(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", width: int = WIDTH,
            centroids: int = CENTROIDS, rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia,
    inertia, centroid_sha256."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("v")).filter(
        F.coalesce(F.size("v") == width, F.lit(False)) & whole("v"))
    centres = fit(rows, width, centroids, rounds, scale, seed)
    if not len(centres):
        own = spark.createDataFrame([], "vec_id long, cluster int, distance long")
    else:
        own = saved(assign(rows, centres, scale), "clusters")
    cost = {r["cluster"]: r["d"] for r in own.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    table = spark.createDataFrame(
        [(i, cost.get(i, 0), sum(cost.values()), hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest())
         for i, c in enumerate(centres)], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return own.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def sql(table: str = "embeddings", width: int = WIDTH, centroids: int = CENTROIDS, rounds: int = ROUNDS, scale: int = SCALE,
        seed: int = SEED) -> str:
    """The same rows in DuckDB SQL, a full search in every round."""
    mean = SQL_FLOOR.format(a="sum(x.v)", b="count(*)")
    steps = [f"""kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS r, vec_id, embedding AS e FROM {table}
  WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT r, generate_subscripts(e, 1) AS j, CAST(floor({scale} * CAST(unnest(e) AS DOUBLE)) AS BIGINT) AS v FROM kept),
b0 AS MATERIALIZED (SELECT CAST(r AS INTEGER) AS k, j, v FROM x WHERE r < {centroids})"""]
    for t in range(rounds + 1):
        steps.append(f"""a{t} AS MATERIALIZED (SELECT r, min(struct_pack(d := d, k := k)) AS s FROM (
  SELECT x.r, b.k, CAST(sum((x.v - b.v) * (x.v - b.v)) AS BIGINT) AS d FROM x JOIN b{t} b USING (j) GROUP BY ALL) GROUP BY ALL)""")
        if t < rounds:
            steps.append(f"""m{t} AS (SELECT a.s.k AS k, x.j, CAST({mean} AS BIGINT) AS v FROM x JOIN a{t} a USING (r) GROUP BY ALL),
b{t + 1} AS MATERIALIZED (SELECT k, j, coalesce(m.v, b.v) AS v FROM b{t} b LEFT JOIN m{t} m USING (k, j))""")
    steps.append(f"""h AS (SELECT k, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY j)) AS centroid_sha256 FROM b{rounds} GROUP BY k)
SELECT vec_id, s.k AS cluster, s.d AS distance, CAST(sum(s.d) OVER (PARTITION BY s.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(s.d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM kept JOIN a{rounds} a USING (r) JOIN h ON h.k = a.s.k""")
    return "WITH " + ",\n".join(steps)


SQL = sql()
