"""Minimum-cost-flow resharding.

From the bytes that the old shards hold and the capacities of the new ones, a
minimum-cost flow says how many bytes go from each old shard to each new one
(staying is free, moving a byte costs one, or a given cost matrix).  Spark then
turns the byte amounts into rows: the rows of an old shard stand in one fixed
order, the flow cuts that line into consecutive ranges, and a row goes where
its middle byte lies.

The driver sees one (bytes, rows) pair for each of ``old shards x blocks``
cells, a number set by parameters; a row's place inside its cell comes from a
window over that cell alone, so no shard is ordered in one task.

Defined cases: a null text has no bytes, and every row counts one byte more than
its text; a null old shard is shard 0; null ids are placed like others; repeated
rows get slots of their own; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import saved


def min_cost_flow(supply: list[int], capacity: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Bytes from each old to each new shard: successive shortest augmenting
    paths (Bellman-Ford) over the bipartite residual graph.  ``capacity`` must
    hold all of ``supply``."""
    n, m = len(supply), len(capacity)
    if sum(capacity) < sum(supply):
        raise ValueError("the new shards cannot hold the old ones")
    flow = [[0] * m for _ in range(n)]
    left, room = list(supply), list(capacity)
    while any(left):
        far = [0 if x else float("inf") for x in left] + [float("inf")] * m
        via: list[int | None] = [None] * (n + m)
        changed = True
        while changed:
            changed = False
            for i in range(n):
                for j in range(m):
                    if far[i] + cost[i][j] < far[n + j]:
                        far[n + j], via[n + j], changed = far[i] + cost[i][j], i, True
                    if flow[i][j] and far[n + j] - cost[i][j] < far[i]:
                        far[i], via[i], changed = far[n + j] - cost[i][j], n + j, True
        end = min((n + j for j in range(m) if room[j]), key=lambda v: far[v])
        path, v = [end], end
        while via[v] is not None:
            v = via[v]
            path.append(v)
        path.reverse()
        amount = min([left[path[0]], room[end - n]] + [
            flow[b][a - n] for a, b in zip(path, path[1:]) if a >= n])
        for a, b in zip(path, path[1:]):
            if a < n:
                flow[a][b - n] += amount
            else:
                flow[b][a - n] -= amount
        left[path[0]] -= amount
        room[end - n] -= amount
    return flow


def even_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


def row_sizes(docs: DataFrame, old: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = F.col(f"`{text_col}`")
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(old.cast("int"), F.lit(0)).alias("old_shard"))


def reshard(docs: DataFrame, old: Column, old_shards: int, new_shards: int,
            capacities: list[int] | None = None, cost: list[list[int]] | None = None,
            blocks: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, size, text_crc32, old_shard, shard, slot.

    ``old`` gives the old shard (0 to ``old_shards`` - 1).  ``capacities`` are
    bytes; equal ones if not given.  ``blocks`` bounds the cells that the driver
    sees (``old_shards * blocks``) and with it the rows of a cell: raise it with
    the table so that a cell holds some 100,000 rows.
    """
    spark = docs.sparkSession
    rows = saved(row_sizes(docs, old, id_col, text_col).withColumn(
        "block", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(blocks)).cast("int")), "reshard-rows")
    cells = sorted(rows.groupBy("old_shard", "block").agg(F.sum("size").alias("bytes")).collect())
    supply = [0] * old_shards
    for c in cells:
        supply[c["old_shard"]] += c["bytes"]
    capacities = capacities or even_capacities(sum(supply), new_shards)
    cost = cost or [[int(i != j) for j in range(new_shards)] for i in range(old_shards)]
    flow = min_cost_flow(supply, capacities, cost)

    # the byte ranges of each old shard: what stays first, then what leaves
    cuts = []
    for i in range(old_shards):
        at, order = 0, sorted(range(new_shards), key=lambda j: (cost[i][j], j))
        for j in order:
            if flow[i][j]:
                cuts.append((i, j, at, at + flow[i][j]))
                at += flow[i][j]
    starts, at = [], {}
    for c in cells:
        starts.append((c["old_shard"], c["block"], at.get(c["old_shard"], 0)))
        at[c["old_shard"]] = at.get(c["old_shard"], 0) + c["bytes"]

    # both tables are bounded by the parameters
    offset = F.broadcast(spark.createDataFrame(starts, "old_shard int, block int, cell_start long"))
    in_cell = Window.partitionBy("old_shard", "block").orderBy("size", "doc_id", "text_crc32")
    middle = rows.join(offset, ["old_shard", "block"]).withColumn(
        "middle", F.col("cell_start") + F.sum("size").over(in_cell.rowsBetween(Window.unboundedPreceding, 0))
        - (F.col("size") / 2).cast("long") - 1)
    target = F.lit(None).cast("int")
    for i, j, low, high in cuts:
        target = F.when((F.col("old_shard") == i) & (F.col("middle") >= low) & (F.col("middle") < high),
                        F.lit(j)).otherwise(target)
    placed = saved(middle.withColumn("shard", target).drop("middle", "cell_start"), "reshard-placed")

    # slots: rows of a shard follow one another cell by cell
    counted = placed.groupBy("shard", "old_shard", "block").agg(F.count(F.lit(1)).alias("n"))
    firsts, at = [], {}
    for c in sorted(counted.collect()):
        firsts.append((c["shard"], c["old_shard"], c["block"], at.get(c["shard"], 0)))
        at[c["shard"]] = at.get(c["shard"], 0) + c["n"]
    first = F.broadcast(spark.createDataFrame(firsts, "shard int, old_shard int, block int, first_slot long"))
    rank = F.row_number().over(Window.partitionBy("shard", "old_shard", "block").orderBy("size", "doc_id", "text_crc32"))
    return placed.join(first, ["shard", "old_shard", "block"]).select(
        "doc_id", "size", "text_crc32", "old_shard", "shard",
        (F.col("first_slot") + rank - 1).cast("long").alias("slot"))


def rewrite(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> list[int]:
    """Write the shards that gain or lose rows, one folder ``shard=N`` each, in
    slot order of the files' ranges; shards whose rows all stay are left alone.
    ``path`` must not exist yet: a folder with the old shards is refused, as its
    others would be deleted.  Ids must be unique here.  Returns the shards that
    gain or lose rows; one without a folder is empty now."""
    touched = [r[0] for r in placed.filter("old_shard != shard").select(
        F.explode(F.array("old_shard", "shard"))).distinct().collect()]
    rows = placed.filter(F.col("shard").isin(touched)).select(F.col("doc_id").alias(id_col), "shard", "slot")
    (docs.join(rows, id_col).repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.mode("errorifexists").partitionBy("shard").parquet(path))
    return sorted(touched)
