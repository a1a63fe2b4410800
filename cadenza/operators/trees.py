"""Tree ensembles grown from histograms: softmax boosting and random forests.

Features are cut once into at most ``bins`` ranges whose borders come from a
quantile sketch; rows then travel as blocks of one byte per feature.  A split is
chosen from sums per (tree, node, feature, bin).  All trees of a round (one per
class in boosting, all trees of a forest) grow together, level by level: a task
adds up its blocks, Spark adds the tasks' histograms per (tree, node, feature)
and picks the best feature, and only the winning splits reach the driver.

Growth has two phases, in boosting as in forests.  A node with more than
``task_rows`` rows is split by such a level job.  The rows of a smaller node fit
one task: they meet there once and the task finishes the subtree, to any depth.  A boosted table
that fits is copied once per class, and rounds send only class shares to the copies.  Both phases use the same split
rules.  Gradients and weights are whole numbers (fixed point), so
sums do not depend on the order of rows, and partitions, blocks and phases give
the same trees.

Missing values (NaN) sort last and go right.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from cadenza.session import materialize, seats

# task functions travel by value: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS, TASK_ROWS, BLOCK_ROWS = 64, 100_000, 8192
#: Numbers in the histograms that a level job or a task holds at once.
HELD = 1 << 22
#: Boosting rounds after which scores are written back to the blocks.
FOLD = 10
#: Features whose histograms travel in one row.
TOGETHER = 64
#: Bytes of binned rows of one node that a task of boosting holds.
TASK_BYTES = 64 << 20
#: Rows that a tree places, or sums by bin, at a time (what they read stays in the cache).
PLACED = 1 << 15
#: Bytes of subtrees that one scoring pass ships to the tasks.
PASS_BYTES = 64 << 20

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _mix(x):
    x = np.asarray(x, dtype=np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * _M1
        x = (x ^ (x >> np.uint64(33))) * _M2
    return x ^ (x >> np.uint64(33))


# ---------------------------------------------------------------- rules and trees

@dataclass(frozen=True)
class Rules:
    """How a tree is split.

    ``gini`` on class weights; ``newton`` on gradients and hessians with ``l2``;
    ``mse`` on gradients and weights.  ``tries`` features are drawn per node (None:
    all); a node for which none of them splits is tried with all.
    """
    criterion: str
    max_depth: int | None = None
    l2: float = 0.0
    least_hessian: float = 0.0
    tries: int | None = None
    seed: int = 0


@dataclass
class Tree:
    """Arrays by node: feature (-1: leaf), bin (rows with at most this bin go
    left), left child (the right one follows), sums, gain and path hash."""
    feature: list = field(default_factory=list)
    bin: list = field(default_factory=list)
    left: list = field(default_factory=list)
    sums: list = field(default_factory=list)
    gain: list = field(default_factory=list)
    path: list = field(default_factory=list)
    depth: list = field(default_factory=list)

    def add(self, sums, path, depth) -> int:
        for col, x in ((self.feature, -1), (self.bin, 0), (self.left, -1), (self.sums, sums), (self.gain, 0.0),
                       (self.path, path), (self.depth, depth)):
            col.append(x)
        return len(self.feature) - 1

    def split(self, node: int, feature: int, at: int, gain: float, left_sums, right_sums) -> tuple[int, int]:
        sums = np.stack([left_sums, right_sums])[None]
        (left,) = self.split_all(np.array([node]), np.array([feature]), np.array([at]), np.array([gain]), sums)
        return int(left), int(left) + 1

    def split_all(self, nodes: np.ndarray, feature: np.ndarray, at: np.ndarray, gain: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """Split many nodes; ``sums``: of the left and right child of each.  Returns the left children."""
        m = len(nodes)
        left = len(self.feature) + 2 * np.arange(m)
        path = _mix(np.array([self.path[i] for i in nodes], np.uint64)[:, None] * np.uint64(2) + np.array([1, 2], np.uint64))
        depth = np.repeat([self.depth[i] + 1 for i in nodes], 2)
        for i, f, b, g, k in zip(nodes.tolist(), feature.tolist(), at.tolist(), gain.tolist(), left.tolist()):
            self.feature[i], self.bin[i], self.gain[i], self.left[i] = f, b, g, k
        for own, new in ((self.feature, [-1] * 2 * m), (self.bin, [0] * 2 * m), (self.left, [-1] * 2 * m), (self.gain, [0.0] * 2 * m),
                         (self.sums, list(sums.reshape(2 * m, -1))), (self.path, path.ravel().tolist()), (self.depth, depth.tolist())):
            own += new
        return left

    def graft(self, node: int, sub: Tree) -> None:
        """The tree ``sub``, grown elsewhere from this leaf, in the leaf's place."""
        at = len(self.feature) - 1           # where node 1 of ``sub`` comes to stand, less one
        self.feature[node], self.bin[node], self.gain[node] = sub.feature[0], sub.bin[0], sub.gain[0]
        self.left[node] = sub.left[0] + at if sub.left[0] >= 0 else -1
        for own, new in ((self.feature, sub.feature), (self.bin, sub.bin), (self.sums, sub.sums), (self.gain, sub.gain),
                         (self.path, sub.path), (self.depth, sub.depth)):
            own += new[1:]
        self.left += [x + at if x >= 0 else -1 for x in sub.left[1:]]

    def place(self, binned: np.ndarray) -> np.ndarray:
        """The node where every row ends."""
        feature, at, left = (np.asarray(x) for x in (self.feature, self.bin, self.left))
        out = np.zeros(len(binned), np.int64)
        if feature[0] < 0:
            return out
        # a leaf leads to itself, so that all rows take a step while most still have one to go
        inner = feature >= 0
        f0, at0, left0 = np.where(inner, feature, 0).astype(np.int64), np.where(inner, at, 255), np.where(inner, left, np.arange(len(left)))
        for a in range(0, len(binned), PLACED):
            x = binned[a:a + PLACED]
            flat, base, node = x.ravel(), np.arange(len(x)) * x.shape[1], np.zeros(len(x), np.int64)
            going = len(x)
            while 2 * going > len(x):
                node = left0[node] + (flat[base + f0[node]] > at0[node])
                going = np.count_nonzero(inner[node])
            rows = np.flatnonzero(inner[node]) if going else ()
            while len(rows):
                here = node[rows]
                node[rows] = here = left[here] + (x[rows, feature[here]] > at[here])
                rows = rows[inner[here]]
            out[a:a + len(x)] = node
        return out


def drawn(paths: np.ndarray, n_features: int, rules: Rules) -> np.ndarray:
    """The features tried at every node, in order; drawn by the node's path."""
    if rules.tries is None or rules.tries >= n_features:
        return np.tile(np.arange(n_features), (len(paths), 1))
    own = _mix(np.arange(1, n_features + 1, dtype=np.uint64) * np.uint64(2 * rules.seed + 1))
    key = _mix(np.array(paths, np.uint64)[:, None] + own)
    return np.sort(np.argsort(key, axis=1)[:, :rules.tries], axis=1)


def histogram(binned: np.ndarray, local: np.ndarray, features: np.ndarray, stats: np.ndarray, cls: np.ndarray | None,
              bins: int, wide: int) -> np.ndarray:
    """Sums by (node, tried feature, bin, number): ``stats`` has a column a
    number, or one column that counts for the number ``cls``."""
    m, f = features.shape
    if cls is None and (features == features[:1]).all():
        # the same features at every node: one after the other, with arrays of one number a row
        base, columns = local * bins, [np.ascontiguousarray(stats[:, s], np.float64) for s in range(wide)]
        out = np.empty((m, f, bins, wide), np.int64)
        for k, own in enumerate(np.ascontiguousarray(binned[:, features[0]].T) if m else ()):
            cell = base + own
            for s, column in enumerate(columns):
                out[:, k, :, s] = np.rint(np.bincount(cell, weights=column, minlength=m * bins)).reshape(m, bins)
        return out
    b = np.take_along_axis(binned, features[local], axis=1)
    cell = (local[:, None] * f + np.arange(f)) * bins + b
    if cls is not None:
        cell = cell * wide + cls[:, None]
        out = np.bincount(cell.ravel(), weights=np.repeat(stats[:, 0], f), minlength=m * f * bins * wide)
        return np.rint(out).astype(np.int64).reshape(m, f, bins, wide)
    cell = cell.ravel()
    out = [np.bincount(cell, weights=np.repeat(stats[:, s], f), minlength=m * f * bins) for s in range(wide)]
    return np.rint(np.stack(out, axis=1)).astype(np.int64).reshape(m, f, bins, wide)


def worth(sums: np.ndarray, rules: Rules, unit: float) -> np.ndarray:
    """What a node with these sums adds to the objective; larger is better."""
    x = sums.astype(np.float64) / unit
    if rules.criterion == "gini":
        top, low = (x * x).sum(-1), x.sum(-1)
    else:
        low = x[..., 1] + rules.l2 if rules.criterion == "newton" else x[..., -1]
        top = x[..., 0] ** 2
    return np.divide(top, low, out=np.zeros_like(top), where=low > 0)


def best_splits(hist: np.ndarray, rules: Rules, unit: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per node: gain, place among the tried features, bin and the left sums of
    the best split (first feature, then first bin on ties); gain -inf if none."""
    m, f, bins, s = hist.shape
    left = np.cumsum(hist, axis=2)
    total = left[:, :, -1:]
    right = total - left
    # sums in which a side must not be empty: class weights, hessians or weights
    def weight(x):
        return x.sum(-1) if rules.criterion == "gini" else x[..., 1 if rules.criterion == "newton" else -1]
    least = max(rules.least_hessian * unit, 1)
    ok = (weight(left) >= least) & (weight(right) >= least)
    gain = worth(left, rules, unit) + worth(right, rules, unit) - worth(total, rules, unit)
    least_gain = -np.inf if rules.criterion == "gini" else 1e-9
    gain = np.where(ok & (gain > least_gain), np.round(gain, 12), -np.inf).reshape(m, f * bins)
    at = gain.argmax(1)
    return gain[np.arange(m), at], at // bins, at % bins, left.reshape(m, f * bins, s)[np.arange(m), at]


def open_node(sums: np.ndarray, depth: int, rules: Rules, rows: int) -> bool:
    if rows < 2 or (rules.max_depth is not None and depth >= rules.max_depth):
        return False
    return rules.criterion != "gini" or int((np.asarray(sums) > 0).sum()) > 1


def open_nodes(sums: np.ndarray, depth: np.ndarray, rules: Rules, rows: np.ndarray) -> np.ndarray:
    """``open_node`` for many nodes."""
    ok = rows >= 2
    if rules.max_depth is not None:
        ok &= depth < rules.max_depth
    return ok & ((sums > 0).sum(1) > 1) if rules.criterion == "gini" else ok


def best_among_rows(b: np.ndarray, local: np.ndarray, w: np.ndarray, cls: np.ndarray, nodes: int, rules: Rules, unit: float, bins: int,
                    wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``best_splits`` by Gini (gain, place among the tried features, bin) for nodes
    with few rows: borders lie after a row, not after each bin.  ``b`` holds the
    rows' bins in the tried features; rows lie by node."""
    n, f = b.shape
    start = np.searchsorted(local, np.arange(nodes))
    shift = np.uint64(max(1, int(n).bit_length()))
    cell = (local[None, :] * bins + b.T).astype(np.uint64)
    key = np.sort((cell << shift) | np.arange(n, dtype=np.uint64), axis=1)
    cell, row = (key >> shift).astype(np.int64), (key & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.int64)
    left = np.zeros((f, n, wide))
    left[np.arange(f)[:, None], np.arange(n), cls[row]] = w[row]
    # whole numbers below 2**53: differences of running sums are exact
    np.cumsum(left, axis=1, out=left)
    ends = np.append(start[1:], n) - 1
    total = left[0, ends]
    total[1:] -= left[0, ends[:-1]]
    left -= (np.cumsum(total, axis=0) - total)[local]
    whole = total[local]
    right = whole - left
    least = max(rules.least_hessian * unit, 1)
    ok = (left.sum(-1) >= least) & (right.sum(-1) >= least)
    ok[:, :-1] &= cell[:, 1:] != cell[:, :-1]
    gain = worth(left, rules, unit) + worth(right, rules, unit) - worth(whole, rules, unit)
    gain = np.where(ok, np.round(gain, 12), -np.inf)
    most = np.maximum.reduceat(gain, start, axis=1)
    which = most.argmax(0)
    most = most[which, np.arange(nodes)]
    hits = np.flatnonzero(gain[which[local], np.arange(n)] == most[local])
    first = hits[np.searchsorted(hits, start)]
    return most, which, cell[which, first] % bins


def _best_drawn(tree: Tree, level: np.ndarray, n: np.ndarray, binned: np.ndarray, rows: np.ndarray, local: np.ndarray, stats: np.ndarray,
                cls: np.ndarray | None, rules: Rules, unit: float, bins: int, wide: int):
    """Gain, feature and bin of the best split of every node of a level, among
    the features drawn for it; rows lie by node."""
    d = binned.shape[1]
    gain, feature, at = np.full(len(level), -np.inf), np.zeros(len(level), np.int64), np.zeros(len(level), np.int64)
    start = np.concatenate(([0], np.cumsum(n)))
    features = drawn([tree.path[i] for i in level], d, rules)
    f = features.shape[1]
    few = (n <= bins) & (rules.criterion == "gini")
    room = max(1, HELD // (8 * f * wide))            # rows, or bins, for which sums are held at once
    for own, size in ((np.flatnonzero(few), n), (np.flatnonzero(~few), np.full(len(n), bins))):
        part = np.cumsum(size[own]) // room
        for a, b in zip(*(np.searchsorted(part, np.unique(part), side=x) for x in ("left", "right"))):
            these = own[a:b]
            loc = np.repeat(np.arange(len(these)), n[these])
            r = rows[(start[these] - np.cumsum(n[these]) + n[these])[loc] + np.arange(len(loc))]
            if size is n:
                tried = binned[r[:, None], features[these][loc]]
                got = best_among_rows(tried, loc, stats[r, 0], cls[r], len(these), rules, unit, bins, wide)
            else:
                got = best_splits(histogram(binned[r], loc, features[these], stats[r], None if cls is None else cls[r], bins, wide), rules, unit)[:3]
            gain[these], feature[these], at[these] = got[0], features[these, got[1]], got[2]
    return gain, feature, at


def _sums_by_bin(binned: np.ndarray, rows: np.ndarray, local: np.ndarray, columns: Sequence[np.ndarray], nodes: int, bins: int) -> np.ndarray:
    """Sums by (node, feature, bin, column) over all features."""
    d = binned.shape[1]
    out = np.zeros((d, len(columns), nodes * bins))
    for a in range(0, len(rows), PLACED):
        own = rows[a:a + PLACED]
        x, base, numbers = np.ascontiguousarray(binned[own].T), local[a:a + PLACED] * bins, [c[own] for c in columns]
        for k in range(d):
            cell = base + x[k]
            for s, column in enumerate(numbers):
                out[k, s] += np.bincount(cell, weights=column, minlength=nodes * bins)
    return out.reshape(d, len(columns), nodes, bins).transpose(2, 0, 3, 1)


def finish(tree: Tree, node: np.ndarray, binned: np.ndarray, stats: np.ndarray, cls: np.ndarray | None, rules: Rules,
           unit: float, bins: int, start: Sequence[int]) -> None:
    """Phase two: grow ``tree`` from its nodes ``start`` in this task; ``node`` is
    the node of every row.

    Where all features are tried, only the child with fewer rows is summed up by
    bin; its sibling has the rest of the parent's sums."""
    d, level = binned.shape[1], np.array(start)
    wide = stats.shape[1] if cls is None else len(tree.sums[start[0]])
    every = cls is None and (rules.tries is None or rules.tries >= d)
    columns = [np.ascontiguousarray(stats[:, s], np.float64) for s in range(stats.shape[1])]
    # what gains need: gradients and hessians, or gradients and weights
    needed = columns[:2] if rules.criterion == "newton" else [columns[0], columns[-1]]
    most = max(1, HELD // (d * bins * len(needed)))          # nodes whose sums by bin are held at once
    local = np.full(len(tree.feature), -1)
    local[level] = np.arange(len(level))
    rows = np.flatnonzero(local[node] >= 0)
    local = local[node[rows]]
    sums = np.array([tree.sums[i] for i in level], np.int64).reshape(len(level), wide)
    above = None                     # sums by bin of the nodes whose children are this level, two by two
    while len(level):
        n = np.bincount(local, minlength=len(level))
        go = open_nodes(sums, np.array([tree.depth[i] for i in level]), rules, n)
        if not go.any():
            return
        held = None
        if every and above is not None and len(level) <= most:
            side = 2 * np.arange(len(above)) + (n[1::2] < n[::2])
            place = np.full(len(level), -1)
            place[side] = np.arange(len(side))
            mine = np.flatnonzero(place[local] >= 0)
            held = np.empty((len(level), *above.shape[1:]))
            held[side] = _sums_by_bin(binned, rows[mine], place[local[mine]], needed, len(side), bins)
            held[side ^ 1] = above - held[side]
            held = held[go]
        level, mine = level[go], go[local]
        rows, local = rows[mine], (np.cumsum(go) - 1)[local[mine]]
        n = n[go]
        if every:
            if held is None and len(level) <= most:
                held = _sums_by_bin(binned, rows, local, needed, len(level), bins)
            if held is not None:
                gain, feature, at, _ = best_splits(held, rules, unit)
            else:
                got = []
                for a in range(0, len(level), most):
                    mine = np.flatnonzero((local >= a) & (local < a + most))
                    own = _sums_by_bin(binned, rows[mine], local[mine] - a, needed, min(most, len(level) - a), bins)
                    got.append(best_splits(own, rules, unit)[:3])
                gain, feature, at = (np.concatenate(x) for x in zip(*got))
        else:
            order = np.argsort(local, kind="stable")
            rows, local = rows[order], local[order]
            gain, feature, at = _best_drawn(tree, level, n, binned, rows, local, stats, cls, rules, unit, bins, wide)
            again = np.flatnonzero(~np.isfinite(gain))
            if len(again) and rules.tries is not None and rules.tries < d:
                own = Rules(rules.criterion, rules.max_depth, rules.l2, rules.least_hessian, None, rules.seed)
                place = np.full(len(level), -1)
                place[again] = np.arange(len(again))
                mine = np.flatnonzero(place[local] >= 0)
                gain[again], feature[again], at[again] = _best_drawn(
                    tree, level[again], n[again], binned, rows[mine], place[local[mine]], stats, cls, own, unit, bins, wide)
        split = np.isfinite(gain)
        if not split.any():
            return
        above = None if held is None else held[split]
        mine = np.flatnonzero(split[local])
        rows, local = rows[mine], local[mine]
        local = 2 * (np.cumsum(split) - 1)[local] + (binned[rows, feature[local]] > at[local])
        kids = 2 * int(split.sum())
        if cls is None:
            sums = np.stack([np.bincount(local, weights=c[rows], minlength=kids) for c in columns], axis=1)
        else:
            sums = np.bincount(local * wide + cls[rows], weights=columns[0][rows], minlength=kids * wide).reshape(kids, wide)
        sums = np.rint(sums).astype(np.int64)
        left = tree.split_all(level[split], feature[split], at[split], gain[split], sums.reshape(kids // 2, 2, wide))
        level = (left[:, None] + np.array([0, 1])).ravel()


# ---------------------------------------------------------------- blocks

def feature_array(df: DataFrame, features: str):
    """The feature column as ``array<double>``, from a vector or an array."""
    if isinstance(df.schema[features].dataType, VectorUDT):
        return vector_to_array(features)
    return F.col(features).cast("array<double>")


def bin_edges(df: DataFrame, features: str, bins: int = BINS, accuracy: int = 10_000) -> list[list[float]]:
    """At most ``bins - 1`` borders per feature, from one quantile sketch: values
    of the column, so that a feature with few values keeps them all apart."""
    probs = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    got = (df.select(F.posexplode(feature_array(df, features)).alias("f", "x"))
           .withColumn("x", F.when(F.isnan("x"), F.lit(None)).otherwise(F.col("x")))
           .groupBy("f").agg(F.percentile_approx("x", probs, accuracy).alias("q")).orderBy("f").collect())
    return [sorted(set(r["q"] or [])) for r in got]


def cut(x: np.ndarray, edges: Sequence[Sequence[float]]) -> np.ndarray:
    """Bin of every value: the number of borders below it."""
    out = np.empty(x.shape, np.uint8)
    for j, e in enumerate(edges):
        out[:, j] = np.searchsorted(np.asarray(e, np.float64), x[:, j], side="left")
    return out


def _matrix(column, width: int) -> np.ndarray:
    return column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, width)


def row_blocks(df: DataFrame, features: str, label: str, weight: str | None, edges, unit: float,
               block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows as blocks: n, x (binned bytes), y, w (whole numbers) and a hash of all
    columns but maps, by which a forest draws its bootstrap counts: rows that
    differ in a key are drawn apart, wholly repeated ones together."""
    hashed = [c.name for c in df.schema.fields if not isinstance(c.dataType, MapType)]
    own = df.select(feature_array(df, features).alias("x"), F.col(label).cast("int").alias("y"),
                    (F.lit(1.0) if weight is None else F.col(weight)).cast("double").alias("w"),
                    F.xxhash64(*[F.col(f"`{c}`") for c in hashed]).alias("h"))

    def run(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= block_rows:
                yield one(held)
                held, n = [], 0
        if n:
            yield one(held)

    def one(held):
        t = pa.Table.from_batches(held).combine_chunks()
        x = cut(_matrix(t.column("x").chunk(0), len(edges)), edges)
        cols = [x.tobytes(), t.column("y").to_numpy().astype(np.int32).tobytes(),
                np.rint(t.column("w").to_numpy() * unit).astype(np.int64).tobytes(), t.column("h").to_numpy().astype(np.int64).tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([len(x)], pa.int32()), *[pa.array([c], pa.binary()) for c in cols]],
                                          names=["n", "x", "y", "w", "h"])
    return own.mapInArrow(run, "n int, x binary, y binary, w binary, h binary")


@dataclass
class Block:
    x: np.ndarray
    y: np.ndarray
    w: np.ndarray
    h: np.ndarray
    scores: np.ndarray | None = None
    shares: np.ndarray | None = None     # class shares after the latest round, for all classes at once


def _blocks(batch, d: int, classes: int = 0):
    names = batch.schema.names
    for i in range(batch.num_rows):
        n = batch.column("n")[i].as_py()
        x, y, w, h = (np.frombuffer(batch.column(c)[i].as_py(), t) for c, t in (("x", np.uint8), ("y", "<i4"), ("w", "<i8"), ("h", "<i8")))
        scores = np.frombuffer(batch.column("scores")[i].as_py()).reshape(n, classes) if "scores" in names else None
        yield Block(x.reshape(n, d), y.astype(np.int64), w, h, scores)


def fixed_point(rows: int, largest: float) -> float:
    """A power of two by which gradients and weights become whole numbers whose
    sums over all rows stay below 2**52."""
    room = 52 - math.ceil(math.log2(max(rows, 1) + 1)) - math.ceil(math.log2(max(largest, 1.0) + 1))
    return float(2 ** max(4, min(24, room)))


# ---------------------------------------------------------------- phase one: level jobs

def level(blocks: DataFrame, trees: list[Tree], fronts: list[list[int]], stats, rules: Rules, unit: float, bins: int,
          d: int, wide: int, classes: int = 0) -> list[list[tuple[int, int]]]:
    """Split the nodes ``fronts[t]`` of every tree by one job per group of nodes
    (as many as ``HELD`` allows).  ``stats(block, t)`` gives a row's numbers and
    class.  Returns the new children as (node, rows)."""
    tries = d if rules.tries is None else min(rules.tries, d)
    step = max(1, HELD // (tries * bins * (wide + 1)))
    todo = [(t, i) for t, f in enumerate(fronts) for i in f]
    kids: list[list[tuple[int, int]]] = [[] for _ in trees]

    def run(group, tries):
        own = Rules(rules.criterion, rules.max_depth, rules.l2, rules.least_hessian, tries, rules.seed)
        by_tree: dict[int, list[int]] = {}
        for t, i in group:
            by_tree.setdefault(t, []).append(i)
        chosen = {t: drawn([trees[t].path[i] for i in nodes], d, own) for t, nodes in by_tree.items()}

        def add_up(batches):
            # the last number counts rows, so that phase two knows what fits
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                for b in _blocks(batch, d, classes):
                    for t, nodes in by_tree.items():
                        at = trees[t].place(b.x)
                        local = np.full(len(trees[t].feature), -1)
                        local[nodes] = np.arange(len(nodes))
                        s, c, live = stats(b, t)
                        mine = np.flatnonzero((local[at] >= 0) & live)
                        if not len(mine):
                            continue
                        f = chosen[t]
                        x, ones = b.x[mine], np.ones((len(mine), 1))
                        if c is None:
                            h = histogram(x, local[at[mine]], f, np.hstack([s[mine], ones]), None, bins, wide + 1)
                        else:
                            h = np.concatenate([histogram(x, local[at[mine]], f, s[mine], c[mine], bins, wide),
                                                histogram(x, local[at[mine]], f, ones, None, bins, 1)], axis=3)
                        total[t] = h if t not in total else total[t] + h
            for t, h in total.items():
                nodes = by_tree[t]
                for j in range(len(nodes)):
                    at = range(0, h.shape[1], TOGETHER)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([t] * len(at), pa.int32()), pa.array([nodes[j]] * len(at), pa.int32()), pa.array(at, pa.int32()),
                         pa.array([h[j, k:k + TOGETHER].tobytes() for k in at], pa.binary())], names=["tree", "node", "place", "sums"])

        def choose(pdf: pd.DataFrame) -> pd.DataFrame:
            # all tasks' histograms of some features at one node
            t, i, first = (int(pdf[c].iloc[0]) for c in ("tree", "node", "place"))
            h = sum(np.frombuffer(x, np.int64) for x in pdf["sums"]).reshape(1, -1, bins, wide + 1)
            gain, which, at, left = best_splits(h[..., :wide], rules, unit)
            rows = h[0, which[0], :, wide]
            return pd.DataFrame({"tree": [t], "node": [i], "feature": [int(chosen[t][by_tree[t].index(i), first + which[0]])],
                                 "gain": gain, "bin": at.astype(np.int32), "left_rows": [int(rows[:at[0] + 1].sum())], "all_rows": [int(rows.sum())],
                                 "left_sums": [left[0].tolist()], "all_sums": [h[0, 0, :, :wide].sum(0).tolist()]})
        out = ("tree int, node int, feature int, gain double, bin int, left_rows long, all_rows long, left_sums array<long>, "
               "all_sums array<long>")
        best = (blocks.mapInArrow(add_up, "tree int, node int, place int, sums binary")
                .groupBy("tree", "node", "place").applyInPandas(choose, out)
                .groupBy("tree", "node").agg(F.max_by(F.struct("feature", "gain", "bin", "left_rows", "all_rows", "left_sums", "all_sums"),
                                                      F.struct("gain", -F.col("feature"))).alias("s")))
        missed = []
        for r in best.select("tree", "node", "s.*").collect():     # one row per node of the group
            t, i = r["tree"], r["node"]
            if trees[t].sums[i] is None:         # a root whose sums are not known yet
                trees[t].sums[i] = np.array(r["all_sums"], np.int64)
            if not math.isfinite(r["gain"]):
                missed.append((t, i))
                continue
            left = np.array(r["left_sums"], np.int64)
            a, b = trees[t].split(i, r["feature"], r["bin"], r["gain"], left, np.asarray(trees[t].sums[i]) - left)
            kids[t] += [(a, r["left_rows"]), (b, r["all_rows"] - r["left_rows"])]
        return missed

    for a in range(0, len(todo), step):
        missed = run(todo[a:a + step], rules.tries)
        if missed and tries < d:
            small = max(1, HELD // (d * bins * (wide + 1)))
            for c in range(0, len(missed), small):
                run(missed[c:c + small], None)
    return kids


# ---------------------------------------------------------------- boosting

@dataclass
class BoostModel:
    """Scores are start + the leaves of all trees; ``transform`` adds the class
    with the largest score (first on ties) as ``prediction``."""
    edges: list
    start: np.ndarray
    trees: list            # rounds x classes of (Tree, leaf values)
    features: str
    featureImportances: list

    def scores_of(self, binned: np.ndarray) -> np.ndarray:
        return boost_scores(np.tile(self.start, (len(binned), 1)), binned, self.trees)

    def transform(self, df: DataFrame) -> DataFrame:
        edges, width = self.edges, len(self.edges)
        slim = BoostModel(edges, self.start, _slim(self.trees), self.features, [])

        @F.pandas_udf("double")
        def best(x: pd.Series) -> pd.Series:
            out = np.zeros(len(x))
            if len(x):
                out = slim.scores_of(cut(np.stack(x.to_numpy()).astype(np.float64).reshape(-1, width), edges)).argmax(1)
            return pd.Series(out.astype(np.float64))
        return df.withColumn("prediction", best(feature_array(df, self.features)))


def boost_scores(scores: np.ndarray, binned: np.ndarray, rounds) -> np.ndarray:
    scores = scores.copy()
    for trees in rounds:
        for k, (tree, leaf) in enumerate(trees):
            scores[:, k] += leaf[tree.place(binned)]
    return scores


def _slim(rounds) -> list:
    """Rounds with what placing rows needs, and no more, to be sent to tasks."""
    return [[(Tree(*[np.array(x, np.int64) for x in (t.feature, t.bin, t.left)]), leaf) for t, leaf in r] for r in rounds]


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def boost_stats(b: Block, recent, k: int, unit: float, double_hessian: bool) -> np.ndarray:
    """Gradient, hessian and weight of class ``k`` after the rounds ``recent``, as
    whole numbers."""
    if b.shares is None:
        b.shares = softmax(boost_scores(b.scores, b.x, recent))
    return class_stats(b.shares[:, k], b.y == k, b.w, unit, double_hessian)


def class_stats(p: np.ndarray, hit: np.ndarray, weight: np.ndarray, unit: float, double_hessian: bool) -> np.ndarray:
    w = weight / unit
    h = p * (1 - p) * (2.0 if double_hessian else 1.0)
    return np.stack([np.rint((p - hit) * w * unit), np.rint(np.maximum(h, 1e-16) * w * unit), weight], axis=1)


def _leaf_values(tree: Tree, factor: float, l2: float, unit: float) -> np.ndarray:
    s = np.array(tree.sums, np.float64).reshape(len(tree.feature), -1) / unit
    low = s[:, 1] + l2
    return np.divide(-factor * s[:, 0], low, out=np.zeros(len(s)), where=low > 0)


def fit_boosting(df: DataFrame, features: str, label: str, weight: str | None, classes: int, rules: Rules, rounds: int,
                 rate: float, prior: bool, double_hessian: bool = False, bins: int = BINS, task_rows: int | None = None,
                 average_gain: bool = False) -> BoostModel:
    """Softmax boosting: every round fits one tree per class to the gradients of
    the log loss, all classes from the same scores.  A node of at most
    ``task_rows`` rows (None: as many as ``TASK_BYTES`` hold) fits a task.

    ``prior`` starts from the log class shares and scales leaves by (K - 1) / K;
    otherwise all scores start at zero.
    """
    edges = bin_edges(df, features, bins)
    d = len(edges)
    task_rows = max(1, TASK_BYTES // max(d, 1)) if task_rows is None else task_rows
    w = F.lit(1.0) if weight is None else F.col(weight)
    told = df.groupBy(F.col(label).cast("int").alias("y")).agg(F.count(F.lit(1)).alias("n"), F.sum(w).alias("w"), F.max(w).alias("m")).collect()
    n_rows, largest = sum(r["n"] for r in told), max(r["m"] for r in told)
    unit = fixed_point(n_rows, largest * 2)
    start = np.zeros(classes)
    if prior:
        share = np.full(classes, 1e-12)
        for r in told:
            share[r["y"]] = r["w"] / sum(x["w"] for x in told)
        start = np.log(share)
    factor = rate * ((classes - 1) / classes if prior else 1.0)
    blocks = materialize(_with_scores(row_blocks(df, features, label, weight, edges, unit), start, d)
                         .withColumn("block", F.monotonically_increasing_id()))
    small = n_rows <= task_rows
    if small:
        places = seats(df.sparkSession, classes)
        copies = _copies(blocks, places)
    done: list = []
    folded = 0
    for _ in range(rounds):
        recent = _slim(done[folded:])
        if small:
            grown = _boost_in_tasks(blocks, copies, places, recent, classes, d, rules, unit, bins, double_hessian)
        else:
            grown = _boost_in_both_phases(blocks, recent, classes, d, rules, unit, bins, double_hessian, task_rows, n_rows)
        done.append([(t, _leaf_values(t, factor, rules.l2, unit)) for t in grown])
        if len(done) - folded == FOLD and len(done) < rounds:
            blocks, folded = materialize(_fold(blocks, _slim(done[folded:]), classes, d)), len(done)
    return BoostModel(edges, start, done, features, _boost_importances([t for r in done for t, _ in r], d, average_gain))


def _with_scores(blocks: DataFrame, start: np.ndarray, d: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            yield batch.append_column("scores", pa.array([np.tile(start, (n, 1)).tobytes() for n in batch.column("n").to_pylist()], pa.binary()))
    return blocks.mapInArrow(run, "n int, x binary, y binary, w binary, h binary, scores binary")


def _copies(blocks: DataFrame, places: list[int]) -> DataFrame:
    """What does not change of all rows, once per class, in a partition per class."""
    conf, name = blocks.sparkSession.conf, "spark.sql.adaptive.enabled"
    before = conf.get(name)
    # an adaptive plan forgets how its rows are dealt, and every round would deal them anew
    conf.set(name, "false")
    try:
        return materialize(blocks.select(F.explode(F.array(*[F.lit(x) for x in places])).alias("seat"), "block", "x", "y", "w")
                           .repartition(len(places), "seat"))
    finally:
        conf.set(name, before)


def _fold(blocks: DataFrame, rounds, classes: int, d: int) -> DataFrame:
    """The blocks with the scores after ``rounds``."""
    def run(batches):
        for batch in batches:
            new = [boost_scores(b.scores, b.x, rounds).tobytes() for b in _blocks(batch, d, classes)]
            yield batch.set_column(batch.schema.get_field_index("scores"), "scores", pa.array(new, pa.binary()))
    return blocks.mapInArrow(run, blocks.schema)


def _boost_in_tasks(blocks, copies, places, recent, classes, d, rules, unit, bins, double_hessian) -> list[Tree]:
    """One round, a class a task: blocks send the rows' shares of a class to the
    partition where the class has its copy of the rows."""
    import pickle

    def share(batches):
        for batch in batches:
            for at, b in zip(batch.column("block"), _blocks(batch, d, classes)):
                p = softmax(boost_scores(b.scores, b.x, recent))
                yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array([at.as_py()] * classes, pa.int64()),
                                                  pa.array([np.ascontiguousarray(p[:, k]).tobytes() for k in range(classes)], pa.binary())],
                                                 names=["seat", "block", "p"])

    def grow(seat, shares: pa.Table, rows: pa.Table) -> pa.Table:
        cls = places.index(seat[0].as_py())
        of = dict(zip(shares.column("block").to_pylist(), shares.column("p")))

        def whole(column, kind):
            return np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in column])
        x = whole(rows.column("x"), np.uint8).reshape(-1, d)
        p = whole([of[at] for at in rows.column("block").to_pylist()], np.float64)
        s = class_stats(p, whole(rows.column("y"), "<i4") == cls, whole(rows.column("w"), "<i8"), unit, double_hessian)
        tree = Tree()
        tree.add(np.rint(s.sum(0)).astype(np.int64), cls + 1, 0)
        finish(tree, np.zeros(len(x), np.int64), x, s, None, rules, unit, bins, [0])
        return pa.table({"cls": pa.array([cls], pa.int32()), "tree": pa.array([pickle.dumps(tree.__dict__)], pa.binary())})
    shares = blocks.mapInArrow(share, "seat int, block long, p binary")
    got = shares.groupBy("seat").cogroup(copies.groupBy("seat")).applyInArrow(grow, "cls int, tree binary").collect()   # one small tree per class
    return [Tree(**pickle.loads(r["tree"])) for r in sorted(got, key=lambda r: r["cls"])]


def _boost_in_both_phases(blocks, recent, classes, d, rules, unit, bins, double_hessian, task_rows, n_rows) -> list[Tree]:
    """One round: level jobs split the nodes of more than ``task_rows`` rows; then
    the rows of all smaller open nodes meet in tasks, one node each."""
    import pickle

    def stats(b: Block, t: int):
        return boost_stats(b, recent, t, unit, double_hessian), None, np.ones(len(b.x), bool)
    trees = [Tree() for _ in range(classes)]
    for t, tree in enumerate(trees):
        tree.add(None, t + 1, 0)         # the first level job tells the sums
    small: list[list[int]] = [[] for _ in trees]
    fronts = [[(0, n_rows)] for _ in trees]
    while any(fronts):
        open_ = [[(i, n) for i, n in own if open_node(trees[t].sums[i], trees[t].depth[i], rules, n)] for t, own in enumerate(fronts)]
        for t, own in enumerate(open_):
            small[t] += [i for i, n in own if n <= task_rows]
        large = [[i for i, n in own if n > task_rows] for own in open_]
        fronts = level(blocks, trees, large, stats, rules, unit, bins, d, 3, classes) if any(large) else []
    if trees[0].sums[0] is None:         # nothing to split
        for t, s in enumerate(_root_sums(blocks, stats, classes, d, 3, classes)):
            trees[t].sums[0] = s
    if not any(small):
        return trees

    def deal(batches):
        for batch in batches:
            for b in _blocks(batch, d, classes):
                for t in range(classes):
                    if not small[t]:
                        continue
                    at, s = trees[t].place(b.x), stats(b, t)[0]
                    for i in small[t]:
                        mine = np.flatnonzero(at == i)
                        if len(mine):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([t], pa.int32()), pa.array([i], pa.int32()), pa.array([b.x[mine].tobytes()], pa.binary()),
                                 pa.array([s[mine].astype(np.float64).tobytes()], pa.binary())], names=["tree", "node", "x", "s"])

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        t, i = int(pdf["tree"].iloc[0]), int(pdf["node"].iloc[0])
        x = np.frombuffer(b"".join(pdf["x"]), np.uint8).reshape(-1, d)
        s = np.frombuffer(b"".join(pdf["s"])).reshape(-1, 3)
        tree = Tree()
        tree.add(trees[t].sums[i], trees[t].path[i], trees[t].depth[i])
        finish(tree, np.zeros(len(x), np.int64), x, s, None, rules, unit, bins, [0])
        return pd.DataFrame({"tree": [t], "node": [i], "data": [pickle.dumps(tree.__dict__)]})
    got = (blocks.mapInArrow(deal, "tree int, node int, x binary, s binary")
           .groupBy("tree", "node").applyInPandas(grow, "tree int, node int, data binary"))
    for r in sorted(got.collect(), key=lambda r: (r["tree"], r["node"])):     # a subtree a node
        trees[r["tree"]].graft(r["node"], Tree(**pickle.loads(r["data"])))
    return trees


def _root_sums(blocks, stats, n_trees: int, d: int, wide: int, classes: int) -> list[np.ndarray]:
    def run(batches):
        total = np.zeros((n_trees, wide), np.int64)
        for batch in batches:
            for b in _blocks(batch, d, classes):
                for t in range(n_trees):
                    s, c, live = stats(b, t)
                    if c is not None:
                        total[t] += np.rint(np.bincount(c[live], weights=s[live, 0], minlength=wide)).astype(np.int64)
                    else:
                        total[t] += np.rint(s[live].sum(0)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n_trees), pa.int32()), *[pa.array(c) for c in total.T]],
                                         names=["tree", *[f"s{j}" for j in range(wide)]])
    got = blocks.mapInArrow(run, "tree int, " + ", ".join(f"s{j} long" for j in range(wide))).groupBy("tree").agg(
        *[F.sum(f"s{j}").alias(f"s{j}") for j in range(wide)]).collect()
    return [np.array([r[f"s{j}"] for j in range(wide)], np.int64) for r in sorted(got, key=lambda r: r["tree"])]


def _gains(feature, gain, d: int) -> tuple[np.ndarray, np.ndarray]:
    feature, gain = np.asarray(feature), np.asarray(gain)
    inner = feature >= 0
    return (np.bincount(feature[inner], weights=np.maximum(gain[inner], 0), minlength=d), np.bincount(feature[inner], minlength=d))


def _boost_importances(trees: list[Tree], d: int, average_gain: bool) -> list[float]:
    """Share of a feature in the trees' gains: the mean gain of its splits, or the
    mean over the trees of its share in the tree."""
    total, count = np.zeros(d), np.zeros(d)
    for t in trees:
        g, c = _gains(t.feature, t.gain, d)
        total += g if average_gain else g / max(g.sum(), 1e-300)
        count += c
    if average_gain:
        total = total / np.maximum(count, 1)
    return [float(x) for x in total / max(total.sum(), 1e-300)]


# ---------------------------------------------------------------- forest

def bootstrap(h: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often a row is drawn for a tree: a Poisson(1) count fixed by the row's
    hash, so it is the same in any partitioning."""
    salt = _mix(np.array([((1 + tree) * 0x9E3779B97F4A7C15 + seed) % (1 << 64)], np.uint64))
    u = _mix(h.view(np.uint64) ^ salt).astype(np.float64) / 2.0**64
    border = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(16)])
    return np.searchsorted(border, u, side="right").astype(np.int64)


@dataclass
class ForestModel:
    """``tops``: the trees' nodes split by level jobs; ``subtrees``: a table
    (tree, node, bytes) of the rest.  ``transform`` adds the class with the
    largest mean share over the trees (first on ties) as ``prediction``."""
    edges: list
    tops: list
    subtrees: DataFrame
    classes: int
    features: str
    featureImportances: list

    def passes(self):
        """Groups of subtrees of at most ``PASS_BYTES`` (one at least)."""
        sizes = self.subtrees.select("tree", "node", F.length("data").alias("n")).orderBy("tree", "node")
        group, held = [], 0
        for r in sizes.toLocalIterator():
            if group and held + r["n"] > PASS_BYTES:
                yield group
                group, held = [], 0
            group.append((r["tree"], r["node"]))
            held += r["n"]
        if group:
            yield group

    def transform(self, df: DataFrame) -> DataFrame:
        """A pass per group of subtrees adds to every row's votes.  The votes are
        written before the next pass, so that a task holds one group at a time."""
        import pickle
        edges, classes, tops = self.edges, self.classes, self.tops
        out = df.withColumn("__votes", F.array(*[F.lit(0.0)] * classes))
        for n, group in enumerate(self.passes()):
            out = materialize(out) if n else out
            first, last = group[0], group[-1]
            key = F.struct("tree", "node")
            rows = self.subtrees.filter(key.between(F.struct(F.lit(first[0]).alias("tree"), F.lit(first[1]).alias("node")),
                                                    F.struct(F.lit(last[0]).alias("tree"), F.lit(last[1]).alias("node")))).collect()
            parts = {}
            for r in rows:
                t = pickle.loads(r["data"])
                parts.setdefault(r["tree"], {})[r["node"]] = (Tree(t["feature"], t["bin"], t["left"]), t["mixed"])

            out = out.withColumn("__votes", _voting(parts, tops, edges)(feature_array(df, self.features), F.col("__votes")))
        best = F.array_position("__votes", F.array_max("__votes")) - 1
        return out.withColumn("prediction", best.cast("double")).drop("__votes")


def _voting(parts: dict, tops: list, edges):
    """Adds the class shares of the subtrees ``parts`` to a row's votes."""
    @F.pandas_udf("array<double>")
    def add(x: pd.Series, sofar: pd.Series) -> pd.Series:
        if not len(x):
            return sofar
        binned = cut(np.stack(x.to_numpy()).astype(np.float64).reshape(-1, len(edges)), edges)
        total = np.stack(sofar.to_numpy()).astype(np.float64)
        for t, own in parts.items():
            at = tops[t].place(binned)
            for node, (sub, mixed) in own.items():
                here = np.flatnonzero(at == node)
                if len(here):
                    code = -1 - sub.left[sub.place(binned[here])].astype(np.int64)
                    pure = code < total.shape[1]
                    total[here[pure], code[pure]] += 1.0
                    share = mixed[code[~pure] - total.shape[1]].astype(np.float64)
                    total[here[~pure]] += share / share.sum(1, keepdims=True)
        return pd.Series(list(total))
    return add


def _packed(tree: Tree, classes: int, unit: float, d: int) -> dict:
    """What scoring needs of a grown subtree.  ``left`` of a leaf is -1 less its
    class or, if it has several, less their number and its place in ``mixed`` (the
    classes' weights)."""
    feature, left = np.array(tree.feature, np.int16 if d < 1 << 15 else np.int32), np.array(tree.left, np.int32)
    leaves = np.flatnonzero(feature < 0)
    weight = (np.array([tree.sums[i] for i in leaves]).reshape(len(leaves), classes) / unit).astype(np.float32)
    several = (weight > 0).sum(1) != 1
    left[leaves] = -1 - np.where(several, classes + np.cumsum(several) - 1, weight.argmax(1))
    return {"feature": feature, "bin": np.array(tree.bin, np.uint8), "left": left, "mixed": weight[several]}


def fit_forest(df: DataFrame, features: str, label: str, weight: str | None, classes: int, n_trees: int, rules: Rules,
               bins: int = BINS, task_rows: int = TASK_ROWS) -> ForestModel:
    """Random forest on bootstrap counts, to any depth: level jobs until a node's
    rows fit a task, then the subtree is finished there."""
    import pickle
    edges = bin_edges(df, features, bins)
    d, seed = len(edges), rules.seed
    w = F.lit(1.0) if weight is None else F.col(weight)
    n_rows, largest = df.agg(F.count(F.lit(1)), F.max(w)).first()
    unit = fixed_point(n_rows, largest * 16)
    blocks = materialize(row_blocks(df, features, label, weight, edges, unit))

    def stats(b: Block, t: int):
        count = bootstrap(b.h, t, seed)
        return (b.w * count)[:, None].astype(np.float64), b.y, count > 0
    tops = [Tree() for _ in range(n_trees)]
    for t, s in enumerate(_root_sums(blocks, stats, n_trees, d, classes, 0)):
        tops[t].add(s, int(_mix(np.array([t + 1]))[0]), 0)
    small: list[list[int]] = [[] for _ in range(n_trees)]
    fronts = [[(0, n_rows)] for _ in range(n_trees)]
    while any(fronts):
        large = [[i for i, n in f if n > task_rows and open_node(tops[t].sums[i], tops[t].depth[i], rules, n)] for t, f in enumerate(fronts)]
        for t, f in enumerate(fronts):
            small[t] += [i for i, _ in f if i not in large[t]]
        fronts = level(blocks, tops, large, stats, rules, unit, bins, d, classes) if any(large) else []
        for t in range(n_trees):       # a large node that no feature splits is a leaf
            small[t] += [i for i in large[t] if tops[t].feature[i] < 0]

    def deal(batches):
        for batch in batches:
            for b in _blocks(batch, d):
                for t in range(n_trees):
                    count = bootstrap(b.h, t, seed)
                    at = tops[t].place(b.x)
                    for i in small[t]:
                        mine = np.flatnonzero((at == i) & (count > 0))
                        if not len(mine):
                            continue
                        full = open_node(tops[t].sums[i], tops[t].depth[i], rules, 2)
                        keep = mine if full else mine[:0]      # the rows of a leaf need not travel
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([t], pa.int32()), pa.array([i], pa.int32()), pa.array([len(keep)], pa.int32()),
                             *[pa.array([v.tobytes()], pa.binary()) for v in (b.x[keep], b.y[keep].astype(np.int32), (b.w * count)[keep])]],
                            names=["tree", "node", "n", "x", "y", "w"])

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        t, i = int(pdf["tree"].iloc[0]), int(pdf["node"].iloc[0])
        x = np.frombuffer(b"".join(pdf["x"]), np.uint8).reshape(-1, d)
        y = np.frombuffer(b"".join(pdf["y"]), "<i4").astype(np.int64)
        w = np.frombuffer(b"".join(pdf["w"]), "<i8").astype(np.float64)
        tree = Tree()
        tree.add(tops[t].sums[i], tops[t].path[i], tops[t].depth[i])
        if len(x):
            finish(tree, np.zeros(len(x), np.int64), x, w[:, None], y, rules, unit, bins, [0])
        gain, _ = _gains(tree.feature, tree.gain, d)
        data = _packed(tree, classes, unit, d)
        return pd.DataFrame({"tree": [t], "node": [i], "data": [pickle.dumps(data)], "gains": [gain.tolist()], "depth": [max(tree.depth)]})
    subtrees = materialize(blocks.mapInArrow(deal, "tree int, node int, n int, x binary, y binary, w binary")
                           .groupBy("tree", "node").applyInPandas(grow, "tree int, node int, data binary, gains array<double>, depth int"))
    gains = np.zeros((n_trees, d))
    for r in subtrees.select("tree", F.posexplode("gains").alias("f", "g")).groupBy("tree", "f").agg(F.sum("g").alias("g")).collect():
        gains[r["tree"], r["f"]] = r["g"]
    for t in range(n_trees):
        gains[t] += _gains(tops[t].feature, tops[t].gain, d)[0]
    share = (gains / np.maximum(gains.sum(1, keepdims=True), 1e-300)).mean(0)
    return ForestModel(edges, tops, subtrees, classes, features, [float(x) for x in share / max(share.sum(), 1e-300)])
