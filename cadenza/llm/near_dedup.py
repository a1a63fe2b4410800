"""MinHash near-duplicate detection with an LSH forest.

A document's signature holds ``FUNCTIONS`` MinHash values of its shingle set.
The forest keeps ``ORDERS`` sorted orders of the signatures; order ``t`` sorts
by the functions from ``2 t`` on, so no two orders lead with the same ones.
Rows of an order that share its first ``PREFIX`` values form a region.  Every
order is range-partitioned and sorted, and a class is paired with neighbours
before and after it in its region: those with the longest common prefixes.  The
depth adapts to the region: one of up to ``NEAR + 1`` rows offers all its pairs,
a crowded one those of ``CLOSE`` neighbours to either side, which agree in the
more values the more crowded it is.  Rows at the borders of the ranges meet in a
second step.

What crowded regions do not offer that way is found exactly: classes of regions
whose members are still in different components are joined on the rare ends of
their full sets (see ``_exact_pairs``).

Documents with equal shingle sets are one class before the forest, so a group
of copies of any size is a single entry.  Candidates whose signatures agree in
too few places are dropped by a bound that a link at the threshold falls under with a
chance of 1e-9 (see ``least_equal``); all others are confirmed on the full sets, in
two rounds: first the best partners of each document, then every candidate
whose ends are not yet connected.  Components come from large-star / small-star
rounds in Spark.

Defined cases: a null or empty text, or one of white space alone, has an empty
set, is linked with nothing and forms a component of its own; fewer words than
a shingle make one shingle of the whole sequence; repeated rows and rows with a
null id follow their set's class (a null id is never the smallest unless alone);
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import WHITE, anti, arrow_map, byte_hashes, joined, mix64, released, saved, semi, tables
from cadenza.llm.vectors import full_batches

FUNCTIONS, ORDERS, PREFIX, DEPTH = 64, 32, 3, 8
#: Regions of up to NEAR + 1 rows offer all their pairs, larger ones those of
#: CLOSE neighbours to either side.
NEAR, CLOSE = 12, 2
#: Buckets of shingle counts by which the exact join orders shingles (rarest
#: first), and the holders of a shingle that lie in one block.
COUNTS, BLOCK = 1 << 20, 1024

_RNG = np.random.default_rng(7919)
_A = _RNG.integers(1, 2**63, FUNCTIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 2**63, FUNCTIONS, dtype=np.uint64)
_C = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHORT = np.arange(64, dtype=np.uint64) * _C[-1]  # by the words of a text shorter than a shingle
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_hashes(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all word shingles of some texts, and the number of each
    text's shingles (with repetitions)."""
    data, doc_starts = joined(texts)
    data = _LOWER[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], WHITE[data], [True])).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    w = byte_hashes(data).spans(starts, ends)
    first = np.searchsorted(starts, doc_starts)
    n_words = np.diff(np.append(first, len(starts)))
    total = np.zeros(len(w), dtype=np.uint64)
    for j in range(words):
        total[: len(w) - j] += w[j:] * _C[j]
    n = np.where(n_words >= words, n_words - words + 1, (n_words > 0).astype(n_words.dtype))
    keep = np.repeat(first, n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
    out = total[keep]
    at = np.cumsum(n) - n
    for d in np.flatnonzero((n_words > 0) & (n_words < words)):
        own = w[first[d]: first[d] + n_words[d]]
        out[at[d]] = np.append(own * _C[: len(own)], _SHORT[len(own)]).sum(dtype=np.uint64)
    return mix64(out), n


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    hashes, n = shingle_hashes(texts, words)
    ends = np.cumsum(n)
    return [np.unique(hashes[e - k: e]) for e, k in zip(ends, n, strict=True)]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values (documents x FUNCTIONS, uint32) of non-empty sets."""
    sizes = np.fromiter((len(s) for s in sets), dtype=np.int64, count=len(sets))
    out = np.zeros((len(sets), FUNCTIONS), dtype=np.uint32)
    full = np.flatnonzero(sizes)
    if len(full):
        flat = np.concatenate([sets[i] for i in full])
        at = np.cumsum(sizes[full]) - sizes[full]
        for f in range(FUNCTIONS):
            values = ((flat * _A[f] + _B[f]) >> np.uint64(32)).astype(np.uint32)
            out[full, f] = np.minimum.reduceat(values, at)
    return out


def classes_of(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, set_key (digest of the set), signature."""
    def rows(batch, texts):
        sets = shingle_sets(texts, words)
        sig = signatures(sets)
        return {"doc_id": batch.column("doc_id"),
                "n_shingles": np.fromiter((len(s) for s in sets), np.int64, len(sets)),
                "set_key": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                "signature": [x.tobytes() for x in sig]}
    return arrow_map(tables(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long")),
                     rows, "doc_id long, n_shingles long, set_key binary, signature binary")


def least_equal(percent: int) -> int:
    """Signature places that must agree.  For a pair at the threshold the number
    is binomial; the bound lies six standard deviations under its mean."""
    p = percent / 100
    return int(FUNCTIONS * p - 6 * (FUNCTIONS * p * (1 - p)) ** 0.5)


def _paths(reps: DataFrame) -> DataFrame:
    """One row per class and order: the region (first values of the order) and
    the values that follow, as bytes that sort like numbers."""
    t = np.arange(ORDERS)
    after = (2 * t[:, None] + PREFIX + np.arange(DEPTH)) % FUNCTIONS

    def rows(batch):
        sig = np.frombuffer(b"".join(batch.column("signature").to_pylist()), dtype=np.uint32).reshape(-1, FUNCTIONS)
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        key = _A[t] * np.uint64(3)
        for i in range(PREFIX):
            key = mix64(key + sig[:, (2 * t + i) % FUNCTIONS])
        path = np.ascontiguousarray(sig[:, after].astype(">u4")).reshape(-1, DEPTH)
        flat = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * DEPTH), len(path), [None, pa.py_buffer(path.tobytes())])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(ids, ORDERS)), pa.array(key.view(np.int64).ravel()), flat.cast(pa.binary())], names=["id", "region", "path"])

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                yield rows(batch.slice(i, 4096))
    return reps.select("id", "signature").mapInArrow(released(run), "id long, region long, path binary")


def _neighbours(paths: DataFrame, near: int, close: int) -> DataFrame:
    """Pairs (a, b) of rows in the sorted order of a range: all of a region of at
    most ``near + 1`` rows, those at most ``close`` apart in a larger one; and, with
    a null pair, the first and last ``near`` rows of every range (region, path, id)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("region", pa.int64()), ("path", pa.binary()), ("id", pa.int64())])

    def table(a, b, border=None):
        n = len(a) if border is None else border.num_rows
        cols = ([pa.array(a), pa.array(b), *[pa.nulls(n, f.type) for f in list(schema)[2:]]] if border is None else
                [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), *[border.column(c) for c in ("region", "path", "id")]])
        return pa.RecordBatch.from_arrays(cols, schema=schema)

    def pairs(r, i, told, last):
        """Pairs of complete regions; ``told`` rows at the front are the end of a
        crowded region, their own pairs are out already."""
        heads = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
        run = np.cumsum(np.concatenate(([False], r[1:] != r[:-1])))
        crowded = np.diff(np.append(heads, len(r))) > near + 1
        if told:
            crowded[0] = True
        for k in range(1, near + 1):
            x = np.flatnonzero(r[:-k] == r[k:]) if len(r) > k else np.zeros(0, np.int64)
            if k > close:
                x = x[~crowded[run[x]]]
            x = x[(x + k >= told) & (x < last)]
            if len(x):
                yield table(np.minimum(i[x], i[x + k]), np.maximum(i[x], i[x + k]))

    def run(batches):
        first, region, ids, told, tail = 0, np.zeros(0, np.int64), np.zeros(0, np.int64), 0, None
        for batch in full_batches(batches, 1 << 15):
            if first < near:
                head = batch.slice(0, near - first)
                first += head.num_rows
                yield table(None, None, head)
            own_r, own_i = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("region", "id"))
            r, i = np.concatenate((region, own_r)), np.concatenate((ids, own_i))
            # the last region may go on: a small one waits, a crowded one leaves its end
            at = int(np.searchsorted(r, r[-1])) if len(r) else 0
            small = len(r) - at <= near + 1 and not (told and at == 0)
            yield from pairs(r, i, told, at if small else len(r))
            keep = at if small else max(at, len(r) - close)
            region, ids, told = r[keep:], i[keep:], 0 if small else len(r) - keep
            tail = pa.Table.from_batches(([tail] if tail is not None else []) + [batch.slice(max(0, batch.num_rows - near))])
            tail = tail.slice(max(0, tail.num_rows - near)).combine_chunks().to_batches()[0]
        if tail is not None:
            yield from pairs(region, ids, told, len(region))
            yield table(None, None, tail)
    order = ["region", "path", "id"]
    return (paths.repartitionByRange(*order).sortWithinPartitions(*order).select(*order)
            .mapInArrow(released(run), "a long, b long, region long, path binary, id long"))


def candidates(reps: DataFrame, near: int = NEAR, close: int = CLOSE) -> tuple[DataFrame, DataFrame]:
    """Distinct candidate pairs (a < b) of classes that the forest offers, and the
    rows (region, id) of crowded regions, whose pairs may be incomplete.

    ``reps``: id, signature.
    """
    paths = saved(_paths(reps), "forest-paths")
    found = saved(_neighbours(paths, near, close), "forest-neighbours")
    # rows beside a border of ranges: neighbours across it are neighbours among them
    by = Window.partitionBy("region").orderBy("path", "id")
    border = found.filter("a is null").select("region", "path", "id").distinct()
    after = border.select("id", F.array(*[F.lead("id", k).over(by) for k in range(1, near + 1)]).alias("after"))
    across = after.select("id", F.explode("after").alias("other")).filter("other is not null").select(
        F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"))
    pairs = found.filter("a is not null").select("a", "b").unionByName(across).filter("a < b").distinct()
    crowded = paths.groupBy("region").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > near + 1).select("region")
    return pairs, paths.join(crowded, "region", "left_semi").select("region", "id")


def _shingle_counts(sets: DataFrame) -> np.ndarray:
    """How often each bucket of shingles occurs in the sets; never too low."""
    def run(batches):
        n = np.zeros(COUNTS, dtype=np.int64)
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("items").to_pylist()), np.uint64) % np.uint64(COUNTS)
            n += np.bincount(x.astype(np.int64), minlength=COUNTS)
        some = np.flatnonzero(n)
        for i in range(0, len(some), 1 << 16):
            part = some[i: i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(n[part])], names=["bucket", "n"])
    got = sets.select("items").mapInArrow(released(run), "bucket int, n long").groupBy("bucket").agg(
        F.sum("n").alias("n")).toArrow()
    out = np.zeros(COUNTS, dtype=np.uint32)
    out[got.column("bucket").to_numpy()] = np.minimum(got.column("n").to_numpy(), 2**32 - 1)
    return out


def _exact_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """Every pair of sets that can pass ``percent`` and whose ends differ in
    ``label``, by prefix filtering.

    ``sets``: id, items, label.  With all sets in one order of shingles, rare
    ones first, two sets that pass share a shingle among the first
    ``n - ceil(n * percent / 100) + 1`` of each, and at the first one they share
    both have enough left.  Shingles that one label alone holds are dropped.  The
    holders of a shingle lie in blocks; a shingle of many holders meets by a
    table of block pairs, so that no holder is copied for itself.  Pairs whose
    signatures agree in too few places (``least_equal``, on the low byte of each
    value, which can only agree more often) are not put out.
    """
    counts = _shingle_counts(sets)
    least = least_equal(percent)

    def run(batches):
        for batch in batches:
            cols = [[], [], [], [], [], []]
            items = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("items")]
            low = (signatures(items) & np.uint32(255)).astype(np.uint8)
            for i, x, label, sig in zip(batch.column("id").to_pylist(), items, batch.column("label").to_pylist(), low, strict=True):
                often = counts[x % np.uint64(COUNTS)]
                first = np.lexsort((x, often))[: len(x) + (-len(x) * percent) // 100 + 1]
                pos = np.flatnonzero(often[first] > 1)  # others are in no second set
                for c, v in zip(cols, (x[first[pos]].view(np.int64), pos, np.full(len(pos), i), np.full(len(pos), len(x)),
                                       np.full(len(pos), label)), strict=False):
                    c.append(v)
                cols[5] += [sig.tobytes()] * len(pos)
            if cols[0]:
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(np.concatenate(c).astype(t)) for c, t in zip(cols, ("i8", "i4", "i8", "i4", "i8"))], pa.array(cols[5], pa.binary())],
                    names=["shingle", "pos", "id", "size", "label", "low"])
    rows = saved(sets.select("id", "items", "label").mapInArrow(
        released(run), "shingle long, pos int, id long, size int, label long, low binary"), "exact-prefixes")
    shared = saved(rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("low"), F.max("label").alias("high"))
                   .filter("low != high").select("shingle", F.ceil(F.col("n") / F.lit(BLOCK)).cast("int").alias("parts")), "exact-shingles")
    # of a hot shingle's holders about BLOCK meet in a group
    blocks = saved(rows.join(shared, "shingle").withColumn("part", F.pmod(F.xxhash64("id", "shingle"), F.col("parts")).cast("int"))
                   .groupBy("shingle", "parts", "part").agg(F.collect_list(F.struct("pos", "id", "size", "label", "low")).alias("m")), "exact-blocks")
    two = shared.filter("parts > 1").select("shingle", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("p"), "parts").select(
        "shingle", "p", F.explode(F.sequence(F.col("p"), F.col("parts") - 1)).alias("q"))
    met = blocks.filter("parts = 1").select("m", F.lit(None).cast(blocks.schema["m"].dataType).alias("o")).unionByName(
        two.join(blocks.select("shingle", F.col("part").alias("p"), "m"), ["shingle", "p"])
        .join(blocks.select("shingle", F.col("part").alias("q"), F.col("m").alias("o")), ["shingle", "q"])
        .select("m", F.when(F.col("p") != F.col("q"), F.col("o")).alias("o")))

    def holders(column, i):
        m = column[i].values
        pos, ids, size, label = (m.field(j).to_numpy(zero_copy_only=False).astype(np.int64) for j in range(4))
        return pos, ids, size, label, np.frombuffer(b"".join(m.field(4).to_pylist()), np.uint8).reshape(-1, FUNCTIONS)

    def meet(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                pos, ids, size, label, low = holders(batch.column("m"), i)
                same = not batch.column("o")[i].is_valid
                opos, oids, osize, olabel, olow = (pos, ids, size, label, low) if same else holders(batch.column("o"), i)
                for a in range(0, len(ids), 64):
                    part = slice(a, a + 64)
                    left = np.minimum((size - pos)[part, None], (osize - opos)[None])
                    ok = (label[part, None] != olabel[None]) & (left * (100 + percent) >= percent * (size[part, None] + osize[None]))
                    if same:
                        ok &= ids[part, None] < oids[None]
                    x, y = np.nonzero(ok)
                    for c in range(0, len(x), 1 << 16):
                        u, v = x[c:c + (1 << 16)] + a, y[c:c + (1 << 16)]
                        alike = (low[u] == olow[v]).sum(1) >= least
                        u, v = ids[u[alike]], oids[v[alike]]
                        if len(u):
                            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["a", "b"])
    return met.mapInArrow(released(meet), "a long, b long").distinct()


def estimated(pairs: DataFrame, reps: DataFrame, least: int) -> DataFrame:
    """Candidates whose signatures agree in ``least`` places or more."""
    a = reps.select(F.col("id").alias("a"), F.col("signature").alias("sa"))
    b = reps.select(F.col("id").alias("b"), F.col("signature").alias("sb"))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                sa, sb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, FUNCTIONS)
                          for c in ("sa", "sb"))
                equal = (sa == sb).sum(axis=1).astype(np.int32)
                keep = np.flatnonzero(equal >= least)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("a").take(pa.array(keep)), batch.column("b").take(pa.array(keep)),
                     pa.array(equal[keep])], names=["a", "b", "equal"])
    return pairs.join(a, "a").join(b, "b").mapInArrow(released(run), "a long, b long, equal int")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets pass ``100 * intersection >= percent * union``."""
    a = sets.select(F.col("id").alias("a"), F.col("items").alias("xa"))
    b = sets.select(F.col("id").alias("b"), F.col("items").alias("xb"))

    def run(batches):
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column("xa"), batch.column("xb"), strict=True)):
                x, y = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                # both sorted and distinct: equal neighbours after a merge are shared
                both = np.sort(np.concatenate((x, y)), kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                if 100 * shared >= percent * (len(both) - shared):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(keep, pa.int64())) for c in ("a", "b")],
                                             names=["a", "b"])
    return pairs.select("a", "b").join(a, "a").join(b, "b").mapInArrow(released(run), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) for every node with a link.

    Alternating large-star and small-star rounds: each moves links to smaller
    nodes until every component is a star.  Nodes are grouped by aggregates
    only, so a hub's neighbours never have to fit in one task.
    """
    edges = saved(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc-0")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: larger neighbours of u go to the smallest of u and its neighbours
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = saved(large, "cc-large")
        # small star: u and its smaller neighbours go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        new = saved(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))).filter("u != v").distinct(), "cc-small")
        # a star: no target has a link of its own, and each node has one target
        more = new.select(F.col("v").alias("u")).join(new.select("u"), "u", "left_semi")
        if more.isEmpty():
            return new.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                new.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        edges = new


def near_dedup(docs: DataFrame, words: int = 5, percent: int = 75, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, class_id
    (smallest id with the same shingle set)."""
    rows = saved(classes_of(docs, words, id_col, text_col), "near-rows")
    # a class is named by its smallest id; a class without any id has none
    named = rows.filter("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("id"))
    members = saved(rows.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left")
                    .withColumn("class_id", F.coalesce("id", "doc_id")).drop("id", "set_key"), "near-members")
    reps = saved(rows.join(named.select("set_key", "id"), "set_key").filter("doc_id = id")
                 .dropDuplicates(["id"]).select("id", "signature", "n_shingles"), "near-reps")
    offered, crowded = candidates(reps)
    found = saved(estimated(offered, reps, least_equal(percent)), "near-candidates")

    crowded = saved(crowded, "near-crowded")
    ends = found.select(F.explode(F.array("a", "b")).alias("id")).unionByName(crowded.select("id")).distinct()

    def sets(batch, texts):
        return {"id": batch.column("id"), "items": [s.tobytes() for s in shingle_sets(texts, words)]}
    wanted = tables(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    full = saved(arrow_map(semi(wanted, saved(ends, "near-ends"), "id").dropDuplicates(["id"]), sets,
                           "id long, items binary"), "near-sets")

    # first the best partner of each end, then what may still join components,
    # then what only the full sets of crowded regions show
    best = F.max_by(F.struct("a", "b"), F.struct("equal", "a", "b"))
    first = (found.groupBy("a").agg(best.alias("p")).select("p.a", "p.b")
             .unionByName(found.groupBy("b").agg(best.alias("p")).select("p.a", "p.b")).distinct())
    first = saved(first, "near-first")
    links = saved(confirmed(first, full, percent), "near-links")
    comp = saved(components(links), "near-components")
    rest = (found.select("a", "b").join(first, ["a", "b"], "left_anti")
            .join(comp.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left")
            .join(comp.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left")
            .filter("ca is null or cb is null or ca != cb").select("a", "b"))
    more = saved(confirmed(rest, full, percent), "near-more")
    if not more.isEmpty():
        links = links.unionByName(more)
        comp = saved(components(links), "near-components")
    # regions all of whose members are connected have nothing left to offer
    labels = comp.select(F.col("node").alias("id"), F.col("component").alias("label"))
    own = crowded.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    apart = own.groupBy("region").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low != high")
    still = saved(own.join(apart.select("region"), "region", "left_semi").select("id", "label").distinct(), "exact-open")
    if not still.isEmpty():
        pairs = saved(_exact_pairs(saved(full.join(still, "id"), "exact-sets"), percent), "exact-pairs")
        more = saved(confirmed(pairs, full, percent), "near-exact")
        if not more.isEmpty():
            comp = saved(components(links.unionByName(more)), "near-components")
    return members.join(comp.select(F.col("node").alias("class_id"), "component"), "class_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "class_id").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component", "class_id"), F.lit(True)).alias("kept"), "class_id")


def drop_near_copies(docs: DataFrame, words: int = 5, percent: int = 75, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """One document of each group stays, with all its columns."""
    gone = saved(near_dedup(docs, words, percent, id_col, text_col).filter("not kept").select("doc_id"), "near-gone")
    return anti(docs, gone.select(F.col("doc_id").alias(id_col)), id_col).select(
        *[F.col(f"`{c}`") for c in docs.columns])
