"""Near-duplicate classes against brute force over all pairs."""

import collections
import random
import re

import numpy as np
from helpers import awkward, empty

from cadenza.llm import near_dedup, queries

SF001 = "/root/testdata/sf0.001"


def brute(rows, words=5, percent=75):
    sets = {}
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))
        sets[d] = {tuple(w[i:i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set())
    holders = collections.defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for d, s in sets.items():
        for y, k in collections.Counter(y for x in s for y in holders[x] if y > d).items():
            if 100 * k >= percent * (len(s) + len(sets[y]) - k) and root(d) != root(y):
                a, b = root(d), root(y)
                parent[max(a, b)] = min(a, b)
    return {(d, len(s), root(d), root(d) == d) for d, s in sets.items()}


def test_driver_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    got = {tuple(r)[:4] for r in queries.op6_near_dedup(spark, SF001).collect()}
    assert got == brute(rows)


def test_dense_groups_and_chains(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    rows, n = [], 0
    for size in (2, 5, 40, 150):  # many near copies of one text
        base = [word() for _ in range(80)]
        for _ in range(size):
            own = list(base)
            own[rng.randrange(80)] = word()
            rows.append((n, " ".join(own)))
            n += 1
    base = [word() for _ in range(60)]  # a chain whose ends are far apart
    for _ in range(12):
        base = [word(), word(), *base[:-2]]
        rows.append((n, " ".join(base)))
        n += 1
    common = [word() for _ in range(50)]  # one long common passage, short own parts
    for _ in range(60):
        rows.append((n, " ".join([*common, *(word() for _ in range(rng.randrange(4, 14)))])))
        n += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {tuple(r)[:4] for r in near_dedup.near_dedup(docs).collect()}
    assert got == brute(rows)


def test_crowded_boilerplate(spark):
    """5,000 documents share a passage; eight with short own parts are near copies."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    common = [word() for _ in range(104)]
    short = set(range(100, 5000, 613))
    rows = [(d, " ".join([*common, *(word() for _ in range(15 if d in short else 60))])) for d in range(5000)]
    sets = near_dedup.shingle_sets([t.encode() for _, t in rows], 5)
    flat, sizes = np.unique(np.concatenate(sets), return_inverse=True)[1], np.array([len(x) for x in sets])
    starts, mark, root = np.cumsum(sizes) - sizes, np.zeros(flat.max() + 1, np.int32), list(range(5000))
    for d in range(5000):  # brute force over all pairs
        own = flat[starts[d]: starts[d] + sizes[d]]
        mark[own] = 1
        k = np.add.reduceat(mark[flat], starts)
        mark[own] = 0
        for y in np.flatnonzero(100 * k >= 75 * (sizes + sizes[d] - k)):
            low, high = sorted((root[d], root[y]))
            root = [low if r == high else r for r in root] if low != high else root
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_dedup(docs).collect()}
    assert got == dict(enumerate(root)) and {got[d] for d in short} == {100}


def test_exact_pairs_lose_none(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 4)  # most shingles are split
    rng = np.random.default_rng(5)
    common = rng.integers(0, 2**63, 60, dtype=np.uint64)
    sets = [np.unique(np.concatenate((common[rng.random(60) < 0.95], rng.integers(0, 2**63, rng.integers(1, 50), dtype=np.uint64))))
            for _ in range(120)]
    rows = [(i, bytearray(x.tobytes()), i // 2) for i, x in enumerate(sets)]
    got = {tuple(r) for r in near_dedup._exact_pairs(spark.createDataFrame(rows, "id long, items binary, label long"), 75).collect()}
    for i, x in enumerate(sets):
        for j in range(i + 1, len(sets)):
            k = len(np.intersect1d(x, sets[j]))
            if 100 * k >= 75 * (len(x) + len(sets[j]) - k):
                assert i // 2 == j // 2 or (i, j) in got
    assert len(got) < 120 * 119 // 2


def test_awkward_rows(spark):
    got = near_dedup.near_dedup(awkward(spark)).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 11
    assert by[1]["component_id"] == by[2]["component_id"] == 1 and not by[2]["kept"]
    assert by[3]["n_shingles"] == by[4]["n_shingles"] == by[5]["n_shingles"] == 0
    assert all(by[i]["component_id"] == i and by[i]["kept"] for i in (3, 4, 5, 8, 9))
    assert by[6]["component_id"] == by[7]["component_id"] == 6
    assert by[8]["n_shingles"] == 1 and by[None]["kept"]
    kept = near_dedup.drop_near_copies(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 3, 4, 5, 6, 8, 9]


def test_empty(spark):
    assert near_dedup.near_dedup(empty(spark)).count() == 0


def test_components_of_long_paths(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 150)]
    got = dict(tuple(r) for r in near_dedup.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 150: 100, 200: 100}


def test_signature_estimates_similarity():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 2000, dtype=np.uint64)
    b = np.concatenate([a[:1500], rng.integers(0, 2**63, 500, dtype=np.uint64)])
    sig = near_dedup.signatures([np.unique(a), np.unique(b)])
    assert abs((sig[0] == sig[1]).mean() - 0.6) < 0.2


def test_neighbours_of_sorted_orders(spark, monkeypatch):
    """All pairs of small regions, close ones of crowded regions, whatever the
    ranges and batches."""
    rng = np.random.default_rng(2)
    rows = [(int(r), bytes([int(x)]), n) for n, (r, x) in enumerate(zip(rng.choice(40, 700, p=np.r_[0.3, np.full(39, 0.7 / 39)]), rng.integers(0, 9, 700)))]
    paths = spark.createDataFrame(rows, "region long, path binary, id long")
    near, close = 16, 2
    groups = collections.defaultdict(list)
    for r, x, n in sorted(rows):
        groups[r].append(n)
    need = {tuple(sorted((g[i], g[j]))) for g in groups.values() for i in range(len(g)) for j in range(i + 1, len(g))
            if len(g) <= near + 1 or j - i <= close}
    for parts, size in ((1, 1 << 15), (1, 7), (5, 30)):
        batches = near_dedup.full_batches
        monkeypatch.setattr(near_dedup, "full_batches", lambda b, n, size=size, batches=batches: batches(b, size))
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        got = near_dedup._neighbours(paths, near, close).collect()
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        monkeypatch.setattr(near_dedup, "full_batches", batches)
        pairs = [(r["a"], r["b"]) for r in got if r["a"] is not None]
        assert len(pairs) == len(set(pairs)) and set(pairs) <= need
        if parts == 1:
            assert set(pairs) == need
        else:
            border = {r["id"] for r in got if r["a"] is None}
            assert all(a in border and b in border for a, b in need - set(pairs))
