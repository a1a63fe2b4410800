"""Benchmark passages against a plain search and a plain edit distance."""

import random
import re

from helpers import awkward, empty

from cadenza.llm import decontaminate as D
from cadenza.llm import queries

SF001 = "/root/testdata/sf0.001"
ITEM = "Thand reing oners whating the blean of ander, thion and shed the wherent esin on that handle."


def plain(s):
    return re.sub(r"\s+", " ", s.lower()).strip()


def test_driver_table_has_all_verbatim_passages(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()}
    got = queries.op1_decontaminate(spark, SF001).collect()
    exact = {(r["doc_id"], r["item_id"]) for r in got if r["edits"] == 0}
    assert exact == {(d, i) for d, t in docs.items() for i, x in items.items() if plain(x) in plain(t)}
    for r in got:
        assert r["edits"] <= r["budget"]
        if r["edits"] == 0:
            assert plain(docs[r["doc_id"]][r["start"]: r["end"]]) == plain(items[r["item_id"]])


def distance(item, text):
    """Fewest edits of the item against any stretch of the text."""
    row = [0] * (len(text) + 1)
    for a in item:
        new = [row[0] + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def edited(rng, s, n):
    s = list(s)
    for _ in range(n):
        i = rng.randrange(len(s))
        what = rng.randrange(3)
        if what == 0:
            s[i] = rng.choice("qxzjv")
        elif what == 1:
            del s[i]
        else:
            s.insert(i, rng.choice("qxzjv"))
    return "".join(s)


def test_edits_up_to_the_budget_are_found():
    rng = random.Random(4)
    index = D.index([(1, ITEM), (2, "Zur " + ITEM[::-1])], D.Q, D.RATE)
    budget = int(index.budget[0])
    for _ in range(300):
        n = rng.randrange(0, 2 * budget + 3)
        text = "And the rest of it. " * rng.randrange(3) + edited(rng, ITEM.upper() if rng.random() < .2 else ITEM, n).replace(" ", rng.choice([" ", "\n ", "  "])) + " the end" * rng.randrange(3)
        best = distance(plain(ITEM), plain(text))
        hits = [h for h in D.hits_in(text, index) if h[0] == 0]
        assert bool(hits) == (best <= budget)
        if hits:
            assert min(h[3] for h in hits) == best


def test_two_occurrences_and_places():
    text = "x " + ITEM + "\n\nmiddle\n" + ITEM.replace(" ", "   ")
    hits = D.hits_in(text, D.index([(9, ITEM)], D.Q, D.RATE))
    assert [plain(text[a:b]) for _, a, b, _, _ in sorted(hits, key=lambda h: h[1])] == [plain(ITEM)] * 2


def test_blocks_nulls_and_empty_tables(spark):
    bench = spark.createDataFrame([(1, ITEM), (1, ITEM), (2, None), (3, ""), (4, "short"), (None, "alpha beta gamma delta epsilon"), (5, ITEM[::-1])],
                                  "item_id long, text string")
    docs = awkward(spark).unionByName(spark.createDataFrame([(50, "so " + ITEM)], "doc_id long, text string"), allowMissingColumns=True)
    for size in (1 << 20, 60):
        got = sorted((r["doc_id"], r["item_id"] or 0) for r in D.contaminated(docs, bench, block_bytes=size).collect())
        assert got == [(1, 0), (2, 0), (2, 0), (50, 1)]
    kept = D.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 3, 4, 5, 6, 7, 8, 9]
    assert D.contaminated(empty(spark), bench).count() == 0
    assert D.contaminated(docs, bench.limit(0)).count() == 0


def test_runs_of_one_character_stay_small():
    import time
    import tracemalloc
    items = D.index([(1, "-" * 300), (2, "the quick brown fox jumps over the lazy dog again and again")], 12, 0.05)
    t = time.time()
    tracemalloc.start()
    text = "-" * 20_000 + " the quick brown fox jumps over the lazy dog again and again " + "-" * 20_000
    got = D.hits_in(text, items)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert time.time() - t < 60 and most < 400 << 20
    runs = [(a, b, e) for i, a, b, e, _ in got if i == 0]
    assert sum(e == 0 for *_, e in runs) >= 2 * (20_000 // 300) - 2
    assert [items.ids[i] for i, *_ in got if i == 1] == [2]


def test_slices_find_the_same_bands(monkeypatch):
    import random
    rng = random.Random(4)
    words = ["".join(rng.choice("abcde ") for _ in range(6)) for _ in range(40)]
    items = [(n, " ".join(rng.choices(words, k=rng.randint(8, 60)))) for n in range(30)]
    text = " ".join(" ".join(rng.choices(words, k=30)) + " " + t[: rng.randint(20, 400)] for _, t in items for _ in range(3))
    points = D.folded(text)[0]
    found = D.index(items, 12, 0.05)
    want = found.bands(points)
    monkeypatch.setattr(D, "_HELD", 50)
    monkeypatch.setattr(D, "_SLICE", 1)
    assert found.bands(points) == want and len(want) > 50
