"""Quality rules against SQL, a plain version, and awkward texts."""

import random
import re
import time
from collections import Counter

import pytest
from helpers import awkward, empty

from cadenza.llm import queries, rules

SF001 = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    """The counts with Python lists and tuples."""
    words = WORD.findall(text)
    m = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text))}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen, later = set(), []
    for x in lines:
        if x in seen:
            later.append(x)
        seen.add(x)
    m |= {"n_lines": len(lines), "n_dup_lines": len(later), "dup_line_chars": sum(len(w) for x in later for w in WORD.findall(x))}
    for n in rules.SHARES:
        grams = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
        counts, first = Counter(grams), {}
        for i, g in enumerate(grams):
            first.setdefault(g, i)
        if n == rules.WINDOW:
            m["n_repeat_words"] = len({j for i, g in enumerate(grams) if counts[g] > 1 for j in range(i, i + n)})
        m[f"dup{n}_chars"] = sum(len(words[j]) for j in {j for i, g in enumerate(grams) if first[g] < i for j in range(i, i + n)})
    return m


def check(texts):
    got = rules.measures([t.encode() for t in texts], tuple(rules.SHARES))
    for i, t in enumerate(texts):
        assert {k: int(v[i]) for k, v in got.items()} == plain(t), t[:80]


def test_equals_sql(spark, duck):
    got = queries.op11_rules(spark, SF001).toPandas().sort_values("doc_id").reset_index(drop=True)
    want = duck.execute(rules.SQL).df().sort_values("doc_id").reset_index(drop=True)
    assert sorted(got) == sorted(want) and (got.astype(str) == want[list(got)].astype(str)).all().all()


@pytest.mark.parametrize("seed", range(6))
def test_random_texts_equal_plain_counts(seed):
    rng = random.Random(seed)
    texts = [rng.choice([" ", "\n"]).join(rng.choice(["a", "b", "ü", "🙂x", "w" * 300, "c#*", " "]) + rng.choice(["", " ", "\n", "\t\x0b\r\n", "\n\n"])
                                          for _ in range(rng.choice([0, 1, 4, 5, 12, 200]))) for _ in range(40)]
    check(texts + ["", " \n ", "\n\n\n", "a", "a\na", "a \na", "x " * 9 + "x"])


def test_pieces_cut_anywhere(monkeypatch):
    monkeypatch.setattr(rules, "_PIECE", 7)
    check(["one two  three\nfour five\n" * 9, "", "longerthanapiece " * 30, "end", "ü" * 50 + "\n" + "ü" * 50])


def test_degenerate_texts_take_linear_time():
    t = time.time()
    for text in ("x" * 4_000_000, "x " * 1_000_000, "\n" * 4_000_000, "same line here\n" * 200_000, "#" * 3_000_000):
        got = rules.measures([text.encode()], tuple(rules.SHARES))
        assert got["word_chars"][0] == len(WORD.sub(lambda m: m.group(), text).translate({10: None, 32: None}))
    assert time.time() - t < 60


def test_awkward_and_empty(spark):
    got = rules.report(awkward(spark)).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert len(got) == 11 and len(by[2]) == 2
    for i in (3, 4, 5):  # null, empty, white space
        assert by[i][0]["n_words"] == 0 and by[i][0]["base_failed"] and not by[i][0]["kept"]
    assert by[1][0]["n_words"] == 8 and by[1][0]["base_failed"]
    assert by[6][0]["n_words"] == 24000 and by[6][0]["n_repeat_words"] == 24000
    assert rules.report(empty(spark)).count() == 0
    kept = rules.keep(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in got if r["kept"]}
    assert rules.keep(empty(spark)).count() == 0


def test_verdict_of_the_method(spark):
    unique = " ".join(f"w{i}" for i in range(100))
    # one line of a quarter of the characters repeated, too little for the base rule at four-word lines
    lines = "\n".join(f"line {i} of text" for i in range(30)) + "\n" + "\n".join("line 3 of text" for _ in range(10))
    docs = spark.createDataFrame([(1, unique), (2, lines), (3, unique + " " + " ".join(f"w{i}" for i in range(10)))], "doc_id long, text string")
    got = {r["doc_id"]: r for r in rules.report(docs).collect()}
    assert got[1]["kept"] and got[3]["kept"]
    assert not got[2]["kept"]
    strict = {r["doc_id"]: r["kept"] for r in rules.report(docs, shares={5: 5}).collect()}
    assert strict == {1: True, 2: False, 3: False}
