"""Held-out accuracy of the trained classifiers, and their awkward inputs."""

import zlib

import numpy as np
import pytest
from helpers import awkward, empty

from cadenza.llm import common, quality, queries, toxicity

SF01 = "/root/testdata/sf0.01"


def accuracy(spark, got, label):
    truth = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    own = [(r["predicted"], truth[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in truth]
    return np.mean([a == b for a, b in own]), len(own)


@pytest.mark.parametrize(("query", "label", "folds", "fold", "least"),
                         [(queries.op4_quality, "quality", 3, 1, 0.95), (queries.op7_toxicity, "toxic", 5, 0, 0.9)])
def test_held_out(spark, query, label, folds, fold, least):
    got = query(spark, SF01).collect()
    assert len(got) == 1000
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == fold)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    share, n = accuracy(spark, got, label)
    assert n > 50 and share >= least


@pytest.mark.parametrize("op", [quality, toxicity])
def test_awkward_rows_and_missing_classes(spark, op):
    docs = awkward(spark)
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (2, 0, 1), (8, 0, 1), (9, 0, 1), (6, 1, 0), (7, None, None), (None, 1, 1), (4, 0, 0)],
                                   "doc_id long, quality int, toxic int")

    def scores(labels):
        if op is quality:
            return quality.score(docs, *quality.train(docs, labels))
        return toxicity.score(docs, toxicity.train(docs, labels))
    got = scores(labels).collect()
    assert len(got) == 11 and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in got if r["doc_id"] in (3, 4)}.__len__() == 1  # null counts as empty
    one = scores(labels.filter("doc_id = 1")).collect()
    assert len({r["score"] for r in one}) == 1
    none = scores(labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    if op is quality:
        assert quality.score(empty(spark), *quality.train(empty(spark), labels)).count() == 0
        assert quality.keep_good(docs, *quality.train(docs, labels)).columns == docs.columns
    else:
        assert toxicity.score(empty(spark), toxicity.train(empty(spark), labels)).count() == 0


def test_context_sums_equal_a_plain_count(spark):
    docs = awkward(spark).filter("doc_id in (1, 8, 9)")
    places, signs = quality.index_vectors()
    want = {}
    for r in docs.collect():
        words, _ = quality.words_of([r["text"].encode()])
        for i, w in enumerate(words):
            n, v = want.setdefault(int(w), [0, np.zeros(quality.DIMS)])
            want[int(w)][0] += 1
            for j in range(max(0, i - quality.WINDOW), min(len(words), i + quality.WINDOW + 1)):
                if j != i:
                    v[places[words[j]]] += signs
    got = {r["bucket"]: r for r in quality.context_sums(docs).collect()}
    assert set(got) == set(want)
    for b, (n, v) in want.items():
        assert got[b]["n"] == n and [got[b][f"c{i}"] for i in range(quality.DIMS)] == list(v)


def test_n_grams_equal_a_plain_set():
    texts = ["The  Quick\tbrown", "", "ab", "x" * 50, "\n\nthe quick"]
    doc, bucket = toxicity.n_grams([t.encode() for t in texts])
    for d, t in enumerate(texts):
        flat = b" ".join(t.lower().encode().split())
        if t[:1].isspace():
            flat = b" " + flat
        flat = flat + b" "
        grams = {flat[i:i + n] for n in toxicity.SIZES for i in range(len(flat) - n + 1)}
        assert len(set(bucket[doc == d])) == len(grams)


def test_temperature_calibrates():
    rng = np.random.default_rng(1)
    z = rng.normal(0, 2, 4000)
    y = (rng.random(4000) < common.sigmoid(z)).astype(float)
    assert 2.3 < common.temperature(3 * z, y, np.ones(4000)) < 3.9


def test_training_rows_are_bounded_whatever_repeats(spark):
    from cadenza.llm.common import training_rows
    docs = spark.range(3000).selectExpr("id % 40 as doc_id", "concat('text ', id) as text").unionByName(
        spark.range(500).selectExpr("3L as doc_id", "'same' as text"))
    labels = spark.range(40).selectExpr("id as doc_id", "cast(id % 2 as int) as quality")
    rows, weights = training_rows(docs, labels, "quality", 3, 1, 10)
    got = rows.collect()
    assert 0 < len(got) <= 20 and len({(r["doc_id"], r["text"]) for r in got}) == len(got)
    assert sorted(map(str, training_rows(docs.repartition(9), labels, "quality", 3, 1, 10)[0].collect())) == sorted(map(str, got))
    assert set(weights) == {0, 1}


def test_word_vectors_lie_as_pooling_reads_them(spark):
    """Vectors come with the numbers of a dimension together, and neither pooling
    nor the context sums differ from word-by-word versions."""
    from cadenza.llm import quality
    texts = ["a quick brown fox, a quick brown dog 12", "", "one", "to be or not to be or not to be"] * 3
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    vectors = quality.word_vectors(docs)
    assert vectors.flags.f_contiguous and not vectors.flags.c_contiguous
    got = quality.pooled([t.encode() for t in texts], vectors)
    places, signs = quality.index_vectors()
    sums = {}
    for i, t in enumerate(texts):
        bucket, _ = quality.words_of([t.encode()])
        rows = vectors[bucket].astype(float)
        mean = rows.mean(0) if len(rows) else np.zeros(vectors.shape[1])
        assert np.allclose(got[i, :vectors.shape[1]], mean, atol=1e-6)
        like = (rows[1:, quality.DIMS:] * rows[:-1, quality.DIMS:]).sum() / max(len(rows), 1)
        assert abs(got[i, -3] - like) < 1e-6
        for a in range(len(bucket)):
            own = sums.setdefault(int(bucket[a]), np.zeros(quality.DIMS))
            for b in range(max(0, a - quality.WINDOW), min(len(bucket), a + quality.WINDOW + 1)):
                if b != a:
                    own[places[bucket[b]]] += signs
    for r in quality.context_sums(docs).collect():
        assert [r[f"c{i}"] for i in range(quality.DIMS)] == sums[r["bucket"]].astype(int).tolist()
