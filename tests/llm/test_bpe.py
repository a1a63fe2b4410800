"""Token ids against the tokenizers library, and the round trip."""

import hashlib

from helpers import awkward, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cadenza.llm import bpe, queries

PATH = queries.tokenizer_path()
SF001 = "/root/testdata/sf0.001"


def expected(text):
    t = Tokenizer.from_file(PATH)
    ids = t.encode(text or "", add_special_tokens=False).ids
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(",".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))


def test_driver_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op2_bpe(spark, SF001).collect()}
    assert got == {r["doc_id"]: expected(r["text"]) for r in docs.collect()}


def test_many_blocks_and_awkward_rows(spark):
    docs = awkward(spark)
    got = sorted((r["doc_id"] or 0, len(r["ids"])) for r in bpe.encode(docs, PATH, block_bytes=2000).collect())
    assert got == sorted((r["doc_id"] or 0, expected(r["text"])[0]) for r in docs.collect())
    texts = {r["doc_id"]: r["decoded"] for r in bpe.decode(bpe.encode(docs, PATH), PATH).collect()}
    assert texts == {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    both = {r["doc_id"]: r["decoded"] for r in bpe.encode(docs, PATH, decoded=True).collect()}
    assert both == texts


def test_empty(spark):
    assert bpe.digests(empty(spark), PATH).count() == 0


def test_decode_of_odd_ids(spark):
    ids = spark.createDataFrame([(1, None), (2, []), (3, [50256, None, 999999, -1, 72])], "doc_id long, ids array<int>")
    got = {r["doc_id"]: r["decoded"] for r in bpe.decode(ids, PATH).collect()}
    assert got == {1: "", 2: "", 3: "<|endoftext|>i"}
    broken = Tokenizer.from_file(PATH).encode("🙂").ids[:1]
    one = spark.createDataFrame([(1, broken)], "doc_id long, ids array<int>")
    assert bpe.decode(one, PATH).first()["decoded"] == Tokenizer.from_file(PATH).decode(broken)


def test_every_code_point_splits_alike(spark):
    """Each character between letters, digits, marks and white space."""
    points = [i for i in range(1, 0x110000) if not 0xD800 <= i < 0xE000]
    texts = ["".join(f"a{chr(p)}1{chr(p)} {chr(p)}{chr(p)}. {chr(p)}\n" for p in points[i:i + 512]) for i in range(0, len(points), 512)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    got = {r["doc_id"]: r["ids"] for r in bpe.encode(docs, PATH).collect()}
    t = Tokenizer.from_file(PATH)
    bad = [i for i, e in enumerate(t.encode_batch(texts, add_special_tokens=False)) if got[i] != e.ids]
    assert not bad


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab'sS tT<|>endoftext 1²Ⅷ\n\t\r\u0085 ​　é́🙂\x00\x1c"), max_size=60), min_size=1, max_size=40))
def test_random_texts(spark, texts):
    texts = [*texts, *(t + "<|endoftext|>" + t for t in texts)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["ids"] for r in bpe.encode(docs, PATH).collect()}
    t = Tokenizer.from_file(PATH)
    assert got == {i: t.encode(x, add_special_tokens=False).ids for i, x in enumerate(texts)}


def test_valid_texts_are_not_decoded_one_by_one(monkeypatch):
    """Whole texts stay in Arrow; only id lists that cut a character go the long way."""
    import numpy as np
    import pyarrow as pa
    table = pa.array([b"ab", "é".encode(), "é".encode()[:1], b""], pa.binary())

    def got(ids):
        flat, ends = bpe._flat(pa.array(ids, pa.list_(pa.int32())))
        return bpe._decoded(flat, np.asarray(ends), table).to_pylist()
    assert got([[0, 1], [2], None, [0, 9]]) == ["abé", "�", "", "ab"]

    class Whole:
        def __init__(self, whole):
            self.cast = whole.cast
    join = bpe.pc.binary_join
    monkeypatch.setattr(bpe.pc, "binary_join", lambda *a: Whole(join(*a)))      # no to_pylist
    assert got([[0, 1], [], [1, 1]]) == ["abé", "", "éé"]
