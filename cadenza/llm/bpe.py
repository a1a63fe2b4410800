"""BPE encoding and decoding through a table of distinct words.

Spark splits the texts into the tokenizer's words (special tokens are words of
their own).  Documents are dealt into blocks; a block names its distinct words,
the words of all blocks meet by a hash of the word, each distinct word is encoded
once, and the ids go back to the blocks, where every position of a text looks up
its word.  Between the two steps a block's words travel as one compressed packet
for each share of the hash range, in sorted order, so that the answer needs no
words.

Decoding joins ids with the pieces of the vocabulary, a table bounded by the
tokenizer, and puts the bytes together; what is no UTF-8 becomes U+FFFD as in the
tokenizers library.

Defined cases: a null text counts as empty and has no ids; null ids decode to an
empty text, null elements and ids without a piece to nothing; repeated rows are
encoded each; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import mix64, release, released, tables, text_batches

#: The byte-level split pattern (a fixed value of the vocabulary), with Unicode classes.
PATTERN = r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Text bytes of a block: the working set of one task.
BLOCK = 8 << 20
#: Compression level of the packets between the steps: higher ones save little
#: room on sorted words and cost more than the look-up.
PACK = 4


def byte_pieces() -> dict[str, int]:
    """Character of each byte in a byte-level vocabulary: printable ones stand for
    themselves, the others follow from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class vocabulary:
    """What is needed of a tokenizer file, read on the driver and sent to tasks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take in neighbours are not supported")
        if spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("a byte-level tokenizer without prefix space is needed")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte_of = byte_pieces()
        pieces = {i: bytes(byte_of[c] for c in w) for w, i in spec["model"]["vocab"].items()}
        pieces |= {i: t.encode() for t, i in self.special.items()}
        self.pieces = [pieces.get(i, b"") for i in range(max(pieces) + 1)]
        # a word is one unit for the model: no further split, no special tokens
        spec["pre_tokenizer"]["use_regex"] = False
        spec["added_tokens"] = []
        self.model = json.dumps(spec)


def words(text: str | Column, special: list[str]) -> Column:
    """The words of a text in order; a special token is one word."""
    c = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    split = lambda x: F.regexp_extract_all(x, F.lit(PATTERN), F.lit(0))
    if not special:
        return split(c)
    either = F.lit("|".join("\\Q" + t + "\\E" for t in sorted(special, key=len, reverse=True)))
    found = F.regexp_extract_all(c, either, F.lit(0))
    apart = F.flatten(F.transform(F.split(c, either, -1), lambda x, i: F.when(
        i < F.size(found), F.concat(split(x), F.array(F.get(found, i)))).otherwise(split(x))))
    has = F.lit(False)
    for t in special:
        has = has | F.contains(c, F.lit(t))
    return F.when(has, apart).otherwise(split(c))


def packets(distinct: pa.Array, shares: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of a block's distinct words by share and word, and the share of each
    in that order.  Both ends of the exchange compute it alike.  The share is a
    hash of a word's first six bytes, so that words that begin alike stand
    together and the packets compress well."""
    distinct = distinct.cast(pa.large_binary())
    if not len(distinct):
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    at = np.frombuffer(distinct.buffers()[1], np.int64)[distinct.offset: distinct.offset + len(distinct) + 1]
    data = np.frombuffer(distinct.buffers()[2], np.uint8)
    start, end = at[:-1], at[1:]
    key = np.zeros(len(start), dtype=np.uint64)
    for i in range(6):
        key = (key << np.uint64(8)) | np.where(start + i < end, data[np.minimum(start + i, end - 1)], 0).astype(np.uint64)
    share = (mix64(key) % np.uint64(shares)).astype(np.int32)
    order = pc.sort_indices(distinct).to_numpy()
    order = order[np.argsort(share[order], kind="stable")]
    return order, share[order]


def _flat(column: pa.ListArray | pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """Elements of a list column as one array, and where each list ends."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return column.flatten(), np.cumsum(n)


def _decoded(flat: pa.Array, ends: np.ndarray, table: pa.Array) -> pa.Array:
    """Texts of id lists: each id joined with its piece, the last row of
    ``table`` standing for ids without one."""
    at = np.nan_to_num(flat.to_numpy(zero_copy_only=False).astype(np.float64), nan=-1).astype(np.int64)
    at = np.where((at < 0) | (at >= len(table) - 1), len(table) - 1, at)
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), table.take(pa.array(at)))
    whole = pc.binary_join(lists, b"")
    try:
        return whole.cast(pa.string())
    except pa.ArrowInvalid:          # some id list is cut within a character
        return pa.array([b.decode("utf-8", "replace") for b in whole.to_pylist()], pa.string())


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
           block_bytes: int = BLOCK, decoded: bool = False) -> DataFrame:
    """One row per document: doc_id, ids (array<int>); with ``decoded`` also the
    text that the ids decode to, as ``decode`` gives it, from the same task (no
    second Python worker, no way back for the ids)."""
    text_batches(docs.sparkSession)
    vocab = vocabulary(path)
    special, model = vocab.special, vocab.model
    pieces = vocab.pieces if decoded else []
    own = tables(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    # enough shares that the words of one fit a task: they grow with the blocks
    shares = int(max(8, 8 * blocks ** 0.5))
    parts = (own.withColumn("block", F.pmod(F.xxhash64("doc_id", F.crc32(F.col("text").cast("binary"))), F.lit(blocks)).cast("int"))
             .repartition(max(int(blocks), 2), "block")
             .select("block", "doc_id", words("text", list(special)).alias("words")))

    def name(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=PACK)
        seen: dict[int, list[pa.Array]] = {}
        for batch in batches:
            block = batch.column("block").to_numpy(zero_copy_only=False)
            own = np.unique(block)
            for b in own:
                some, _ = _flat((batch if len(own) == 1 else batch.filter(pa.array(block == b))).column("words"))
                seen.setdefault(int(b), []).append(some.unique())
        for b in list(seen):
            distinct = pa.concat_arrays(seen.pop(b)).unique().drop_null()
            order, share = packets(distinct, shares)
            cut = np.searchsorted(share, np.arange(shares + 1))
            for s in np.flatnonzero(np.diff(cut)):
                some = distinct.take(pa.array(order[cut[s]: cut[s + 1]])).cast(pa.binary()).to_pylist()
                sizes = np.array([len(some), *map(len, some)], "<u4")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s], pa.int32()), pa.array([b], pa.int32()),
                     pa.array([pack.compress(sizes.tobytes() + b"".join(some))], pa.binary())],
                    names=["share", "block", "packet"])

    def look_up(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        import zstandard
        from tokenizers import Tokenizer

        pack, unpack = zstandard.ZstdCompressor(level=PACK), zstandard.ZstdDecompressor()
        tokenizer, known = Tokenizer.from_str(model), {t: np.array([i], "<u4").tobytes() for t, i in special.items()}
        for batch in batches:
            blobs = []
            for blob in batch.column("packet").to_pylist():
                blob = unpack.decompress(blob)
                size = int(np.frombuffer(blob, "<u4", 1)[0])
                ends = np.cumsum(np.frombuffer(blob, "<u4", size, 4)) + 4 * (size + 1)
                some = [blob[a:b].decode() for a, b in zip([4 * (size + 1), *ends], ends)]
                fresh = [w for w in some if w not in known]
                for i in range(0, len(fresh), 1000):
                    got = tokenizer.encode_batch_fast(fresh[i:i + 1000], add_special_tokens=False)
                    known.update(zip(fresh[i:i + 1000], (np.array(e.ids, "<u4").tobytes() for e in got), strict=True))
                ids = [known[w] for w in some]
                sizes = np.fromiter((len(i) // 4 for i in ids), "<u4", len(ids))
                blobs.append(pack.compress(sizes.tobytes() + b"".join(ids)))
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("share"), pa.array(blobs, pa.binary())],
                                             names=["block", "share", "answer"])

    answers = (parts.mapInArrow(released(name), "share int, block int, packet binary").repartition(shares, "share")
               .mapInArrow(released(look_up), "block int, share int, answer binary"))

    def place(left: pa.Table, right: pa.Table) -> pa.Table:
        import zstandard

        unpack, table = zstandard.ZstdDecompressor(), pa.array([*pieces, b""], pa.binary())
        # every word is hashed once: its number among the block's words
        code = pc.list_flatten(left.column("words")).combine_chunks().dictionary_encode()
        if isinstance(code, pa.ChunkedArray):
            code = code.combine_chunks()
        distinct, code = code.dictionary, code.indices.to_numpy(zero_copy_only=False)
        order, share = packets(distinct, shares)
        n_of = np.bincount(share, minlength=shares)
        sizes, ids = [np.zeros(0, "<u4")], [np.zeros(0, "<u4")]
        for s, blob in sorted(zip(right.column("share").to_pylist(), right.column("answer").to_pylist(), strict=True)):
            got = np.frombuffer(unpack.decompress(blob), "<u4")
            sizes.append(got[: n_of[s]])
            ids.append(got[n_of[s]:])
        sizes, ids = np.concatenate(sizes).astype(np.int64), np.concatenate(ids).astype(np.int32)
        n, first = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        n[order], first[order] = sizes, np.cumsum(sizes) - sizes
        out, start = [], 0
        for batch in left.to_batches():  # some documents at a time
            _, ends = _flat(batch.column("words"))
            word = code[start: start + (ends[-1] if len(ends) else 0)]
            start += len(word)
            total = np.append(0, np.cumsum(n[word]))
            all_ids = ids[np.repeat(first[word] - total[:-1], n[word]) + np.arange(total[-1])]
            at, all_ids = total[np.append(0, ends)], pa.array(all_ids)
            row = {"doc_id": batch.column("doc_id"), "ids": pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), all_ids)}
            out.append(pa.table(row | ({"decoded": _decoded(all_ids, at[1:], table)} if decoded else {})))
        release()
        return pa.concat_tables(out)

    return parts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        place, "doc_id long, ids array<int>" + ", decoded string" * decoded)


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids in a further column."""
    pieces = vocabulary(path).pieces
    schema = encoded.schema
    out = [f for f in schema.fields if f.name != text_col]

    def run(batches):
        table = pa.array([*pieces, b""], pa.binary())
        for batch in batches:
            # some rows at a time: a piece takes more room than its id
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                yield pa.RecordBatch.from_arrays([part.column(f.name) for f in out] + [_decoded(*_flat(part.column(ids_col)), table)],
                                                 names=[f.name for f in out] + [text_col])

    from pyspark.sql import types as T
    return encoded.select(*[F.col(f"`{f.name}`") for f in out]).mapInArrow(
        released(run), T.StructType([*out, T.StructField(text_col, T.StringType())]))


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    both = encode(docs, path, id_col, text_col, decoded=True)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
