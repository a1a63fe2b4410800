"""Quality rules: counts of words and symbols, and repetition coverage.

Words are runs without ASCII white space.  Every word and every line gets a
64-bit hash; the hash of an n-gram of words is rolled on from that of the
(n-1)-gram before it.  Equal n-grams of one text lie side by side after sorting,
and neighbours are compared word by word.  Coverage of a length n is the number
of characters (of words) inside n-grams that stand earlier in the same text;
overlapping ones count once.  Lines count in the same way.

A document is kept if it passes the base rules (``LEAST_WORDS`` words, at most
``REPEATED`` % of them in repeated 5-word windows) and the method's verdict: at
most ``SHARES[n]`` % of its word characters in repeated n-grams and at most
``LINE_CHARS`` % in repeated lines.

One scan without a shuffle.  Texts are cut into words piece by piece; what stays
of a text while its n-grams are sorted is some 50 bytes a word, whatever it holds
(one character, one word, one line repeated, or no white space at all).

Defined cases: a null or empty text, or one of white space, has no words and
fails the base rules; null ids and repeated rows are scored like others; further
columns are ignored by ``report`` and kept by ``keep``; an empty table stays empty.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import WHITE, arrow_map, mix64, released, row_chunks, tables, text_batches, texts_of

LEAST_WORDS, REPEATED, WINDOW = 10, 20, 5
#: Most % of a document's word characters inside repeated n-grams of that many words.
SHARES = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
LINE_CHARS = 20
#: Fixed by the contract: the characters that count as symbols.
SYMBOLS = b"#*$%&|<>"

_PIECE, _LONG = 1 << 18, 256
_TABLE = np.random.default_rng(20250711).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(_LONG - 1, _BASE, np.uint64))))
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True
_BREAK = np.zeros(256, dtype=bool)
_BREAK[0x0A] = True


def runs(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs between bytes that ``breaks`` marks; ``data``
    ends with such a byte."""
    starts, ends, before = [], [], True
    for at in range(0, len(data), _PIECE):
        gap = breaks[data[at:at + _PIECE]]
        turn = np.flatnonzero(np.diff(gap, prepend=before)) + at
        opened = ~gap[turn - at]
        starts.append(turn[opened])
        ends.append(turn[~opened])
        before = gap[-1]
    return (np.concatenate(starts), np.concatenate(ends)) if starts else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and number of code points of every run; pieces bound the work arrays."""
    out, points = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.int64)
    sizes = ends - starts
    short = np.flatnonzero(sizes <= _LONG)
    cut = np.searchsorted(np.cumsum(sizes[short]), np.arange(_PIECE, int(sizes[short].sum()) + _PIECE, _PIECE), side="right")
    for a, b in zip(np.concatenate(([0], cut)), np.concatenate((cut, [len(short)]))):
        own = short[a:b]
        if not len(own):
            continue
        n = sizes[own]
        first = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(first, n)
        byte = data[np.repeat(starts[own], n) + place]
        out[own] = np.add.reduceat(_TABLE[byte] * _POWERS[place], first)
        points[own] = np.add.reduceat((byte & 0xC0) != 0x80, first, dtype=np.int64)
    out[short] = mix64(out[short] + sizes[short].astype(np.uint64))
    for i in np.flatnonzero(sizes > _LONG):
        run = data[starts[i]:ends[i]]
        out[i] = int.from_bytes(hashlib.blake2b(run, digest_size=8).digest(), "little")
        points[i] = sum(int(np.count_nonzero((run[a:a + _PIECE] & 0xC0) != 0x80)) for a in range(0, len(run), _PIECE))
    return out, points


def repeated(doc: np.ndarray, hashes: np.ndarray, at: np.ndarray, key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of the n-grams starting at ``at`` (in order, with their rolled
    hashes ``key``) stand twice or more in their text, and which of those stand
    earlier in it."""
    order = np.lexsort((key, doc[at]))
    a, b = at[order[:-1]], at[order[1:]]
    same = (key[order[:-1]] == key[order[1:]]) & (doc[a] == doc[b])
    close = np.flatnonzero(same)
    for j in range(n):
        same[close] &= hashes[a[close] + j] == hashes[b[close] + j]
    twice, later = np.zeros(len(at), bool), np.zeros(len(at), bool)
    later[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return twice | later, later


def covered(at: np.ndarray, n: int, size: int) -> np.ndarray:
    """Marks the words inside n-grams that start at ``at``."""
    mark = np.zeros(size + 1, np.int64)
    np.add.at(mark, at, 1)
    np.add.at(mark, at + n, -1)
    return np.cumsum(mark[:-1]) > 0


def measures(texts: list[bytes], lengths: tuple[int, ...]) -> dict[str, np.ndarray]:
    """The counts of every text: n_words, word_chars, n_symbols, n_lines,
    n_dup_lines, n_repeat_words, dup_line_chars and dup<n>_chars."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    text_ends = np.cumsum(sizes)
    m = len(texts)
    starts, ends = runs(data, WHITE)
    hashes, points = run_hashes(data, starts, ends)
    doc = np.searchsorted(text_ends, starts, side="right")

    def per_text(owner: np.ndarray, values: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(owner, weights=values, minlength=m).astype(np.int64)
    out = {"n_words": per_text(doc), "word_chars": per_text(doc, points)}
    symbols = np.concatenate([np.flatnonzero(_SYMBOL[data[a:a + _PIECE]]) + a for a in range(0, len(data), _PIECE)])
    out["n_symbols"] = per_text(np.searchsorted(text_ends, symbols, side="right"))

    # lines with a word; equal ones are equal byte for byte
    line_starts, line_ends = runs(data, _BREAK)
    first, last = np.searchsorted(starts, line_starts), np.searchsorted(starts, line_ends)
    real = last > first
    line_starts, line_ends, first, last = line_starts[real], line_ends[real], first[real], last[real]
    line_hashes, _ = run_hashes(data, line_starts, line_ends)
    line_doc = doc[first]
    at = np.arange(len(line_starts))
    _, later = repeated(line_doc, line_hashes, at, line_hashes, 1)
    total = np.concatenate(([0], np.cumsum(points)))
    out["n_lines"], out["n_dup_lines"] = per_text(line_doc), per_text(line_doc[later])
    out["dup_line_chars"] = per_text(line_doc[later], (total[last] - total[first])[later])

    # an n-gram can only be repeated where the shorter one that it begins with is
    at, key, done = np.arange(len(hashes)), hashes, 1
    for n in sorted({WINDOW, *lengths}):
        for j in range(done, n):
            at_ok = at + j < len(hashes)
            at, key = at[at_ok], key[at_ok]
            inside = doc[at] == doc[at + j]
            at, key = at[inside], key[inside]
            key = key * _BASE + hashes[at + j]
        done = n
        twice, later = repeated(doc, hashes, at, key, n)
        if n == WINDOW:
            out["n_repeat_words"] = per_text(doc[covered(at[twice], n, len(doc))])
        if n in lengths:
            within = covered(at[later], n, len(doc))
            out[f"dup{n}_chars"] = per_text(doc[within], points[within])
        at, key = at[twice], key[twice]
    return out


def verdicts(m, shares: dict[int, int] = SHARES, line_chars: int = LINE_CHARS, least_words: int = LEAST_WORDS,
             most_repeated: int = REPEATED) -> tuple:
    """(base_failed, kept) of the counts ``m``: columns, or arrays in a task."""
    failed = (m["n_words"] < least_words) | (100 * m["n_repeat_words"] > most_repeated * m["n_words"])
    good = 100 * m["dup_line_chars"] <= line_chars * m["word_chars"]
    for n, most in shares.items():
        good = good & (100 * m[f"dup{n}_chars"] <= most * m["word_chars"])
    return failed, ~failed & good


def report(docs: DataFrame, shares: dict[int, int] = SHARES, **limits) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed and kept."""
    lengths = tuple(sorted(shares))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "dup_line_chars",
             *[f"dup{n}_chars" for n in lengths]]

    def rows(batch, texts):
        return {"doc_id": batch.column("doc_id")} | measures(texts, lengths)
    own = tables(docs, doc_id="doc_id", text="text")
    kind = own.schema["doc_id"].dataType.simpleString()
    got = arrow_map(own, rows, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in names), most=1 << 20)
    failed, kept = verdicts({c: F.col(c) for c in names}, shares, **limits)
    return got.select("doc_id", *names, failed.alias("base_failed"), kept.alias("kept"))


def sql(shares: dict[int, int] = SHARES, line_chars: int = LINE_CHARS, least_words: int = LEAST_WORDS,
        most_repeated: int = REPEATED) -> str:
    """The report in DuckDB SQL: n-grams as joined texts, by grouping."""
    parts = [r"""docs AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
w AS MATERIALIZED (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (
  SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM docs)),
l AS (SELECT r, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM docs),
ll AS (SELECT r, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars, row_number() OVER (PARTITION BY r, line ORDER BY i) AS k
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
lines AS (SELECT r, count(*) AS n_lines, count(*) FILTER (k > 1) AS n_dup_lines, coalesce(sum(chars) FILTER (k > 1), 0) AS dup_line_chars FROM ll GROUP BY r),
words AS (SELECT r, count(*) AS n_words, sum(length(w)) AS word_chars FROM w GROUP BY r)"""]
    for n in sorted({WINDOW, *shares}):
        grams = " || ' ' || ".join(["w", *[f"lead(w, {j}) OVER o" for j in range(1, n)]])
        parts.append(f"""g{n} AS MATERIALIZED (SELECT r, i, row_number() OVER (PARTITION BY r, g ORDER BY i) AS k, count(*) OVER (PARTITION BY r, g) AS c FROM (
  SELECT r, i, {grams} AS g FROM w WINDOW o AS (PARTITION BY r ORDER BY i)) WHERE g IS NOT NULL)""")

    def words_in(n: int, which: str, value: str) -> str:
        return f"""(SELECT w.r, {value} AS x FROM w JOIN (SELECT DISTINCT r, unnest(range(i, i + {n})) AS i FROM g{n} WHERE {which}) USING (r, i) GROUP BY w.r)"""
    joins = [f"LEFT JOIN {words_in(WINDOW, 'c > 1', 'count(*)')} rep ON rep.r = docs.r"]
    joins += [f"LEFT JOIN {words_in(n, 'k > 1', 'sum(length(w))')} d{n} ON d{n}.r = docs.r" for n in shares]

    def count(x: str, name: str) -> str:
        return f"CAST(coalesce({x}, 0) AS BIGINT) AS {name}"
    cols = [count("n_words", "n_words"), count("word_chars", "word_chars"),
            count("length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))", "n_symbols"), count("n_dup_lines", "n_dup_lines"),
            count("rep.x", "n_repeat_words"), count("n_lines", "n_lines"), count("dup_line_chars", "dup_line_chars"),
            *[count(f"d{n}.x", f"dup{n}_chars") for n in sorted(shares)]]
    verdict = " AND ".join([f"100 * dup_line_chars <= {line_chars} * word_chars", *[f"100 * dup{n}_chars <= {m} * word_chars" for n, m in shares.items()]])
    failed = f"(n_words < {least_words} OR 100 * n_repeat_words > {most_repeated} * n_words)"
    return ("WITH " + ",\n".join(parts) + f""",
counts AS (SELECT doc_id, {', '.join(cols)} FROM docs LEFT JOIN words ON words.r = docs.r LEFT JOIN lines ON lines.r = docs.r
  {' '.join(joins)})
SELECT *, {failed} AS base_failed, NOT {failed} AND {verdict} AS kept FROM counts""")


def keep(docs: DataFrame, shares: dict[int, int] = SHARES, **limits) -> DataFrame:
    """The documents that the rules keep, with all their columns; every row is
    judged by itself, so repeated and null ids need no care."""
    lengths = tuple(sorted(shares))
    text_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            texts = texts_of(batch, "text")
            for part in row_chunks([len(x) for x in texts], 1 << 20):
                _, kept = verdicts(measures(texts[part], lengths), shares, **limits)
                yield batch.slice(part.start, part.stop - part.start).filter(pa.array(kept))
    return docs.mapInArrow(released(run), docs.schema)


SQL = sql()
