"""Secret scan: fixed patterns, and strings that a primed compressor cannot shorten.

The base kinds are patterns: ``assign`` (a value assigned to a sensitive name),
``access`` (access key ids) and ``hex`` (long runs of hex digits).  The ``novel``
kind takes every long run of identifier-like characters with letters and digits
in a sensitive context (a telling word before it on its line) and measures its
novelty: the bytes that it adds to the zstandard size of its surroundings, with
a dictionary of common identifiers.  A random string adds nearly its entropy; a
name made of known parts adds far less.  Strings that add at least ``NOVEL`` of
what a random string over the same characters would are reported, unless a base
span contains them.

Defined cases: a null or empty text has no findings; texts are scanned whole;
repeated rows are reported each; further columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import arrow_map, joined, tables

KINDS = ("assign", "access", "hex", "novel")
NOVEL, LEAST, AROUND = 0.8, 16, 256

# FIXED VALUES: the base patterns and their least lengths
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
SENSITIVE = re.compile(rb"pass(?:word|wd|phrase)?|pwd|secret|token|key|auth|bearer|credential|private|signature|session|cookie|salt|api", re.I)
# FIXED VALUES: words of identifiers and configuration that are no secrets
IDENTIFIERS = """
access account action address algorithm api application array async authorization backend base64 bearer bool boolean
bucket buffer bytes cache callback certificate channel char class client cluster code column commit config connection
const container content context cookie count create credential data database date debug default define delete
dependency deploy description development device directory document domain email enable encoding endpoint engine
environment error event example execute export false field file filter float format function gateway github global
group handler hash header host http https identifier image import index input instance integer interface internal item
java javascript json key kubernetes label language library license list local localhost location logger login main
manager map message method metric model module mongo mysql name namespace network node null number object offset
option order origin output package page parameter parent password path pattern payload pipeline placeholder plugin
pointer policy port postgres prefix private process production profile project property protocol provider proxy public
python query queue read record redirect redis region register release remote render request resource response result
return root route schema scope script search secret section security select sequence server service session setting
signature size socket source spark stage start state static status storage stream string struct system table target
task template tenant test thread time timeout token total trace transaction true type undefined update upload user
username uuid value variable vendor version view void window worker workflow write xml yaml 0123456789 2020 2021 2022
2023 2024 2025 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ
"""

_HEX = np.zeros(256, dtype=bool)
_HEX[list(b"0123456789abcdef")] = True
_RUN = np.zeros(256, dtype=bool)
_RUN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
#: hints that an assignment may stand in a text, in lower case
_NAMES = (b"password", b"passwd", b"secret", b"token", b"api")


def runs(mask: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of at least ``least`` true places."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8)))
    start, end = edges[::2], edges[1::2]
    long = end - start >= least
    return start[long], end[long]


def alphabet(value: bytes) -> int:
    """Size of the smallest usual alphabet that has all of the value's characters."""
    for chars, size in ((rb"[0-9a-f]+", 16), (rb"[0-9A-F]+", 16), (rb"[0-9a-z]+", 36), (rb"[0-9A-Z]+", 36), (rb"[0-9A-Za-z]+", 62)):
        if re.fullmatch(chars, value):
            return size
    return 64


class novelty:
    """Marginal compressed size against the surroundings and the identifiers."""

    def __init__(self):
        import zstandard

        dictionary = zstandard.ZstdCompressionDict(IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.zstd = zstandard.ZstdCompressor(level=6, dict_data=dictionary, write_content_size=False,
                                             write_checksum=False, write_dict_id=False)

    def share(self, text: bytes, start: int, end: int) -> float:
        """Bytes that ``text[start:end]`` adds, over those of a random string."""
        before, value, after = text[max(0, start - AROUND): start], text[start:end], text[end: end + AROUND]
        added = len(self.zstd.compress(before + value + after)) - len(self.zstd.compress(before + after))
        return added * 8 / (len(value) * np.log2(alphabet(value)))


def spans_in(texts: list[bytes], measure: novelty) -> list[list[tuple[int, int, str, float | None]]]:
    """(start, end, kind, novelty) in code points, by start and then kind."""
    out: list[list] = [[] for _ in texts]
    for d, t in enumerate(texts):
        low = t.lower()
        if any(n in low for n in _NAMES):
            out[d] += [(*m.span(), "assign", None) for m in ASSIGN.finditer(t) if len(m[2]) >= LEAST_ASSIGN]
        if b"AKIA" in t:
            out[d] += [(*m.span(), "access", None) for m in ACCESS.finditer(t) if len(m[0]) >= LEAST_ACCESS]
    data, first = joined(texts)
    for a, b in zip(*runs(_HEX[data], LEAST_HEX), strict=True):
        d = int(np.searchsorted(first, a, side="right")) - 1
        out[d].append((int(a - first[d]), int(b - first[d]), "hex", None))
    start, end = runs(_RUN[data], LEAST)
    digits = np.append(0, np.cumsum(_DIGIT[data], dtype=np.int64))
    mixed = (digits[end] > digits[start]) & (digits[end] - digits[start] < end - start)
    at = -1
    for a, b in zip(start[mixed], end[mixed], strict=True):
        d = int(np.searchsorted(first, a, side="right")) - 1
        a, b, t = int(a - first[d]), int(b - first[d]), texts[d]
        if d != at:
            at, words = d, [m.span() for m in SENSITIVE.finditer(t)]
            word_starts, word_ends = [x for x, _ in words], [y for _, y in words]
            breaks = [-1, *(m.start() for m in re.finditer(rb"\n", t))]
            base = sorted(x[:2] for x in out[d])
            base_starts, reach = [x for x, _ in base], list(accumulate((y for _, y in base), max))
        # the last word that ends before the candidate, if it is on its line
        told = bisect_right(word_ends, a) - 1
        before = bisect_right(base_starts, a)     # a base span among these that reaches b contains the candidate
        if told >= 0 and word_starts[told] > breaks[bisect_right(breaks, a) - 1] and not (before and reach[before - 1] >= b):
            share = measure.share(t, a, b)
            if share >= NOVEL:
                out[d].append((a, b, "novel", float(share)))
    for d, found in enumerate(out):
        if found:
            t = texts[d]
            places = sorted({p for x in found for p in x[:2]})
            at, points, last = {}, 0, 0
            for p in places:
                points += len(t[last:p].decode("utf-8", "replace"))
                at[p], last = points, p
            out[d] = sorted(((at[a], at[b], kind, n) for a, b, kind, n in found), key=lambda x: (x[0], KINDS.index(x[2]), x[1]))
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, spans (array of start, end, kind, novelty)."""
    def rows(batch, texts, held={}):  # noqa: B006
        if "novelty" not in held:
            held["novelty"] = novelty()
        found = spans_in(texts, held["novelty"])
        return {"doc_id": batch.column("doc_id"),
                "spans": pa.array([[dict(zip(("start", "end", "kind", "novelty"), x, strict=True)) for x in f] for f in found],
                                  pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("novelty", pa.float64())])))}
    own = tables(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return arrow_map(own, rows, "doc_id long, spans array<struct<start:int,end:int,kind:string,novelty:double>>")


def joined_spans(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and digests of the findings of each document."""
    found = scan(docs, id_col, text_col)
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[of(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(joined_spans(F.filter("spans", lambda s: s["kind"] != "novel")), 256).alias("base_sha256"),
        joined_spans(F.col("spans")).alias("spans"))
