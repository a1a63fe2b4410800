"""Benchmark decontamination by the q-gram lemma and banded alignment.

Text and items are compared as code points, letters in lower case and white
space runs as one space.  An item of ``m`` characters found with at most ``k``
edits shares at least ``m - q + 1 - k q`` of its q-grams with the text on
neighbouring diagonals (text position minus item position).  So the shared
q-grams of a document are counted by item and by diagonal band, bands of ``2 (k
+ 1)`` diagonals that overlap by half; only bands that reach the bound are
verified, by an alignment of the whole item restricted to the band.

The benchmark is the query set: it is taken in blocks of about ``BLOCK`` bytes,
and each block runs against all documents.  A block is all that is broadcast.

Defined cases: a null or empty text has no hit; null, empty and repeated items
count once per item_id and those shorter than ``q`` characters are not looked for
(they cannot be told from chance); a null item_id is an id like others; repeated
documents are reported each; an empty benchmark gives no rows; further columns
are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import anti, arrow_map, byte_hashes, mix64, saved, tables

Q, RATE, BLOCK = 12, 0.05, 4 << 20
_FILTER = 1 << 22
#: Pairs of equal q-grams laid out at a time, and the least text positions of a slice.
_HELD, _SLICE = 1 << 21, 1 << 12

_FOLD = np.arange(0x3000, dtype=np.uint32)
for _c in range(0x3000):
    if len(chr(_c).lower()) == 1:
        _FOLD[_c] = ord(chr(_c).lower())
    if chr(_c).isspace():
        _FOLD[_c] = 32


def folded(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Compared code points and their places in the text."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    points = np.where(raw < len(_FOLD), _FOLD[np.minimum(raw, len(_FOLD) - 1)], raw)
    blank = points == 32
    keep = ~(blank & np.concatenate(([True], blank[:-1])))
    if len(keep) and blank[-1]:
        keep[np.flatnonzero(keep)[-1:]] &= ~blank[np.flatnonzero(keep)[-1:]]
    place = np.flatnonzero(keep)
    return points[place], place


def _grams(points: np.ndarray, q: int) -> np.ndarray:
    if len(points) < q:
        return np.zeros(0, dtype=np.uint64)
    at = np.arange(len(points) - q + 1)
    return byte_hashes(points, mix64(points.astype(np.uint64) + np.uint64(1))).spans(at, at + q)


class index:
    """The q-grams of a block of items: hash -> (item, position)."""

    def __init__(self, items: list[tuple[int | None, str]], q: int, rate: float):
        self.q = q
        kept = [(i, p) for i, p in ((i, folded(t or "")[0]) for i, t in items) if len(p) >= q]
        self.ids = [i for i, _ in kept]
        self.points = [p for _, p in kept]
        size = np.array([len(p) for p in self.points], dtype=np.int64)
        # the bound stays positive: at least one q-gram must be shared
        self.budget = np.minimum((size * rate).astype(np.int64), np.maximum(size - q, 0) // q)
        self.least = size - q + 1 - self.budget * q
        hashes = [_grams(p, q) for p in self.points]
        flat = np.concatenate([*hashes, np.zeros(0, np.uint64)])
        item = np.repeat(np.arange(len(kept)), [len(h) for h in hashes])
        pos = np.concatenate([*[np.arange(len(h)) for h in hashes], np.zeros(0, np.int64)]).astype(np.int64)
        order = np.argsort(flat, kind="stable")
        self.item, self.pos = item[order], pos[order]
        self.keys, self.first, self.count = np.unique(flat[order], return_index=True, return_counts=True)
        self.filter = np.zeros(_FILTER, dtype=bool)
        self.filter[(self.keys % np.uint64(_FILTER)).astype(np.int64)] = True

    def bands(self, points: np.ndarray) -> list[tuple[int, int]]:
        """(item, lowest diagonal) of every band that reaches the bound."""
        if not len(self.keys) or len(points) < self.q:
            return []
        h = _grams(points, self.q)
        at = np.flatnonzero(self.filter[(h & np.uint64(_FILTER - 1)).astype(np.int64)])
        found = np.searchsorted(self.keys, h[at])
        found[found == len(self.keys)] = 0
        same = self.keys[found] == h[at]
        at, found = at[same], found[same]
        total = int(self.count[found].sum())
        if total < self.least.min():
            return []
        # a band's q-grams stand in a stretch of an item's length: slices of the
        # text that overlap by it count one range of diagonals each
        wide, long = int(self.budget.max()) + 1, max(len(p) for p in self.points)
        first, beyond = -long - 2 * wide, len(points) + 1
        step = beyond - first if total <= _HELD else max(_SLICE, long + 2 * wide)
        out = []
        for s in range(first, beyond, step):
            a, b = np.searchsorted(at, [s, s + step + long + 2 * wide])
            out += self._bands(at[a:b], found[a:b], s, s + step, long)
        return sorted(out)

    def _bands(self, at: np.ndarray, found: np.ndarray, low: int, high: int, long: int) -> list[tuple[int, int]]:
        """Bands that reach the bound, their lowest diagonal in ``low:high``."""
        base = min(low, 0)
        span = max(high, 0) - base + 2
        n = self.count[found]
        keys = np.zeros(0, dtype=np.int64)
        cuts = np.searchsorted(np.cumsum(n), np.arange(_HELD, int(n.sum()) + _HELD, _HELD), side="right")
        for a, b in zip([0, *cuts], [*cuts, len(n)]):
            if a >= b:
                continue
            part, m = found[a:b], n[a:b]
            entry = np.repeat(self.first[part], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            item, pos = self.item[entry], self.pos[entry]
            width = self.budget[item] + 1
            band = (np.repeat(at[a:b], m) - pos) // width
            new = [keys]
            # each diagonal lies in two bands; an item's q-gram counts once in a band
            for own in (band, band - 1):
                inside = (own * width >= low) & (own * width < high)
                new.append((item[inside] * span + own[inside] - base) * long + pos[inside])
            keys = np.unique(np.concatenate(new))
        groups, shared = np.unique(keys // long, return_counts=True)
        item = groups // span
        reach = shared >= self.least[item]
        return [(int(i), int(g % span + base) * int(self.budget[i] + 1)) for i, g in zip(item[reach], groups[reach])]

    def aligned(self, points: np.ndarray, i: int, low: int) -> tuple[int, int, int]:
        """Fewest edits of item ``i`` against any stretch of the text whose path
        stays within the band and its budget, with the stretch's start and end."""
        item, k = self.points[i], int(self.budget[i])
        first, width = low - k, 2 * (k + 1) + 2 * k
        # a cell holds edits * 2**32 + start; column c is diagonal first + c
        one = np.int64(1) << np.int64(32)
        column = np.arange(width, dtype=np.int64)
        start = np.clip(first + column, 0, len(points))
        row = np.where((first + column >= 0) & (first + column <= len(points)), start, one * 10**6)
        step = column * one
        padded = np.full(len(item) + width + 1, 0xFFFFFFFF, dtype=np.uint32)
        a, b = max(first, 0), min(first + len(item) + width, len(points))
        if b > a:
            padded[a - first: b - first] = points[a:b]
        inside = len(points) - first
        for j in range(len(item)):
            new = row + one * (padded[j: j + width] != item[j])
            new[:-1] = np.minimum(new[:-1], row[1:] + one)
            row = np.minimum.accumulate(new - step) + step
            row[max(inside - j, 0):] = one * 10**6  # beyond the end of the text
        best = int(np.argmin(row))
        return int(row[best] >> 32), int(row[best] & 0xFFFFFFFF), first + best + len(item)


def hits_in(text: str, items: index) -> list[tuple[int, int, int, int, int]]:
    """(item, start, end, edits, budget) of the occurrences in one text, the best
    of those of an item that overlap."""
    points, place = folded(text)
    found: dict[int, list[tuple[int, int, int]]] = {}
    exact: dict[int, tuple[int, int]] = {}      # the last occurrence of an item without edits
    for i, low in items.bands(points):
        k, (a, b) = int(items.budget[i]), exact.get(i, (-1, -1))
        if a < low - k and low + 3 * k + 2 <= b:
            continue    # all that this band can hold starts inside that occurrence
        edits, start, end = items.aligned(points, i, low)
        if edits <= items.budget[i] and end > start:
            end = min(end, len(points))
            found.setdefault(i, []).append((edits, start, end))
            if edits == 0 and start >= b:
                exact[i] = (start, end)
    out = []
    for i, spans in sorted(found.items()):
        taken: list[tuple[int, int]] = []
        for edits, start, end in sorted(spans):
            if all(end <= a or start >= b for a, b in taken):
                taken.append((start, end))
                out.append((i, int(place[start]), int(place[end - 1]) + 1, edits, int(items.budget[i])))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = RATE, id_col: str = "doc_id",
                 text_col: str = "text", block_bytes: int = BLOCK) -> DataFrame:
    """One row per occurrence: doc_id, item_id, start, end (code points of the
    original text), edits, budget."""
    own = tables(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    items = (tables(benchmark, item_id="item_id", text="text").withColumn("item_id", F.col("item_id").cast("long"))
             .filter("text is not null and text != ''").distinct())
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    out = None
    for n in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == n).orderBy("item_id", "text").collect()
        texts = [(r["item_id"], r["text"]) for r in part]

        # the index is built once a Python worker, from the block's texts
        def rows(batch, data, texts=texts, held={}):  # noqa: B006
            if "index" not in held:
                held["index"] = index(texts, q, rate)
            ids = batch.column("doc_id").to_pylist()
            found = [(ids[d], held["index"].ids[i], *rest) for d, t in enumerate(data)
                     for i, *rest in hits_in(t.decode("utf-8", "replace"), held["index"])]
            if not found:
                return None
            return dict(zip(("doc_id", "item_id", "start", "end", "edits", "budget"), map(list, zip(*found)), strict=True))
        got = arrow_map(own, rows, "doc_id long, item_id long, start int, end int, edits int, budget int", most=8 << 20)
        out = got if out is None else out.unionByName(got)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without an occurrence, with all their columns."""
    gone = saved(contaminated(docs, benchmark, id_col=id_col, text_col=text_col).select("doc_id").distinct(), "leaks")
    return anti(docs, gone.select(F.col("doc_id").alias(id_col)), id_col).select(*[F.col(f"`{c}`") for c in docs.columns])
