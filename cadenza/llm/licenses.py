"""Licence scan: a trained paragraph classifier, confirmed by templates.

A paragraph (a line that is not blank) is scored by a multinomial logistic
regression on hashed word n-grams (one to three words; A-Z in lower case): one
class a licence family and the class *unknown*.  Its logits are divided by a
temperature fitted on rows kept back from training, so the probability of
*unknown* can be relied on.  A family is reported when it is likelier than
``CHANCE`` and one of its templates agrees: the template's distinct word n-grams
found in the paragraph reach ``AGREE`` of the smaller of both sets.  A paragraph
of more than ``WINDOWS[0]`` words that is not reported as a whole, or of more than
``WINDOWS[-1]``, is scored again in overlapping windows of words, so that a
statement is found in a line of any length; of the windows that pass, the one
with the most n-grams of a template is reported for each family.

Training rows are the templates with words dropped, added around or cut to a
part, and, as *unknown*, lines of a bounded sample of documents that share no
three words in a row with a template, and shuffled template words.

Defined cases: a null or empty text has no paragraph; repeated paragraphs and
rows are reported each; texts are scanned whole; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import adam, arrow_map, byte_hashes, joined, lowest, mix64, tables

BUCKETS, SAMPLE, CHANCE, AGREE = 1 << 16, 400, 0.7, 0.6
#: Words of the windows over long paragraphs.  They start a quarter apart, so a
#: statement of up to three quarters of a window lies within one.
WINDOWS = (12, 24, 48, 64)

# FIXED VALUES: statements by which licences are granted or named
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.", 'Licensed under the Apache License, Version 2.0 (the "License");',
        "you may not use this file except in compliance with the License.", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0", "Released under the Apache License 2.0.",
        "See the License for the specific language governing permissions and limitations under the License."),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-2.0-only", "Released under the GNU General Public License.", "Licensed under the GNU GPL v3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "You should have received a copy of the GNU General Public License along with this program."),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.", "SPDX-License-Identifier: LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "Released under the GNU Lesser General Public License."),
    "BSD": (
        "Released under the BSD License.", "Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause", "SPDX-License-Identifier: BSD-2-Clause",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0", "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "ISC": (
        "Licensed under the ISC License.", "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    "CC-BY": (
        "Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "SPDX-License-Identifier: CC-BY-4.0",
        "Licensed under CC BY-SA 4.0.", "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0", "Licensed under CC BY-NC-SA 4.0.", "Licensed under CC BY-NC-ND 4.0."),
    "Public domain": (
        "This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense", "Dedicated to the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "SPDX-License-Identifier: CC0-1.0"),
}
FAMILIES = (*TEMPLATES, "unknown")

_WORD = np.zeros(256, dtype=bool)
_WORD[list(range(48, 58)) + list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_C = np.random.default_rng(11).integers(1, 2**63, 3, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def paragraphs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, int, np.ndarray, np.ndarray, np.ndarray]:
    """Hash and paragraph of every word n-gram (single words first) and the number
    of words; text, start and end (bytes of the text) of every paragraph that has
    a word."""
    data, first = joined(texts)
    data = _LOWER[data]
    breaks = (data == 10) | (data == 13)
    breaks[first[1:] - 1] = True
    edges = np.flatnonzero(np.diff(np.concatenate(([False], _WORD[data], [False])).astype(np.int8)))
    start, end = edges[::2], edges[1::2]
    line = np.cumsum(breaks)[start]
    w = byte_hashes(data).spans(start, end)
    lines, at, of = np.unique(line, return_index=True, return_inverse=True)
    grams, owner = [w], [of]
    total = w.copy()
    for n in (1, 2):
        total = total[:-1] * _C[0] + w[n:] * _C[n] if len(total) > 1 else total[:0]
        same = of[n:] == of[: len(of) - n] if len(of) > n else np.zeros(0, bool)
        grams.append(mix64(total[: len(same)])[same])
        owner.append(of[n:][same] if len(of) > n else of[:0])
    low = start[at] if len(at) else at
    last = np.append(at[1:], len(start)) - 1 if len(at) else at
    doc = np.searchsorted(first, low, side="right") - 1
    return np.concatenate(grams), np.concatenate(owner), len(w), doc, low - first[doc], (end[last] if len(at) else low) - first[doc]


def _rows(lines: list[str]) -> list[np.ndarray]:
    """Distinct n-gram buckets of each line."""
    if not lines:
        return []
    grams, owner, _, doc, _, _ = paragraphs([x.encode() for x in lines])
    pairs = np.unique(owner * np.int64(BUCKETS) + (grams % np.uint64(BUCKETS)).astype(np.int64))
    out = [np.zeros(0, np.int64) for _ in lines]
    for d, own in zip(doc, np.split(pairs % BUCKETS, np.searchsorted(pairs // BUCKETS, np.arange(1, len(doc)))), strict=False):
        out[d] = own
    return out


def training_lines(lines: list[str], copies: int = 18) -> tuple[list[str], np.ndarray]:
    """Varied templates and lines without a licence, with their classes."""
    rng = np.random.default_rng(17)
    words = [w for x in lines for w in x.split()] or ["word"]
    out, y = [], []

    def add(text, family):
        out.append(text)
        y.append(FAMILIES.index(family))

    for family, templates in TEMPLATES.items():
        for t in templates:
            own = t.split()
            add(t, family)
            for _ in range(copies):
                kept = [w for w in own if len(own) < 6 or rng.random() > 0.08]
                around = [words[i] for i in rng.integers(0, len(words), int(rng.integers(0, 7)))]
                cut = int(rng.integers(0, len(around) + 1))
                mark = ["", "# ", "// ", "* ", "<!-- ", "-- "][rng.integers(6)]
                text = mark + " ".join([*around[:cut], *kept, *around[cut:]])
                add(text.upper() if rng.random() < 0.1 else text, family)
            for _ in range(copies // 6):  # the words alone make no licence
                mixed = [*own, *[words[i] for i in rng.integers(0, len(words), 2 * len(own))]]
                rng.shuffle(mixed)
                add(" ".join(mixed), "unknown")
    known = {tuple(t.lower().split()[i:i + 3]) for ts in TEMPLATES.values() for t in ts for i in range(len(t.split()) - 2)}
    for x in lines:
        own = x.lower().split()
        if not any(tuple(own[i:i + 3]) in known for i in range(len(own) - 2)):
            add(x, "unknown")
    return out, np.array(y)


def fit(lines: list[str], steps: int = 150) -> dict:
    """Weights by bucket and family, bias and temperature; and the templates'
    n-grams, the only ones with a weight (a paragraph's other n-grams count in
    its length), for the confirmation."""
    text, y = training_lines(lines)
    union = np.zeros(BUCKETS, dtype=bool)
    union[np.concatenate([r for ts in TEMPLATES.values() for r in _rows(list(ts))])] = True
    rows = _rows(text)
    scale = 1 / np.sqrt(np.maximum([len(r) for r in rows], 1))
    rows = [r[union[r]] for r in rows]
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    cols, col = np.unique(np.concatenate(rows), return_inverse=True)
    x, k, n = scale[row], len(FAMILIES), len(rows)
    gold = np.eye(k)[y]
    back = np.random.default_rng(19).random(n) < 0.2
    own = ((~back) / np.maximum(np.bincount(y, minlength=k)[y], 1) / k)[:, None]

    def logits(params):
        z = np.stack([np.bincount(row, x * params[0][col, c], minlength=n) for c in range(k)], axis=1)
        return z + params[1]

    def gradient(_, params):
        z = logits(params)
        p = np.exp(z - z.max(1, keepdims=True))
        d = (p / p.sum(1, keepdims=True) - gold) * own
        return [np.stack([np.bincount(col, x * d[row, c], minlength=len(cols)) for c in range(k)], axis=1) + 1e-6 * params[0], d.sum(0)]

    w, b = adam(gradient, [np.zeros((len(cols), k)), np.zeros(k)], steps, 0.3)
    z = logits([w, b])[back]
    grid = np.exp(np.linspace(np.log(0.3), np.log(10), 60))

    def loss(t):
        s = z / t - (z / t).max(1, keepdims=True)
        return -(s[np.arange(len(z)), y[back]] - np.log(np.exp(s).sum(1))).mean()
    full = np.zeros((BUCKETS, k), dtype=np.float32)
    full[cols] = w
    least = min(len(_rows([t])[0]) / 3 + 1 for ts in TEMPLATES.values() for t in ts)
    return {"w": full, "b": b, "union": union, "least": least, "temperature": float(min(grid, key=loss)),
            "templates": [[set(r.tolist()) for r in _rows(list(ts))] for ts in TEMPLATES.values()]}


def _long(model: dict, line: bytes) -> list[tuple[int, int, str, float, float]]:
    """(start, end, family, probability, agreement) of the best windows of a long
    paragraph, places in its bytes; none overlaps a better one."""
    data = np.concatenate(([False], _WORD[np.frombuffer(line, np.uint8)], [False]))
    edges = np.flatnonzero(np.diff(data.astype(np.int8)))
    grams, _, n, _, _, _ = paragraphs([line])
    bucket = (grams % np.uint64(BUCKETS)).astype(np.int64)
    known = np.append(0, np.cumsum(model["union"][bucket]))
    passed = []
    for k, least in zip(WINDOWS, (model["least"], *(0.75 * k for k in WINDOWS)), strict=False):
        if n <= k:
            break
        at = np.append(np.arange(0, n - k, k // 4), n - k)
        two, three = n + at, 2 * n - 1 + at
        shared = known[two + k - 1] - known[two] + known[three + k - 2] - known[three]
        for a in at[shared >= (3 * AGREE - 1) * min(k, least) - 3 * AGREE]:
            own = np.unique(np.concatenate((bucket[a: a + k], bucket[n + a: n + a + k - 1], bucket[2 * n - 1 + a: 2 * n + a + k - 3])))
            hit = own[model["union"][own]]
            z = (model["w"][hit].sum(0) / np.sqrt(len(own)) + model["b"]) / model["temperature"]
            p = np.exp(z - z.max())
            p /= p.sum()
            best = int(p.argmax())
            if best < len(FAMILIES) - 1 and p[best] > CHANCE:
                own = set(own.tolist())
                agree, both = max((len(own & t) / min(len(own), len(t)), len(own & t)) for t in model["templates"][best])
                if agree >= AGREE:
                    passed.append((both, float(p[best]), int(a), k, FAMILIES[best], agree))
    out, taken = [], []      # places of the windows taken, in order and apart
    for _, p, a, k, family, agree in sorted(passed, key=lambda x: (-x[0], -x[1], x[2])):
        start, end = int(edges[2 * a]), int(edges[2 * (a + k) - 1])
        at = bisect_left(taken, (start, end))
        if not (at and taken[at - 1][1] > start) and not (at < len(taken) and taken[at][0] < end):
            insort(taken, (start, end))
            out.append((start, end, family, p, agree))
    return sorted(out)


def found_in(model: dict, texts: list[bytes]) -> list[tuple[int, int, int, str, float, float]]:
    """(text, start, end, family, probability, agreement), places in code points."""
    grams, owner, n_words, doc, start, end = paragraphs(texts)
    if not len(doc):
        return []
    bucket = (grams % np.uint64(BUCKETS)).astype(np.int64)
    # Only paragraphs that a template could confirm are scored.  m words make
    # 3 m - 3 n-grams, m of them single words, so AGREE = 0.6 of them takes at
    # least 0.8 m - 1.8 longer ones, m being the words of the shorter side.
    words = np.bincount(owner[:n_words], minlength=len(doc))
    shared = np.bincount(owner[n_words:][model["union"][bucket[n_words:]]], minlength=len(doc))
    some = shared >= (3 * AGREE - 1) * np.minimum(words, model["least"]) - 3 * AGREE
    own = some[owner]
    pairs = np.unique(owner[own] * np.int64(BUCKETS) + bucket[own])
    size = np.bincount(pairs // BUCKETS, minlength=len(doc))
    hit = pairs[model["union"][pairs % BUCKETS]]
    z = np.stack([np.bincount(hit // BUCKETS, model["w"][hit % BUCKETS, c], minlength=len(doc))
                  for c in range(len(FAMILIES))], axis=1) / np.sqrt(np.maximum(size, 1))[:, None]
    z = (z + model["b"]) / model["temperature"]
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    best = p.argmax(1)
    out, whole = [], np.zeros(len(doc), dtype=bool)
    for i in np.flatnonzero((words <= WINDOWS[-1]) & some & (best < len(FAMILIES) - 1) & (p.max(1) > CHANCE)):
        a, b = np.searchsorted(pairs, [i * BUCKETS, (i + 1) * BUCKETS])
        own = set((pairs[a:b] % BUCKETS).tolist())
        agree = max(len(own & t) / min(len(own), len(t)) for t in model["templates"][best[i]])
        if agree >= AGREE:
            t = texts[doc[i]]
            whole[i] = True
            at = len(t[: start[i]].decode("utf-8", "replace"))
            out.append((int(doc[i]), at, at + len(t[start[i]: end[i]].decode("utf-8", "replace")), FAMILIES[best[i]], float(p[i, best[i]]), agree))
    # a window needs as many known n-grams as the smallest template that it may hold
    for i in np.flatnonzero(~whole & (words > WINDOWS[0]) & (shared >= (3 * AGREE - 1) * min(WINDOWS[0], model["least"]) - 3 * AGREE)):
        t = texts[doc[i]]
        for a, b, family, p_best, agree in _long(model, t[start[i]: end[i]]):
            at = len(t[: start[i] + a].decode("utf-8", "replace"))
            out.append((int(doc[i]), at, at + len(t[start[i] + a: start[i] + b].decode("utf-8", "replace")), family, p_best, agree))
    return sorted(out)


def sample_lines(docs: DataFrame, most: int = SAMPLE, text_col: str = "text") -> list[str]:
    """Lines of a bounded sample of documents."""
    rows = lowest(docs.select(F.col(f"`{text_col}`").alias("text")).filter("text is not null"), F.xxhash64("text"), docs.count(), most, ["text"])
    return sorted({x for r in rows.collect() for x in r["text"].splitlines() if x.strip()})


def scan(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per licence paragraph: doc_id, start, end, family, probability,
    agreement."""
    names = ("doc_id", "start", "end", "family", "probability", "agreement")

    def rows(batch, texts):
        found = found_in(model, texts)
        if not found:
            return None
        ids = batch.column("doc_id").to_pylist()
        return dict(zip(names, ([ids[f[0]] for f in found], *map(list, list(zip(*found))[1:])), strict=True))
    own = tables(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return arrow_map(own, rows, "doc_id long, start int, end int, family string, probability double, agreement double")
