"""Toxicity: linear classifier on character n-grams scaled by naive Bayes ratios.

Features are the distinct character n-grams (UTF-8 bytes, A-Z in lower case,
white space as one space) of a text, hashed to ``BUCKETS``.  Each is scaled by
its naive Bayes log-count ratio, learned from labelled text, a text's vector is
brought to unit length, and a logistic regression is trained on it.  Its logits
are divided by a temperature.

Fitting uses at most ``SAMPLE`` labelled rows of each class; their n-grams are
counted by Spark.  Only n-grams in ``LEAST`` documents or more whose ratio is at
least ``RATIO`` keep a weight: the others' scale is near nothing.

Defined cases: a null or empty text has no features and scores by the intercept
alone; held-out and unlabelled rows are scored like others; without two classes
among the training rows every score is the share of label 1 (0.5 without any);
further columns are ignored, and only the text enters a score.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import (WHITE, adam, arrow_map, byte_hashes, held_out, joined, saved, sigmoid,
                                tables, temperature, training_rows)

SIZES, BUCKETS = (4, 6, 8), 1 << 20
SAMPLE, LEAST, RATIO, FOLDS, FOLD = 5000, 5, 1.0, 5, 0
_CHUNK = 1 << 20

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[WHITE] = 32


def n_grams(texts: list[bytes], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, bucket) pairs in order; ``wanted`` marks the buckets to keep."""
    data, starts = joined(texts)
    data = _FOLD[data]
    blank = data == 32
    keep = ~(blank & np.concatenate(([False], blank[:-1])))
    keep[starts] = True
    doc_ends = np.append(starts[1:], len(data))
    place = np.cumsum(keep) - 1
    ends = np.append(place, place[-1] + 1 if len(place) else 0)[doc_ends]
    data = data[keep]
    begins = place[starts]
    hashes = byte_hashes(data)
    owner = np.repeat(np.arange(len(texts)), ends - begins)
    found = []
    for n in SIZES:
        at = np.flatnonzero(np.arange(len(data)) + n <= ends[owner])
        bucket = (hashes.spans(at, at + n) % np.uint64(BUCKETS)).astype(np.int64)
        doc = owner[at]
        if wanted is not None:
            own = wanted[bucket]
            bucket, doc = bucket[own], doc[own]
        found.append(doc * BUCKETS + bucket)
    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return pairs // BUCKETS, pairs % BUCKETS


def ratios(rows: DataFrame, least: int = LEAST, ratio: float = RATIO) -> np.ndarray:
    """BUCKETS log-count ratios; 0 where a bucket is rare or tells nothing."""
    def counts(batch, texts):
        label = np.array(batch.column("label").to_pylist())
        doc, bucket = n_grams(texts)
        each, inverse = np.unique(bucket, return_inverse=True)
        hot = label[doc] == 1
        return {"bucket": each, "pos": np.bincount(inverse[hot], minlength=len(each)),
                "neg": np.bincount(inverse[~hot], minlength=len(each))}
    per = arrow_map(rows, counts, "bucket long, pos long, neg long", most=_CHUNK)
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = np.zeros(BUCKETS, dtype=np.float32)
    if len(sizes) < 2:
        return out
    share = [F.log((F.sum(c) + 1.0) / (sizes[k] + 2.0)) for c, k in (("pos", 1), ("neg", 0))]
    kept = (per.groupBy("bucket").agg(F.sum(F.col("pos") + F.col("neg")).alias("n"), (share[0] - share[1]).alias("r"))
            .filter((F.col("n") >= least) & (F.abs("r") >= ratio)).select("bucket", "r").toArrow())
    out[kept.column("bucket").to_numpy()] = kept.column("r").to_numpy()
    return out


def fit(doc: np.ndarray, bucket: np.ndarray, y: np.ndarray, weight: np.ndarray, r: np.ndarray,
        steps: int = 200) -> dict:
    """Logistic regression on the scaled features; a fifth of the rows only
    calibrates the temperature."""
    if len(np.unique(y)) < 2:
        return {"constant": float((weight * y).sum() / weight.sum()) if len(y) else 0.5}
    cols, col = np.unique(bucket, return_inverse=True)
    scale = np.sqrt(np.bincount(doc, r[bucket].astype(np.float64) ** 2, minlength=len(y)))
    x = r[bucket] / np.maximum(scale[doc], 1e-9)
    back = np.random.default_rng(3).random(len(y)) < 0.2
    own = np.where(back, 0, weight / weight[~back].sum())

    def logits(params):
        return np.bincount(doc, x * params[0][col], minlength=len(y)) + params[1]

    def gradient(_, params):
        d = (sigmoid(logits(params)) - y) * own
        return [np.bincount(col, x * d[doc], minlength=len(cols)) + 1e-6 * params[0], d.sum()]

    w, b = adam(gradient, [np.zeros(len(cols)), np.zeros(())], steps, 0.3)
    kept = back if len(np.unique(y[back])) == 2 else ~back
    t = temperature(logits([w, b])[kept], y[kept], weight[kept])
    full = np.zeros(BUCKETS, dtype=np.float32)
    full[cols] = w
    return {"w": full, "b": float(b), "temperature": t}


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = FOLDS, fold: int = FOLD,
          most: int = SAMPLE) -> dict:
    rows, weights = training_rows(tables(docs, doc_id="doc_id", text="text"), labels, label, folds, fold, most)
    rows = saved(rows, "toxicity-rows")
    r = ratios(rows)
    wanted = r != 0

    def features(batch, texts):
        doc, bucket = n_grams(texts, wanted)
        cut = np.searchsorted(doc, np.arange(len(texts) + 1))
        return {"doc_id": batch.column("doc_id"), "label": batch.column("label"),
                "x": [bucket[a:b].astype(np.int32).tobytes() for a, b in zip(cut, cut[1:])]}
    got = arrow_map(rows, features, "doc_id long, label int, x binary", most=_CHUNK).orderBy("doc_id", "label", "x").toArrow()
    x = [np.frombuffer(v, np.int32) for v in got.column("x").to_pylist()]
    y = np.array(got.column("label").to_pylist(), dtype=np.float64)
    doc = np.repeat(np.arange(len(x)), [len(v) for v in x]).astype(np.int64)
    bucket = np.concatenate(x) if x else np.zeros(0, np.int32)
    return fit(doc, bucket, y, np.array([weights[int(v)] for v in y]), r) | {"r": r}


def probability(model: dict, texts: list[bytes]) -> np.ndarray:
    if "constant" in model:
        return np.full(len(texts), model["constant"])
    doc, bucket = n_grams(texts, model["r"] != 0)
    x = model["r"][bucket].astype(np.float64)
    scale = np.sqrt(np.bincount(doc, x * x, minlength=len(texts)))
    z = np.bincount(doc, x * model["w"][bucket], minlength=len(texts)) / np.maximum(scale, 1e-9)
    return sigmoid((z + model["b"]) / model["temperature"])


def score(docs: DataFrame, model: dict, folds: int = FOLDS, fold: int = FOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    def rows(batch, texts):
        return {"doc_id": batch.column("doc_id"), "score": probability(model, texts)}
    own = tables(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return arrow_map(own, rows, "doc_id long, score double", most=_CHUNK).select(
        "doc_id", held_out("doc_id", folds, fold).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
