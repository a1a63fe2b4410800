"""Quality classifier on random-indexing word vectors.

Every word bucket owns a sparse ternary index vector.  Its context vector is the
sum of the index vectors of its neighbours (two to each side) over all documents
of the corpus; tasks add up their own documents and the sums meet by bucket.  A
word vector is the context vector, scaled by the word's count and centred, beside
the index vector itself.  A document pools its words: mean and standard
deviation of the vectors and how alike neighbouring words are.  A two-layer
network scores the pooled vector, its logits divided by a temperature fitted on
rows kept back from training.

``BUCKETS * DIMS`` floats bound the broadcast table whatever the corpus; the
network is fitted on ``SAMPLE`` labelled rows of each class at most.

Defined cases: a null or empty text pools to zeros and still gets a score;
unlabelled and held-out rows are scored like others; without two classes among
the training rows every score is the share of label 1 (0.5 without any); further
columns are ignored, and only the text enters a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import (adam, arrow_map, byte_hashes, held_out, joined, released, row_chunks, sigmoid, tables,
                                temperature, text_batches, texts_of, training_rows)

BUCKETS, DIMS, NONZERO, WINDOW = 1 << 14, 64, 4, 2
SAMPLE, HIDDEN, FOLDS, FOLD = 6000, 32, 3, 1
_CHUNK = 1 << 20

#: letters (and all bytes beyond ASCII) 1, digits 2, white space 0, else 3
_KIND = np.full(256, 3, dtype=np.uint8)
_KIND[list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = 1
_KIND[48:58] = 2
_KIND[[0x20, 9, 10, 11, 12, 13]] = 0


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of each bucket's index vector."""
    rng = np.random.default_rng(1729)
    places = np.argsort(rng.random((BUCKETS, DIMS)), axis=1)[:, :NONZERO]
    signs = np.where(np.arange(NONZERO) % 2, -1.0, 1.0)
    return places, signs


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every word (run of letters, digits or other marks) and the
    number of the text it is in."""
    data, starts = joined(texts)
    kind = _KIND[data]
    edges = np.flatnonzero(np.diff(kind)) + 1
    begin = np.append(0, edges)
    end = np.append(edges, len(data))
    word = kind[begin] > 0
    begin, end = begin[word], end[word]
    bucket = (byte_hashes(data).spans(begin, end) % np.uint64(BUCKETS)).astype(np.int64)
    return bucket, np.searchsorted(starts, begin, side="right") - 1


def context_sums(docs: DataFrame) -> DataFrame:
    """bucket, n and the DIMS entries of its context vector, over all documents.

    A task adds up its own documents and emits one row per bucket it has seen;
    the sums are whole numbers, so their order does not matter."""
    schema = "bucket int, n long, " + ", ".join(f"c{i} long" for i in range(DIMS))

    def run(batches):
        places, signs = index_vectors()
        total, count = np.zeros(BUCKETS * DIMS), np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            texts = texts_of(batch, "text")
            for part in row_chunks([len(x) for x in texts], _CHUNK):
                bucket, doc = words_of(texts[part])
                count += np.bincount(bucket, minlength=BUCKETS)
                pairs = []
                for off in range(1, WINDOW + 1):
                    near = np.flatnonzero(doc[off:] == doc[:-off])
                    left, right = bucket[near], bucket[near + off]
                    pairs += [left * BUCKETS + right, right * BUCKETS + left]
                # a pair of neighbours counts as often as it stands here, all in one sum
                pair, n = np.unique(np.concatenate(pairs), return_counts=True)
                cells = (pair // BUCKETS)[:, None] * DIMS + places[pair % BUCKETS]
                total += np.bincount(cells.ravel(), weights=(n[:, None] * signs).ravel(), minlength=len(total))
        seen = np.flatnonzero(count)
        sums = total.reshape(BUCKETS, DIMS)[seen].astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.astype(np.int32)), pa.array(count[seen]), *[pa.array(c) for c in sums.T]],
            names=["bucket", "n", *[f"c{i}" for i in range(DIMS)]])

    return tables(docs, text="text").mapInArrow(released(run), schema).groupBy("bucket").agg(
        F.sum("n").alias("n"), *[F.sum(f"c{i}").alias(f"c{i}") for i in range(DIMS)])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """BUCKETS x 2 DIMS: centred unit context vectors beside the index vectors; the
    numbers of a dimension lie together, as ``pooled`` reads them."""
    context, count = np.zeros((BUCKETS, DIMS)), np.zeros(BUCKETS)
    got = context_sums(docs).toArrow()
    at = got.column("bucket").to_numpy()
    count[at] = got.column("n").to_numpy()
    for i in range(DIMS):
        context[at, i] = got.column(f"c{i}").to_numpy()
    mean = context / np.maximum(count, 1)[:, None]
    mean -= (mean * count[:, None]).sum(0) / max(count.sum(), 1)
    mean /= np.maximum(np.linalg.norm(mean, axis=1), 1e-9)[:, None]
    places, signs = index_vectors()
    own = np.zeros((BUCKETS, DIMS))
    np.put_along_axis(own, places, np.tile(signs, (BUCKETS, 1)) / np.sqrt(NONZERO), axis=1)
    return np.asfortranarray(np.hstack([mean, own]).astype(np.float32))


def pooled(texts: list[bytes], vectors: np.ndarray) -> np.ndarray:
    """One row per text: mean and deviation of its word vectors, and summaries.

    Words run along the rows of the working arrays, so that the sums of a text add
    up numbers that lie together."""
    width = vectors.shape[1]
    across = np.ascontiguousarray(vectors.T)
    out = np.zeros((len(texts), 2 * width + 5), dtype=np.float32)
    for part in row_chunks([len(x) for x in texts], _CHUNK // 32):
        bucket, doc = words_of(texts[part])
        if not len(bucket):
            continue
        present, at, n = np.unique(doc, return_index=True, return_counts=True)
        rows = np.take(across, bucket, axis=1)
        half = width // 2
        like = np.zeros(len(bucket), dtype=np.float32)
        like[1:] = (rows[half:, 1:] * rows[half:, :-1]).sum(0) * (doc[1:] == doc[:-1])
        mean = np.add.reduceat(rows, at, axis=1).T / n[:, None]
        square = np.add.reduceat(np.multiply(rows, rows, out=rows), at, axis=1).T / n[:, None]
        own = out[part.start + present]
        own[:, :width] = mean
        own[:, width:2 * width] = np.sqrt(np.maximum(square - mean * mean, 0))
        own[:, -5] = np.linalg.norm(mean[:, :half], axis=1)
        own[:, -4] = np.linalg.norm(mean[:, half:], axis=1)
        own[:, -3] = np.add.reduceat(like, at) / n
        own[:, -2] = np.log1p(n)
        own[:, -1] = own[:, -4] * np.sqrt(n)
        out[part.start + present] = own
    return out


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, hidden: int = HIDDEN, steps: int = 3000) -> dict:
    """The network and its temperature; a fifth of the rows only calibrates."""
    share = float((weight * y).sum() / weight.sum()) if len(y) else 0.5
    if len(np.unique(y)) < 2:
        return {"constant": share}
    rng = np.random.default_rng(5)
    centre, spread = x.mean(0), x.std(0) + 1e-3
    x = (x - centre) / spread
    back = rng.random(len(y)) < 0.2
    if len(np.unique(y[~back])) < 2:
        back[:] = False
    xt, yt, wt = x[~back], y[~back], weight[~back] / weight.mean()

    def gradient(step, params):
        w1, b1, w2, b2 = params
        rows = rng.integers(0, len(yt), min(256, len(yt)))
        h = np.maximum(xt[rows] @ w1 + b1, 0)
        d = (sigmoid(h @ w2 + b2) - yt[rows]) * wt[rows] / len(rows)
        back_h = np.outer(d, w2) * (h > 0)
        return [xt[rows].T @ back_h + 1e-4 * w1, back_h.sum(0), h.T @ d + 1e-4 * w2, d.sum()]

    start = [rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], hidden)), np.zeros(hidden),
             rng.normal(0, hidden ** -0.5, hidden), np.zeros(())]
    w1, b1, w2, b2 = adam(gradient, start, steps, 3e-3)
    kept = back if back.any() else ~back
    z = np.maximum(x[kept] @ w1 + b1, 0) @ w2 + b2
    return {"centre": centre, "spread": spread, "w1": w1.astype(np.float32), "b1": b1, "w2": w2, "b2": float(b2),
            "temperature": temperature(z, y[kept], weight[kept])}


def probability(model: dict, x: np.ndarray) -> np.ndarray:
    if "constant" in model:
        return np.full(len(x), model["constant"])
    h = np.maximum((x - model["centre"]) / model["spread"] @ model["w1"] + model["b1"], 0)
    return sigmoid((h @ model["w2"] + model["b2"]) / model["temperature"])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS, fold: int = FOLD,
          most: int = SAMPLE) -> tuple[np.ndarray, dict]:
    """Word vectors over all documents and the fitted network."""
    vectors = word_vectors(docs)
    rows, weights = training_rows(tables(docs, doc_id="doc_id", text="text"), labels, label, folds, fold, most)

    def features(batch, texts):
        return {"doc_id": batch.column("doc_id"), "label": batch.column("label"),
                "x": [v.tobytes() for v in pooled(texts, vectors)]}
    got = arrow_map(rows, features, "doc_id long, label int, x binary").orderBy("doc_id", "label", "x").toArrow()
    y = np.array(got.column("label").to_pylist(), dtype=np.float64)
    width = 2 * vectors.shape[1] + 5
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), np.float32).reshape(-1, width).astype(np.float64)
    return vectors, fit(x, y, np.array([weights[int(v)] for v in y]))


def score(docs: DataFrame, vectors: np.ndarray, model: dict, folds: int = FOLDS, fold: int = FOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    def rows(batch, texts):
        return {"doc_id": batch.column("doc_id"), "score": probability(model, pooled(texts, vectors))}
    own = tables(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return arrow_map(own, rows, "doc_id long, score double").select(
        "doc_id", held_out("doc_id", folds, fold).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, vectors: np.ndarray, model: dict) -> DataFrame:
    """The documents that the network does not reject, with all their columns;
    every row is judged by its own text, so repeated and null ids need no care."""
    text_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(probability(model, pooled(texts_of(batch, "text"), vectors)) >= 0.5))
    return docs.mapInArrow(released(run), docs.schema)
