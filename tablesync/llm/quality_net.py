"""Quality score: random-indexing word vectors, pooled per document, and a two-layer network.

Every word (hashed to a row of a table of fixed size) has a sparse index vector of a few +1 and -1 that
follow from its hash. Its context vector is the sum of the index vectors of the words near it, over all
documents; scaled to unit length and joined to its own index vector it is the word's vector. A document is the
mean and the spread of its words' vectors, rare words weighing more, with its length. A network of two layers, trained in numpy on a
bounded sample of labelled documents, gives a logit; its temperature is set on a part of the
sample that the weights were not fitted on.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import FIT_ROWS, fit_sample, held_out, map_batches, pieces, summed_table
from tablesync.llm.words import WordHashes

ROWS_BITS, DIMENSIONS, NONZERO, NEAR = 15, 32, 2, 2
HIDDEN, ROUNDS, RATE, DECAY = 32, 60, 3e-3, 1e-3
GOOD_AT = 0.3
# What a row of label 0 weighs in the fit: with it, a document as likely good as bad is scored GOOD_AT, where it is decided.
BAD_WEIGHT = (1 - GOOD_AT) / GOOD_AT
CHUNK_WORDS = 1 << 12


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of each row's index vector."""
    rng = np.random.default_rng(3)
    places = np.argsort(rng.random((1 << ROWS_BITS, DIMENSIONS)), 1)[:, :NONZERO]
    return places, rng.choice([-1, 1], places.shape)


def rows_of(data: bytes | None, hashes: WordHashes) -> np.ndarray:
    """The table row of each word of a text."""
    return (hashes(data or b"") >> np.uint64(64 - ROWS_BITS)).astype(np.int64)


def context_table(docs: DataFrame) -> np.ndarray:
    """Context sums of all rows over all documents; the last column counts the words."""
    places, signs = _index_vectors()
    width, hashes = DIMENSIONS + 1, WordHashes()
    # Entries of -1 are counted in columns of their own, so that a sum is a count.
    columns = [np.ascontiguousarray(places[:, k] + DIMENSIONS * (signs[:, k] < 0)) for k in range(NONZERO)]
    wide = 2 * DIMENSIONS

    def add(total: np.ndarray, batch: dict[str, list]) -> None:
        texts = [rows_of(t, hashes) for t in batch["text"]]
        ids = np.concatenate(texts)
        own = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        counted = []
        for gap in range(1, NEAR + 1):
            same = np.flatnonzero(own[gap:] == own[:-gap]) if len(ids) > gap else np.zeros(0, np.int64)
            a, b = ids[same], ids[same + gap]
            for x, y in ((a, b), (b, a)):
                counted += [x * wide + c[y] for c in columns]
        sums = np.bincount(np.concatenate(counted), minlength=wide << ROWS_BITS).reshape(-1, wide)
        total[:, :DIMENSIONS] += sums[:, :DIMENSIONS] - sums[:, DIMENSIONS:]
        total[:, DIMENSIONS] += np.bincount(ids, minlength=1 << ROWS_BITS)

    text = docs.select(F.col("text").cast("binary").alias("text"))
    return summed_table(text, add, (1 << ROWS_BITS, width))


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """Unit context vectors and index vectors side by side, weighed down where words are frequent."""
    places, signs = _index_vectors()
    own = np.zeros((1 << ROWS_BITS, DIMENSIONS))
    np.put_along_axis(own, places, signs / np.sqrt(NONZERO), 1)
    context = sums[:, :DIMENSIONS].astype(float)
    context /= np.linalg.norm(context, axis=1, keepdims=True) + 1e-9
    share = sums[:, DIMENSIONS] / max(int(sums[:, DIMENSIONS].sum()), 1)
    weight = 1e-3 / (1e-3 + share)
    return np.ascontiguousarray(np.c_[context, own] * weight[:, None], np.float32)


def pooled(batch: list, vectors: np.ndarray, hashes: WordHashes) -> np.ndarray:
    """Mean and spread of the word vectors of each text, its word count (log) and the mean's length."""
    width = vectors.shape[1]
    out = np.zeros((len(batch), 2 * width + 2))
    for row, data in zip(out, batch):
        ids = rows_of(data, hashes)
        total, squares = np.zeros(width), np.zeros(width)
        for s in range(0, len(ids), CHUNK_WORDS):
            part = vectors[ids[s : s + CHUNK_WORDS]]
            total += part.sum(0)
            squares += np.einsum("ij,ij->j", part, part)
        n = max(len(ids), 1)
        mean = total / n
        row[:width], row[width : 2 * width] = mean, np.sqrt(np.maximum(squares / n - mean * mean, 0))
        row[-2:] = np.log1p(len(ids)), np.linalg.norm(mean)
    return out


@dataclass
class Network:
    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2[:, 0] + b2[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -40, 40)))


def train(x: np.ndarray, y: np.ndarray, seed: int = 3) -> Network:
    """Adam on the logistic loss with rows of label 0 weighted, then the temperature on every fifth row."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    x, y = x[order], y[order]
    aside = np.arange(len(x)) % 5 == 0
    if len(set(y[~aside].tolist())) < 2:
        aside[:] = False
    own, label = x[~aside], y[~aside]
    weight = np.where(label == 0, BAD_WEIGHT, 1.0)
    net = Network(
        own.mean(0),
        own.std(0) + 1e-6,
        [
            rng.normal(0, own.shape[1] ** -0.5, (own.shape[1], HIDDEN)),
            np.zeros(HIDDEN),
            rng.normal(0, HIDDEN**-0.5, (HIDDEN, 1)),
            np.zeros(1),
        ],
    )
    z = (own - net.mean) / net.scale
    m, v = [np.zeros_like(w) for w in net.weights], [np.zeros_like(w) for w in net.weights]
    step = 0
    for _ in range(ROUNDS):
        for rows in np.array_split(rng.permutation(len(z)), max(len(z) // 64, 1)):
            a, t = z[rows], label[rows]
            w1, b1, w2, b2 = net.weights
            h = np.tanh(a @ w1 + b1)
            miss = 1 / (1 + np.exp(-np.clip(h @ w2[:, 0] + b2[0], -40, 40))) - t
            out = (weight[rows] * miss)[:, None] / len(rows)
            back = out @ w2.T * (1 - h * h)
            slopes = [a.T @ back + DECAY * w1, back.sum(0), h.T @ out + DECAY * w2, out.sum(0)]
            step += 1
            for k, g in enumerate(slopes):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                net.weights[k] = net.weights[k] - RATE * (m[k] / (1 - 0.9**step)) / (
                    np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8
                )
    if aside.any():
        logit, t = net.logit(x[aside]), y[aside]
        net.temperature = float(min(np.geomspace(0.25, 8, 61), key=lambda c: _loss(logit / c, t)))
    return net


def _loss(logit: np.ndarray, y: np.ndarray) -> float:
    return float(np.average(np.logaddexp(0, logit) - y * logit, weights=np.where(y == 0, BAD_WEIGHT, 1.0)))


def score_quality(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    Word vectors come from all documents, the network from ``labels.quality`` of at most ``rows`` documents outside
    the held-out fold. A null text counts as empty, and an empty one is pooled to zeros. Without
    labels of both classes every score is 0.5.
    """
    vectors = word_vectors(context_table(docs))
    sc = docs.sparkSession.sparkContext
    sent = sc.broadcast(vectors)

    def pool(batches):
        hashes = WordHashes()
        for batch in pieces(batches):
            yield {"label": batch["label"], "x": list(pooled(batch["text"], sent.value, hashes))}

    sample = map_batches(fit_sample(docs, labels, "quality", rows).select("text", "label"), pool, "label int, x array<double>").collect()
    y = np.array([r.label for r in sample], float)
    net = None
    if len(set(y.tolist())) == 2:
        x = np.array([r.x for r in sample])
        order = np.lexsort([*x.T, y])  # the same network whatever order the rows came in
        net = train(x[order], y[order])
    fitted = sc.broadcast(net)

    def run(batches):
        hashes, net = WordHashes(), fitted.value
        for batch in pieces(batches):
            x = pooled(batch["text"], sent.value, hashes)
            yield {"doc_id": batch["doc_id"], "score": net.score(x) if net else np.full(len(x), 0.5)}

    own = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    scored = map_batches(own, run, "doc_id long, score double")
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= GOOD_AT).cast("int").alias("predicted")
    )
