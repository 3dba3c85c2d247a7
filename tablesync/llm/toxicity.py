"""Toxicity by compression distance.

Two zstandard dictionaries are made from labelled text: one trained on ordinary prose, one of the words by which
toxic documents differ from it, whole, and trained on the stretches of words whose short pieces tell. A window of whole words is compressed twice, once with the
ordinary dictionary and once with the toxic one put before it; the second result is shorter where
the window shares content with toxic text only. A document's windows give the bytes saved
in all and for its length, the most in one window and in three, the shares of windows that save
at least two to five bytes, and how many windows there are. A logistic curve over these, fitted
on the labelled sample, gives the score.

The dictionaries are used as plain content: they bring no entropy tables of their own, so an ordinary
window costs the same with either.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tablesync.functions.quoting import quote_part
from tablesync.llm.common import FIT_ROWS, fit_sample, held_out, map_batches, pieces

WINDOW_WORDS = 14
TOXIC_BYTES, ORDINARY_BYTES = 1536, 65536
# Whole words are added to the trained stretches, as many as there are; beyond this size a dictionary is trained on them.
WORD_BYTES = 49152
# Words, and parts of words by their pieces of GRAM bytes, go into the toxic dictionary if they are in so many toxic
# documents, near copies counted once, at such odds (log).
MIN_DOCS, MIN_ODDS, GRAM = 4, 4.0, 5
# What the driver gets for training at most: distinctive words, and windows of ordinary text.
MAX_PARTS, MAX_WINDOWS, WINDOW_BYTES = 4000, 20_000, 256
# Bytes of text whose pieces of words are sent at once: they are many times the text.
GRAM_TEXT = 1 << 20
FLAG_AT = 0.5
TOXIC_WEIGHT = 2.0
_EDGE = b".,;:!?\"'()[]#*$%&|<>"


def words_of(data: bytes | None) -> list[bytes]:
    return (data or b"").lower().split()


def windows(data: bytes | None, size: int = WINDOW_WORDS) -> list[bytes]:
    """The whole text in windows of whole words, at least one."""
    words = words_of(data)
    return [b" " + b" ".join(words[i : i + size]) + b" " for i in range(0, len(words), size)] or [b""]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    settings = zstandard.ZstdCompressionParameters(
        strategy=zstandard.STRATEGY_LAZY2,
        min_match=5,
        window_log=17,
        hash_log=16,
        chain_log=16,
        search_log=4,
        target_length=16,
        write_checksum=0,
        write_content_size=0,
        write_dict_id=0,
    )
    if not content:
        return zstandard.ZstdCompressor(compression_params=settings)
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=held, compression_params=settings)


def _trained(samples: list[bytes], size: int, k: int) -> bytes:
    """Content of a trained dictionary; of few samples, which zstandard refuses, their end."""
    try:
        return zstandard.train_dictionary(size, samples, k=k, d=6).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(samples)[-size:]


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.c_[(x - self.mean) / self.scale, np.ones(len(x))] @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Distances:
    """What the windows of a text save with the toxic dictionary."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.plain, self.both = _compressor(ordinary).compress, _compressor(toxic + ordinary).compress

    def __call__(self, data: bytes | None) -> list[float]:
        found = windows(data)
        saved = np.array([len(self.plain(w)) - len(self.both(w)) for w in found])
        size = sum(map(len, found))
        most = np.sort(saved)[::-1]
        return [
            1000 * float(saved.sum()) / max(size, 1),
            float(saved.sum()) / max(size, 1) ** 0.5,
            float(min(most[0], 12)),
            float(min(most[:3].sum(), 30)),
            *[float((saved >= least).mean()) for least in (2, 3, 4, 5)],
            float(np.log(len(found))),
        ]


def _grams(word: bytes) -> set[bytes]:
    """The pieces of five bytes of a word with a blank before and after it."""
    own = b" " + word + b" "
    return {own[i : i + GRAM] for i in range(max(len(own) - GRAM + 1, 1))}


def _whole(word: bytes) -> bytes:
    """A word with a blank before and after it; of a very long one its start."""
    return (b" " + word + b" ")[:WINDOW_BYTES]


def _sketch(words: set[bytes]) -> int:
    """A hash that near copies mostly share: the smallest of the words' hashes."""
    return min((xxhash.xxh64_intdigest(w, 1) for w in words), default=0) >> 1


def _class_grams(sample: DataFrame) -> DataFrame:
    """``gram``, pieces and whole words, with the numbers of toxic sketches and of ordinary sample documents that have it.

    Near copies of one toxic document would make all its words look distinctive, so toxic documents count by their sketch.
    """

    def run(batches):
        for batch in pieces(batches, GRAM_TEXT):
            gram, sketch, label = [], [], []
            for data, own in zip(batch["text"], batch["label"]):
                words = {w.strip(_EDGE) for w in words_of(data)} - {b""}
                found = set().union(*map(_grams, words), map(_whole, words))
                gram += found
                sketch += [_sketch(words)] * len(found)
                label += [own] * len(found)
            yield {"gram": gram, "sketch": sketch, "label": label}

    found = map_batches(sample.select("text", "label"), run, "gram binary, sketch long, label int")
    toxic = F.col("label") == 1
    return found.groupBy("gram").agg(
        F.count_distinct(F.when(toxic, F.col("sketch"))).alias("toxic"), F.sum((~toxic).cast("long")).alias("ordinary")
    )


def _typical_parts(word: bytes, grams: set[bytes]) -> list[bytes]:
    """The stretches of a word, blanks around it included, that such pieces cover."""
    own = b" " + word + b" "
    parts: list[list[int]] = []
    for i in range(max(len(own) - GRAM + 1, 1)):
        if own[i : i + GRAM] in grams:
            if parts and i <= parts[-1][1]:
                parts[-1][1] = i + GRAM
            else:
                parts.append([i, i + GRAM])
    return [own[i:j] for i, j in parts]


def _toxic_parts(sample: DataFrame, grams: set[bytes]) -> DataFrame:
    """``part, n``: stretches of words that such pieces cover, and the toxic sketches that have them."""

    def run(batches):
        for batch in pieces(batches, GRAM_TEXT):
            part, sketch = [], []
            for data in batch["text"]:
                words = {w.strip(_EDGE) for w in words_of(data)} - {b""}
                found = {p for w in words for p in _typical_parts(w, grams)}
                part += found
                sketch += [_sketch(words)] * len(found)
            yield {"part": part, "sketch": sketch}

    toxic = sample.where(F.col("label") == 1).select("text")
    return map_batches(toxic, run, "part binary, sketch long").groupBy("part").agg(F.count_distinct("sketch").alias("n"))


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model | None:
    """Dictionaries and curve from ``labels.toxic`` of at most ``rows`` documents.

    The held-out fold is not used. None where the labels do not have both classes.
    """
    sample = fit_sample(docs, labels, "toxic", rows).select("doc_id", "text", "label").persist()
    try:
        sizes = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
        if not sizes.get(0) or not sizes.get(1):
            return None
        odds = F.log((F.col("toxic") + 0.1) / (sizes[1] + 0.2)) - F.log((F.col("ordinary") + 0.1) / (sizes[0] + 0.2))
        least = max(min(MIN_DOCS, sizes[1]), sizes[1] // 100)
        grams = (
            _class_grams(sample)
            .where((F.col("toxic") >= least) & (odds > min(MIN_ODDS, 0.5 * np.log(11 * sizes[0]))))
            .orderBy(F.desc("toxic"), "gram")
            .limit(MAX_PARTS)
            .collect()
        )
        found = [(bytes(r.gram), r.toxic) for r in grams]
        whole = [(g, n) for g, n in found if len(g) != GRAM or g[:1] + g[-1:] == b"  "]
        parts = _toxic_parts(sample, {g for g, _ in found if len(g) <= GRAM})
        typical = parts.where(F.col("n") >= least).orderBy(F.desc("n"), "part").limit(MAX_PARTS).collect()
        each = F.greatest(F.lit(1), F.ceil(F.lit(4 * MAX_WINDOWS) / sizes[0])).cast("int")
        cut = F.expr(f"transform(sequence(0, (octet_length(text) - 1) div {WINDOW_BYTES}), i -> substring(text, i * {WINDOW_BYTES} + 1, {WINDOW_BYTES}))")
        ordinary = (
            sample.where((F.col("label") == 0) & (F.octet_length("text") > 0))
            .withColumn("text", F.lower(F.col("text").cast("string")).cast("binary"))
            .select("doc_id", F.explode(F.slice(F.array_sort(F.transform(cut, lambda w: F.struct(F.xxhash64(w).alias("h"), w.alias("w")))), 1, each)).alias("x"))
            .select("x.h", "x.w", "doc_id")
            .orderBy("h", "doc_id")
            .limit(MAX_WINDOWS)
            .collect()
        )
        content = _toxic_content([(bytes(r.part), r.n) for r in typical], whole)
        plain = _trained([bytes(r.w) for r in ordinary], ORDINARY_BYTES, 24)

        def run(batches):
            distances = Distances(content, plain)
            for batch in pieces(batches):
                yield {"label": batch["label"], "inputs": [distances(t) for t in batch["text"]]}

        found = map_batches(sample.select("text", "label"), run, "label int, inputs array<double>").collect()
    finally:
        sample.unpersist()
    x, y = np.array([r.inputs for r in found]), np.array([r.label for r in found], float)
    order = np.lexsort([*x.T, y])
    return _fit_curve(content, plain, x[order], y[order])


def _toxic_content(typical: list[tuple[bytes, int]], whole: list[tuple[bytes, int]]) -> bytes:
    """The distinctive words, the more frequent ones nearer to the text, before a dictionary trained on the parts."""
    words = b"".join(w for w, _ in reversed(whole))
    if len(words) > WORD_BYTES:
        words = _trained_on(whole, WORD_BYTES)
    return words + _trained_on(typical, TOXIC_BYTES)


def _trained_on(typical: list[tuple[bytes, int]], size: int) -> bytes:
    """A dictionary trained on distinctive parts of words, the more frequent ones more often."""
    if not typical:
        return b""
    rng = np.random.default_rng(6)
    least = min(n for _, n in typical)
    drawn = [w for w, n in typical for _ in range(1 + int(np.log2(n / least)))]
    drawn = [drawn[i] for i in rng.permutation(len(drawn))]
    samples = [b"".join(drawn[i : i + 4]) for i in range(0, len(drawn), 4)]
    return _trained(samples, size, 16)


def _fit_curve(toxic: bytes, ordinary: bytes, x: np.ndarray, y: np.ndarray, weight: float = TOXIC_WEIGHT) -> Model:
    """Logistic regression with a little shrinkage, by Newton's steps that are halved until they help.

    A toxic document counts ``weight`` times: missing one is worse than flagging another.
    """
    v = np.where(y == 1, weight, 1.0)
    mean, scale = x.mean(0), x.std(0) + 1e-6
    a = np.c_[(x - mean) / scale, np.ones(len(x))]
    shrink = np.r_[np.full(x.shape[1], 1e-4 * len(x)), 1e-8 * len(x)]

    def loss(w: np.ndarray) -> float:
        z = a @ w
        return float(np.sum(v * (np.logaddexp(0, z) - y * z)) + 0.5 * np.sum(shrink * w * w))

    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -40, 40)))
        bend = a.T @ (a * (v * np.maximum(p * (1 - p), 1e-9))[:, None]) + np.diag(shrink)
        step = np.linalg.solve(bend, a.T @ (v * (y - p)) - shrink * w)
        size = 1.0
        while size > 1e-4 and loss(w + size * step) >= loss(w):
            size /= 2
        if size <= 1e-4:
            break
        w = w + size * step
    return Model(toxic, ordinary, mean, scale, w)


def _scored(docs: DataFrame, labels: DataFrame, rows: int, out: StructType) -> DataFrame:
    model = fit_toxicity(docs, labels, rows)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = sent.value
        distances = Distances(model.toxic, model.ordinary) if model else None
        for batch in pieces(batches, by="__own_text"):
            texts = batch["__own_text"]
            score = model.score(np.array([distances(t) for t in texts])) if model else np.zeros(len(texts))
            yield {**{n: batch[n] for n in out.names}, "__toxic_score": score}

    schema = StructType([*out, StructField("__toxic_score", DoubleType())])
    return map_batches(docs.select(*[F.col(quote_part(n)) for n in out.names], F.col("text").cast("binary").alias("__own_text")), run, schema)


def score_toxicity(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    A null text counts as empty; an empty text has one empty window. Without labels of both
    classes every score is 0.
    """
    scored = _scored(docs, labels, rows, StructType([StructField("doc_id", LongType())]))
    score = F.col("__toxic_score")
    return scored.select(
        "doc_id", held_out().alias("held_out"), score.alias("score"), (score >= FLAG_AT).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """The documents scored under one half, with all their columns; a null text stays null and counts as empty."""
    scored = _scored(docs, labels, rows, docs.schema)
    return scored.where(F.col("__toxic_score") < FLAG_AT).drop("__toxic_score")
