"""Repeated passages: runs of consecutive sentences, hashed, joined globally, and removed.

A run is two or more sentences of twenty words or more together. Of all runs two for each sentence are hashed: the shortest
that starts with it, and the shortest that ends with it. These cover just what all runs cover: where a run is
repeated, so are the shortest ones within it, and each of its sentences lies in one that starts or ends no farther than the run does. All
hashed runs meet in one aggregate by their 128-bit hash, which gives the smallest document id of each repeated run. A second pass sends only
the runs that may be repeated, by a bitmap of fixed size, to be joined with that. Every sentence covered by a
repeated run goes, except in the run's first occurrence: the smallest id, and the first place there.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import bitmap_of, checkpointed, in_bitmap, map_batches, pieces

MIN_SENTENCES, MIN_WORDS = 2, 20
_SENTENCE = re.compile(rb"[^.!?\n]*[.!?\n]+|[^.!?\n]+")


def sentences(data: bytes | None) -> tuple[list[bytes], list[list[bytes]]]:
    """The text cut after its sentences, and each one's words; what has no word goes to the one before."""
    parts: list[bytes] = []
    words: list[list[bytes]] = []
    for part in _SENTENCE.findall(data or b""):
        own = part.lower().rstrip(b".!?\n").split()
        if own or not parts:
            parts.append(part)
            words.append(own)
        else:
            parts[-1] += part
    return parts, words


def runs(words: list[list[bytes]], min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS) -> list[tuple[int, int, bytes]]:
    """``(first, after the last, hash)`` of the shortest runs from and to each sentence, as far as there are enough."""
    joined = [b" ".join(w) for w in words]
    ends = np.cumsum([0, *map(len, words)])
    places = set()
    for i in range(len(words)):
        j = max(i + min_sentences, int(np.searchsorted(ends, ends[i] + min_words)))
        if j <= len(words):
            places.add((i, j))
    for j in range(min_sentences, len(words) + 1):
        if ends[j] >= min_words:
            places.add((min(j - min_sentences, int(np.searchsorted(ends, ends[j] - min_words, "right")) - 1), j))
    return [(i, j, xxhash.xxh3_128_digest(b"\n".join(joined[i:j]))) for i, j in sorted(places)]


def _runs_of(docs: DataFrame, sizes: tuple[int, int], bitmap: np.ndarray | None = None) -> DataFrame:
    """``h1, h2, doc_id, i, j, again``: again where the document has had the same run before."""
    sent = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        bitmap = sent.value
        for batch in pieces(batches):
            out: dict[str, list] = {k: [] for k in ("h", "doc_id", "i", "j", "again")}
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                had: set[bytes] = set()
                for i, j, h in runs(sentences(text)[1], *sizes):
                    if bitmap is None or in_bitmap(bitmap, int.from_bytes(h[:8], "little", signed=True)):
                        for k, v in (("h", h), ("doc_id", doc_id), ("i", i), ("j", j), ("again", h in had)):
                            out[k].append(v)
                    had.add(h)
            if out["h"]:
                h = np.frombuffer(b"".join(out.pop("h")), "<i8").reshape(-1, 2)
                yield {"h1": h[:, 0], "h2": h[:, 1], **out}

    own = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return map_batches(own, run, "h1 long, h2 long, doc_id long, i int, j int, again boolean")


def repeated_spans(docs: DataFrame, min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, i, j, first_id``: runs that are not the first of their kind, by sentence numbers."""
    sizes = (min_sentences, min_words)
    found = _runs_of(docs, sizes).groupBy("h1", "h2").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    repeated = checkpointed(found.where(F.col("n") > 1).select("h1", "h2", "first_id"))
    maybe = _runs_of(docs, sizes, bitmap_of(repeated, F.col("h1")))
    return (
        maybe.join(repeated, ["h1", "h2"])
        .where(F.col("again") | ~F.col("doc_id").eqNullSafe(F.col("first_id")))
        .select("doc_id", "i", "j", "first_id")
    )


def _with_spans(docs: DataFrame, **sizes) -> DataFrame:
    spans = repeated_spans(docs.select("doc_id", "text"), **sizes).groupBy(F.col("doc_id").alias("__span_id")).agg(
        F.collect_set(F.struct("i", "j", "first_id")).alias("__spans")
    )
    return docs.join(spans, F.col("doc_id").eqNullSafe(F.col("__span_id")), "left").drop("__span_id")


def _cut(text: str | None, spans: list | None) -> tuple[bytes, int, int, list[int]]:
    """What is kept of a text, how many of its sentences there were and went, and the first documents that have these."""
    parts, words = sentences((text or "").encode())
    gone = np.zeros(len(parts) + 1, np.int64)
    for span in spans or ():
        gone[span["i"]] += 1
        gone[span["j"]] -= 1
    keep = np.cumsum(gone)[:-1] == 0
    known = [s for s in spans or () if s["first_id"] is not None]
    first = np.full(len(parts), np.iinfo(np.int64).max)
    for span in known:
        np.minimum(first[span["i"] : span["j"]], span["first_id"], out=first[span["i"] : span["j"]])
    ids = np.unique(first[first < np.iinfo(np.int64).max]).tolist()
    return b"".join([p for p, k in zip(parts, keep) if k]), len(parts), int((~keep).sum()), ids


def drop_spans(docs: DataFrame, min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without the sentences of repeated runs; all columns stay, a null text stays null."""
    names = docs.columns
    marked = _with_spans(docs, min_sentences=min_sentences, min_words=min_words)

    def run(batches):
        for batch in batches:
            texts, spans = batch["text"], batch["__spans"]
            batch["text"] = [t if s is None else _cut(t, s)[0].decode() for t, s in zip(texts, spans)]
            yield {n: batch[n] for n in names}

    out = map_batches(marked, run, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def span_report(docs: DataFrame, min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, n_sentences, n_removed, kept_sha256, first_ids`` of every document.

    ``first_ids``: for each removed sentence the smallest id of a document with a run around it, this one's own included; empty where nothing
    was removed. A null
    text counts as empty and has no sentence. Rows of one id count as one document at the places where they agree; a run in a
    document with a null id is never the first if a document with an id has it.
    """
    own = docs.select("doc_id", "text")
    marked = _with_spans(own, min_sentences=min_sentences, min_words=min_words)

    def run(batches):
        for batch in batches:
            found = [_cut(t, s) for t, s in zip(batch["text"], batch["__spans"])]
            yield {
                "doc_id": batch["doc_id"],
                "n_sentences": [f[1] for f in found],
                "n_removed": [f[2] for f in found],
                "kept_sha256": [hashlib.sha256(f[0]).hexdigest() for f in found],
                "first_ids": [f[3] for f in found],
            }

    return map_batches(marked, run, "doc_id long, n_sentences long, n_removed long, kept_sha256 string, first_ids array<bigint>")
