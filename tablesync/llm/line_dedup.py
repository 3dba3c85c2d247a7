"""Lines that many documents share, dropped by probing sharded minimal perfect hash tables.

A line's key is the line without ASCII white space at its ends and with A-Z lower-cased. Keys are
hashed to 128 bits and counted over all documents. The frequent ones are dealt to shards of
bounded size; each shard becomes a minimal perfect hash (bit arrays that place every key in a slot
of its own, level by level) over an array of fingerprints and one of counts. Documents then
probe these arrays where they are read: neither texts nor lines are shuffled.

Only keys of at least ``min_docs`` documents are indexed, as no other key can be dropped. The slot
of a key that is not indexed holds another fingerprint: 64 bits of the hash, of which the
slot uses none.

The arrays are broadcast in rounds of at most ``round_bytes``. Almost always one round is enough; if not, the
documents are flagged in rounds, with the flags written to the shared folder in between, so that
memory stays bounded whatever the number of frequent lines.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tablesync.llm.common import checkpointed, map_batches, pieces

SHARD_KEYS = 1 << 16
ROUND_BYTES = 128 << 20


def lines_of(data: bytes | None) -> list[bytes]:
    return (data or b"").split(b"\n")


def hashes(keys: list[bytes]) -> np.ndarray:
    """Two unsigned 64-bit words for each key."""
    digest = xxhash.xxh3_128_digest
    return np.frombuffer(b"".join([digest(k) for k in keys]), "<u8").reshape(-1, 2)


def _place(words: np.ndarray, level: int, size: int) -> np.ndarray:
    x = words[:, 1] + np.uint64((level * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Slots 0 to n - 1 for n distinct hashes, with a fingerprint and a count in each.

    On each level a key takes the bit it falls on if no other key left falls there; the
    others go on to the next level. A key's slot is the number of bits set before its own.
    """

    def __init__(self, sizes, words, before, fingerprints, counts):
        self.sizes, self.words, self.before = sizes, words, before
        self.fingerprints, self.counts = fingerprints, counts

    @classmethod
    def build(cls, keys: np.ndarray, counts: np.ndarray) -> PerfectHash:
        sizes, levels, left = [], [], np.arange(len(keys))
        while len(left):
            if len(sizes) == 200:
                raise ValueError("two of the keys have the same second word")
            size = -(-2 * len(left) // 64) * 64
            place = _place(keys[left], len(sizes), size)
            alone = np.bincount(place, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = left[~alone[place]]
        bits = np.concatenate(levels) if levels else np.zeros(0, bool)
        words = np.packbits(bits, bitorder="little").view("<u8")
        ones = np.bitwise_count(words).astype(np.uint32)
        before = (np.cumsum(ones) - ones).astype(np.uint32)
        out = cls(np.array(sizes, np.int64), words, before, np.zeros(len(keys), "<u8"), np.zeros(len(keys), "<u4"))
        slots = out.slots(keys)
        out.fingerprints[slots] = keys[:, 0]
        out.counts[slots] = np.minimum(counts, 2**32 - 1)
        return out

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """A slot for each key; -1 for a key that falls on no set bit."""
        out = np.full(len(keys), -1, np.int64)
        left, start = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            at = start + _place(keys[left], level, size)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            here = (self.words[word] >> bit) & np.uint64(1) == 1
            w, b = word[here], bit[here]
            below = self.words[w] & ((np.uint64(1) << b) - np.uint64(1))
            out[left[here]] = self.before[w].astype(np.int64) + np.bitwise_count(below)
            left, start = left[~here], start + size
        return out

    def count(self, keys: np.ndarray) -> np.ndarray:
        """The count of each key, 0 for keys that are not indexed."""
        out = np.zeros(len(keys), np.int64)
        slots = self.slots(keys)
        known = np.flatnonzero(slots >= 0)
        known = known[self.fingerprints[slots[known]] == keys[known, 0]]
        out[known] = self.counts[slots[known]]
        return out

    def to_bytes(self) -> bytes:
        head = np.array([len(self.sizes), len(self.words), len(self.counts)], "<i8")
        parts = (head, self.sizes.astype("<i8"), self.words, self.fingerprints, self.before.astype("<u4"), self.counts)
        return b"".join(p.tobytes() for p in parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        n_sizes, n_words, n = np.frombuffer(data, "<i8", 3).tolist()
        at, out = 24, []
        for kind, size in (("<i8", n_sizes), ("<u8", n_words), ("<u8", n), ("<u4", n_words), ("<u4", n)):
            out.append(np.frombuffer(data, kind, size, at))
            at += out[-1].nbytes
        return cls(out[0], out[1], out[3], out[2], out[4])


def line_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``h1, h2, n_docs`` of every distinct line key; a document counts once for a key."""

    def run(batches):
        for batch in pieces(batches, 16 << 20):
            counts: dict[bytes, int] = {}
            for data in batch["text"]:
                for key in {line.strip().lower() for line in lines_of(data)}:
                    if key:
                        counts[key] = counts.get(key, 0) + 1
            if counts:
                h = hashes(list(counts)).view("<i8")
                yield {"h1": h[:, 0], "h2": h[:, 1], "n": np.fromiter(counts.values(), np.int64, len(counts))}

    found = map_batches(docs.select(F.col(text).cast("binary").alias("text")), run, "h1 long, h2 long, n long")
    return found.groupBy("h1", "h2").agg(F.sum("n").alias("n_docs"))


def build_shards(frequent: DataFrame, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, int]:
    """``shard, data, size`` with a perfect hash in each row, and the number of shards."""
    frequent = checkpointed(frequent)
    shards = max(1, -(-frequent.count() // shard_keys))

    def build(rows):
        keys = rows[["h1", "h2"]].to_numpy().astype("<i8").view("<u8")
        data = PerfectHash.build(keys, rows["n_docs"].to_numpy()).to_bytes()
        import pandas as pd

        return pd.DataFrame({"shard": [int(rows["shard"].iloc[0])], "data": [data], "size": [len(data)]})

    dealt = frequent.withColumn("shard", F.pmod("h1", F.lit(shards)))
    return checkpointed(dealt.groupBy("shard").applyInPandas(build, "shard long, data binary, size long")), shards


def _rounds(shards: DataFrame, most: int) -> list[list[int]]:
    rounds: list[list[int]] = [[]]
    filled = 0
    for row in shards.select("shard", "size").orderBy("shard").toLocalIterator():
        if filled + row["size"] > most and rounds[-1]:
            rounds.append([])
            filled = 0
        rounds[-1].append(row["shard"])
        filled += row["size"]
    return rounds


def _flag(batch, tables: dict[int, PerfectHash], shards: int) -> list[np.ndarray]:
    """For each document, which of its lines are known to the tables."""
    split = [[line.strip().lower() for line in lines_of(data)] for data in batch["text"]]
    keys = [k for lines in split for k in lines]
    h = hashes(keys)
    found = np.zeros(len(keys), bool)
    shard = h[:, 0].view("<i8") % shards
    full = np.fromiter(map(bool, keys), bool, len(keys))
    for s in np.unique(shard).tolist():
        if s in tables:
            at = np.flatnonzero((shard == s) & full)
            found[at] = tables[s].count(h[at]) > 0
    ends = np.cumsum([len(lines) for lines in split])
    return np.split(found, ends[:-1])


def mark_lines(
    docs: DataFrame,
    min_docs: int = 10,
    text: str = "text",
    round_bytes: int = ROUND_BYTES,
    shard_keys: int = SHARD_KEYS,
    then: tuple[Callable[[dict], dict], StructType | str] | None = None,
) -> DataFrame:
    """The documents with ``__line_flags``, one byte for each line: 1 where it is to be dropped.

    ``then`` makes other columns of the flagged batches, and has their schema. It runs in the worker that flags them:
    a second worker for each task would stay on beside the first in all that follows.
    """
    frequent = line_counts(docs, text).where(F.col("n_docs") >= min_docs)
    shards, n_shards = build_shards(frequent, shard_keys)
    sc = docs.sparkSession.sparkContext
    names = docs.columns
    out = docs.withColumn("__line_flags", F.lit(None).cast("binary"))
    rounds = _rounds(shards, round_bytes)
    for i, members in enumerate(rounds):
        rows = shards.where(F.col("shard").isin(members)).collect() if members else []
        sent = sc.broadcast({r.shard: bytes(r.data) for r in rows})

        finish = then[0] if then and i + 1 == len(rounds) else None

        def run(batches, sent=sent, finish=finish):
            tables = {s: PerfectHash.from_bytes(d) for s, d in sent.value.items()}
            for batch in pieces(batches, by=text):
                work = {"text": [None if t is None else t.encode() for t in batch[text]]}
                flags = _flag(work, tables, n_shards)
                old = batch["__line_flags"]
                batch["__line_flags"] = [
                    (f if o is None else f | np.frombuffer(o, bool)).tobytes() for f, o in zip(flags, old)
                ]
                yield finish(batch) if finish else batch

        schema = then[1] if finish else StructType([*docs.schema, StructField("__line_flags", BinaryType())])
        out = map_batches(out.select(*names, "__line_flags"), run, schema)
        if i + 1 < len(rounds):
            out = checkpointed(out)
    return out


def keep_lines(data: bytes, flags: bytes) -> bytes:
    return b"\n".join([line for line, gone in zip(lines_of(data), flags) if not gone])


def drop_lines(docs: DataFrame, min_docs: int = 10, text: str = "text", **options) -> DataFrame:
    """The documents without the lines whose key is in at least ``min_docs`` documents.

    All columns stay; ``text`` becomes what is left and ``n_chars``, where there is one, its
    length. Each row counts as one document, also where rows repeat. A null or empty text is one
    empty line; an empty key is never dropped. A null text stays null.
    """
    names = docs.columns

    def kept(batch):
        batch[text] = [
            keep_lines((t or "").encode(), f).decode() if had else None
            for t, f, had in zip(batch[text], batch["__line_flags"], batch["__had_text"])
        ]
        return {n: batch[n] for n in names}

    out = mark_lines(docs.withColumn("__had_text", F.col(text).isNotNull()), min_docs, text, **options, then=(kept, docs.schema))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def line_report(docs: DataFrame, min_docs: int = 10, **options) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of every document."""

    def report(batch):
        kept = [keep_lines((t or "").encode(), f) for t, f in zip(batch["text"], batch["__line_flags"])]
        return {
            "doc_id": batch["doc_id"],
            "n_lines": [len(f) for f in batch["__line_flags"]],
            "n_dropped": [sum(f) for f in batch["__line_flags"]],
            "kept_sha256": [hashlib.sha256(k).hexdigest() for k in kept],
        }

    schema = "doc_id long, n_lines long, n_dropped long, kept_sha256 string"
    return mark_lines(docs.select("doc_id", "text"), min_docs, **options, then=(report, schema))
