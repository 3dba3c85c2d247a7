"""Ranked lexical search by the best position algorithm.

One pass cuts every text into terms and keeps, for each document, its length and the counts of those terms that
the items ask for. With the counts over all documents, terms get their weights. Then each task turns
its documents into segments of bounded size: for each term a list of its documents by impact, and for each
document its places in all lists. For an item, the lists of its terms are read from the top in steps. A
document that comes up is looked up in all lists at once (direct access), which gives its whole score and marks its
places as seen. A list's best position is the last place up to which all have been seen. What no
list has shown yet can score at most the sum of the impacts at the best positions; reading stops once that is
strictly below the score of the last document that would be returned, so ties are never lost. A task
carries its best documents from segment to segment, and the best of all tasks meet at the end.

Items are taken in blocks of bounded size, each one a pass over the documents; documents are never joined with items.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm.common import checkpointed, map_batches, pieces

BLOCK_BYTES = 4 << 20
SEGMENT_POSTINGS = 4 << 20
FIRST_STEP = 64
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def terms(data: bytes | None) -> list[bytes]:
    """The maximal runs of ASCII letters, digits and all characters beyond ASCII; only A-Z are lower-cased."""
    return (data or b"").translate(_PLAIN).split()


def _blocks(items: DataFrame, most: int) -> Iterator[list[tuple]]:
    """The distinct items, in blocks of about ``most`` bytes of text, one item at least."""
    block, size = [], 0
    chosen = items.select("item_id", F.col("text").cast("binary").alias("text")).distinct()
    for row in chosen.orderBy("item_id", "text").toLocalIterator():
        if block and size + len(row.text or b"") > most:
            yield block
            block, size = [], 0
        block.append((row.item_id, bytes(row.text or b"")))
        size += len(row.text or b"")
    if block:
        yield block


def _postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, counts`` of each document, and rows ``term, df`` of each task's sums."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        known, df = sent.value, np.zeros(len(sent.value), np.int64)
        for batch in pieces(batches):
            out: dict[str, list] = {k: [] for k in ("n", "terms", "counts")}
            for text in batch["text"]:
                own = terms(text)
                counts = Counter(own)
                held = counts.keys() & known.keys()
                at = np.fromiter((known[t] for t in held), "<i4", len(held))
                df[at] += 1
                out["n"].append(len(own))
                out["terms"].append(at.tobytes())
                out["counts"].append(np.fromiter((counts[t] for t in held), "<i4", len(held)).tobytes())
            none = [None] * len(out["n"])
            yield {"doc_id": batch["doc_id"], **out, "term": none, "df": none}
        some = np.flatnonzero(df)
        if len(some):
            none = [None] * len(some)
            yield {**dict.fromkeys(("doc_id", "n", "terms", "counts"), none), "term": some, "df": df[some]}

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return checkpointed(map_batches(own, run, "doc_id long, n long, terms binary, counts binary, term int, df long"))


class Segment:
    """Impact lists of some documents: by term from the highest impact, and by document for direct access."""

    def __init__(self, doc_ids: np.ndarray, lengths: np.ndarray, terms: np.ndarray, counts: np.ndarray, norms: np.ndarray, n_terms: int):
        self.doc_ids, self.terms = doc_ids, terms
        self.starts = np.r_[0, np.cumsum(lengths)]
        owner = np.repeat(np.arange(len(doc_ids)), lengths)
        counts = counts.astype(np.int64)
        self.impacts = 1_000_000_000 * counts // (1000 * counts + 12 * norms[owner])
        order = np.lexsort((owner, -self.impacts, terms))
        self.list_starts = np.searchsorted(terms[order], np.arange(n_terms + 1))
        self.list_docs, self.list_impacts = owner[order], self.impacts[order]
        self.places = np.empty(len(order), np.int64)
        self.places[order] = np.arange(len(order)) - self.list_starts[terms[order]]
        self.slots = np.full(n_terms, -1, np.int64)

    def rows(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entries of the documents, and which document each belongs to."""
        sizes = self.starts[docs + 1] - self.starts[docs]
        of = np.repeat(np.arange(len(docs)), sizes)
        return np.arange(len(of)) - (np.cumsum(sizes) - sizes)[of] + self.starts[docs][of], of

    def search(self, asked: np.ndarray, weights: np.ndarray, k: int, best: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
        """``best`` (scores, ids) with what this segment has for terms of these weights, and how many documents were looked up."""
        lists = [(t, w, self.list_starts[t], self.list_starts[t + 1]) for t, w in zip(asked.tolist(), weights.tolist())]
        lists = [x for x in lists if x[2] < x[3]]
        if not lists:
            return *best, 0
        own, weights = np.array([x[0] for x in lists]), np.array([x[1] for x in lists])
        low, size = np.array([x[2] for x in lists]), np.array([x[3] - x[2] for x in lists])
        self.slots[own] = np.arange(len(own))
        shift = np.cumsum(size) - size
        seen = np.zeros(int(size.sum()), bool)
        met = np.zeros(len(self.doc_ids), bool)
        at = np.zeros(len(own), np.int64)  # best positions: places below are all seen
        depth, step, looked_up = 0, FIRST_STEP, 0
        while True:
            read = [self.list_docs[a + depth : a + min(depth + step, n)] for a, n in zip(low, size) if depth < n]
            depth, step = depth + step, step * 2
            docs = np.unique(np.concatenate(read)) if read else np.zeros(0, np.int64)
            docs = docs[~met[docs]]
            met[docs] = True
            looked_up += len(docs)
            if len(docs):
                entries, of = self.rows(docs)
                slot = self.slots[self.terms[entries]]
                entries, of, slot = entries[slot >= 0], of[slot >= 0], slot[slot >= 0]
                seen[shift[slot] + self.places[entries]] = True
                scores = np.zeros(len(docs), np.int64)
                np.add.at(scores, of, weights[slot] * self.impacts[entries])
                best = _merged(best, (scores, self.doc_ids[docs]), k)
            for i, (a, n) in enumerate(zip(shift, size)):
                if at[i] < n:
                    unseen = ~seen[a + at[i] : a + n]
                    at[i] = at[i] + int(unseen.argmax()) if unseen.any() else n
            open_ = at < size
            bound = int((weights * self.list_impacts[low + at - 1])[open_].sum())
            if not open_.any() or (len(best[0]) >= k and bound < best[0][-1]):
                self.slots[own] = -1
                return *best, looked_up


def _merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    scores, ids = np.r_[a[0], b[0]], np.r_[a[1], b[1]]
    some = scores > 0
    scores, ids = scores[some], ids[some]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def _best(postings: DataFrame, asked: list[tuple[np.ndarray, np.ndarray]], n_terms: int, totals: tuple[int, int], k: int, most: int) -> DataFrame:
    """``item, doc_id, score``: for each item the best documents of each task."""
    sent = postings.sparkSession.sparkContext.broadcast(asked)
    n_docs, n_all = totals

    def run(batches):
        asked = sent.value
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in asked]
        held: list[tuple[np.ndarray, ...]] = []

        def search() -> None:
            doc_ids, n, lengths, terms, counts = (np.concatenate(x) for x in zip(*held))
            segment = Segment(doc_ids, lengths, terms, counts, 75 + 25 * n * n_docs // n_all, n_terms)
            for i, (own, weights) in enumerate(asked):
                best[i] = segment.search(own, weights, k, best[i])[:2]
            held.clear()

        size = 0
        for batch in batches:
            found = [np.frombuffer(b"".join(batch[name]), "<i4") for name in ("terms", "counts")]
            lengths = np.fromiter((len(x) // 4 for x in batch["terms"]), np.int64, len(batch["terms"]))
            held.append((np.asarray(batch["doc_id"], np.int64), np.asarray(batch["n"], np.int64), lengths, *found))
            size += len(found[0])
            if size >= most:
                search()
                size = 0
        if held:
            search()
        for i, (scores, ids) in enumerate(best):
            if len(ids):
                yield {"item": np.full(len(ids), i), "doc_id": ids, "score": scores}

    whole = postings.where(F.col("doc_id").isNotNull() & (F.length("terms") > 0))
    return map_batches(whole.select("doc_id", "n", "terms", "counts"), run, "item int, doc_id long, score long")


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int = 20, block_bytes: int = BLOCK_BYTES, segment_postings: int = SEGMENT_POSTINGS
) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each item the ``k`` documents of the highest score above 0.

    A term counts as often as the item has it. Equal scores rank by ascending ``doc_id``. A null or empty text has no term;
    an item without terms, or with none that a document has, gets no row. Rows that repeat count as documents of their own,
    items that repeat with the same text are one item, and those with another text are ranked by themselves.
    A document with a null ``doc_id`` counts in all sums but cannot be returned. Very long texts are counted whole. Empty tables
    give no rows.
    """
    spark = docs.sparkSession
    answer = None
    for block in _blocks(items, block_bytes):
        wanted = [Counter(terms(text)) for _, text in block]
        vocabulary = {t: i for i, t in enumerate(sorted(set().union(*wanted)))}
        if not vocabulary:
            continue
        postings = _postings(docs, vocabulary)
        totals = postings.agg(F.count(F.when(F.col("n") > 0, 1)).alias("n"), F.sum("n").alias("l")).first()
        if not totals.n:
            continue
        df = np.zeros(len(vocabulary), np.int64)
        for row in postings.where("term is not null").groupBy("term").agg(F.sum("df").alias("df")).collect():
            df[row.term] = row.df
        weight = np.array([math.floor(1000 * math.log((2 * totals.n + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        asked = []
        for own in wanted:
            at = np.array(sorted(vocabulary[t] for t in own), np.int64)
            times = {vocabulary[t]: c for t, c in own.items()}
            asked.append((at, weight[at] * np.array([times[i] for i in at.tolist()], np.int64)))
        asked = [(at[w > 0], w[w > 0]) for at, w in asked]
        found = _best(postings, asked, len(vocabulary), (totals.n, totals.l), k, segment_postings)
        order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], _names_schema(items))
        part = ranked.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        answer = part if answer is None else answer.unionAll(part)
    if answer is None:
        kind = items.schema["item_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return answer


def _names_schema(items: DataFrame):
    from pyspark.sql.types import IntegerType, StructField, StructType

    return StructType([StructField("item", IntegerType()), StructField("item_id", items.schema["item_id"].dataType)])
