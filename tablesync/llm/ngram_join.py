"""Similarity self-join of documents on their sets of word n-grams, with several global orders.

Documents of the same set are one class. Two classes are candidates if they share a prefix token
under each of three orders of all tokens: sorted by an order, two sets of the asked
likeness must meet within the first n - ceil(t n) + 1 tokens of each. All orders put rare
tokens first, as counted in all documents, and break ties by different
hashes; a fixed share of all tokens comes before the others and is the only one counted. Any order is lossless.

1. One pass gives each document's set size and class; another counts how frequent tokens are.
2. The first order's prefix tokens meet in posting lists, each with its place in the prefix, the size of the
   set, and a parity signature of it. Two members of a list stay together if size, place and signature
   allow the likeness: from the place on, the sets must have enough tokens left, and
   the bits in which two signatures differ are at most the tokens in which the sets do. What leaves a list is a tree over the members that
   stay together, never its pairs. Trees joined give groups.
3. The classes of groups meet once more under the other orders, within their groups. What
   hangs together under all orders is a group of candidates.
4. Groups are compared exactly, in blocks of bounded size: each class's set travels once to its group, or
   once for each block if there are several, and nothing is sent for a pair. All pairs of a group are compared.
5. Components of the links give the answer.

A class goes by a 64-bit hash of its set, and a token by a 64-bit hash. Nothing is capped, and lists of any length go
the same way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import bitmap_of, checkpointed, in_bitmap, map_batches, pieces, release
from tablesync.llm.components import components
from tablesync.llm.words import ODD, WordHashes, mixed

ORDERS = 3
TABLE_BITS = 24
# Tokens that a task counts before it sends the counts, about.
COUNTED_AT_ONCE = 1 << 21
PREFIXES = 2.5
# Classes of a group go to the sets by a broadcast of at most so many bytes, beyond it by a join.
BROADCAST_BYTES, PLACE_BYTES = 16 << 20, 48
BLOCK_CLASSES, BLOCK_TOKENS = 1024, 2 << 20
# Longer lists are searched from row to row, the others all at once; both give the same trees.
LONG_LIST = 256


def shingles(data: bytes | None, width: int, hashes: WordHashes) -> np.ndarray:
    """The distinct hashed n-grams of a text, sorted; a shorter text is one n-gram as a whole."""
    x = hashes((data or b"").lower())
    if not len(x):
        return x
    if len(x) < width:
        return np.array([xxhash.xxh3_64_intdigest(x.tobytes(), seed=len(x))], np.uint64)
    n = len(x) - width + 1
    key = x[:n]
    for j in range(1, width):
        key = key * ODD + x[j : j + n]
    key = np.sort(mixed(key))
    return key[np.concatenate(([True], key[1:] != key[:-1]))]


def class_of(tokens: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).view(np.int64)))


def leading(tokens: np.ndarray, percent: int) -> np.ndarray:
    """Which tokens come first in all orders and are counted: so many that prefixes hold few others.

    Prefixes take the rarest of these; that only they are counted leaves the table emptier.
    """
    share = int(min(PREFIXES * (100 - percent), 100))
    return mixed(tokens, 77) <= np.uint64(share * (2**64 - 1) // 100)


def prefix(tokens: np.ndarray, rarity: np.ndarray, order: int, percent: int) -> np.ndarray:
    """The first tokens under one order, of which any set so alike shares one at least."""
    size = min(len(tokens) + (-len(tokens) * percent // 100) + 1, len(tokens))
    place = mixed(tokens, order + 1) >> np.uint64(7)
    place |= rarity[tokens >> np.uint64(64 - TABLE_BITS)].astype(np.uint64) << np.uint64(57)
    place |= (~leading(tokens, percent)).astype(np.uint64) << np.uint64(63)
    first = np.argpartition(place, size - 1)[:size]
    return tokens[first[np.argsort(place[first])]]


def signature(tokens: np.ndarray, percent: int) -> bytes:
    """Parities of the tokens dealt to bits: so many, a power of two, that unrelated sets differ in more than alike ones may."""
    bits = 128
    while bits * (100 + percent) < 48 * (100 - percent) * len(tokens) // 10:
        bits *= 2
    odd = np.bincount((mixed(tokens, 99) >> np.uint64(32)).astype(np.int64) % bits, minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


class Signatures:
    """Signatures of several rows, each also folded to all smaller widths, in which it meets smaller ones."""

    def __init__(self, data: list[bytes]):
        self.width = np.fromiter((len(d) >> 3 for d in data), np.int64, len(data))
        found: dict[int, list] = {}
        for width in np.unique(self.width).tolist():
            own = np.flatnonzero(self.width == width)
            part = np.frombuffer(b"".join([data[i] for i in own]), "<u8").reshape(len(own), width)
            while True:
                found.setdefault(part.shape[1], []).append((own, part))
                if part.shape[1] <= 2:
                    break
                part = part[:, : part.shape[1] // 2] ^ part[:, part.shape[1] // 2 :]
        self.at = {}
        for width, parts in found.items():
            place = np.full(len(data), -1, np.int64)
            place[np.concatenate([own for own, _ in parts])] = np.arange(sum(len(own) for own, _ in parts))
            self.at[width] = place, np.concatenate([part for _, part in parts])

    def differ(self, i, j: np.ndarray) -> np.ndarray:
        """In how many bits rows i and j differ, at the smaller width of the two."""
        i, j = np.broadcast_arrays(i, j)
        width = np.minimum(self.width[i], self.width[j])
        out = np.zeros(len(j), np.int64)
        for w in np.unique(width).tolist():
            place, rows = self.at[w]
            k = width == w
            out[k] = np.bitwise_count(rows[place[i[k]]] ^ rows[place[j[k]]]).sum(1, dtype=np.int64)
        return out


def _own(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.col("text").cast("binary").alias("text"))


def _sizes(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, n, c`` of each document: size and class of its set."""

    def run(batches):
        hashes = WordHashes()
        for batch in pieces(batches):
            sets = [shingles(t, width, hashes) for t in batch["text"]]
            yield {
                "doc_id": batch["doc_id"],
                "n": [len(s) for s in sets],
                "c": [class_of(s) if len(s) else None for s in sets],
            }

    return checkpointed(map_batches(_own(docs), run, "doc_id long, n long, c long"))


def _rarity(docs: DataFrame, width: int, percent: int) -> Broadcast:
    """How often each place of a table of tokens is taken, in bits of the count, over all documents.

    A task sends which places its documents take as bits and how often as a byte each, so many tokens at a time.
    """
    blocks = 64
    bits = TABLE_BITS - 6

    def run(batches):
        hashes = WordHashes()
        held, size = [], 0
        for batch in pieces(batches):
            for text in batch["text"]:
                tokens = shingles(text, width, hashes)
                held.append((tokens[leading(tokens, percent)] >> np.uint64(64 - TABLE_BITS)).astype(np.int32))
                size += len(held[-1])
            if size >= COUNTED_AT_ONCE:
                yield from counted(np.concatenate(held))
                held, size = [], 0
        if size:
            yield from counted(np.concatenate(held))

    def counted(taken):
        places, counts = np.unique(taken, return_counts=True)
        cuts = np.searchsorted(places >> bits, np.arange(blocks + 1))
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            at, n = places[cuts[b] : cuts[b + 1]] - (b << bits), counts[cuts[b] : cuts[b + 1]]
            taking = np.zeros(1 << bits, bool)
            taking[at] = True
            often = n > 255
            yield {
                "block": [b],
                "places": [np.packbits(taking).tobytes()],
                "counts": [np.minimum(n, 255).astype(np.uint8).tobytes()],
                "often": [at[often].astype("<i4").tobytes()],
                "beyond": [(n[often] - 255).astype("<i8").tobytes()],
            }

    def merge(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, places, counts, often, beyond in zip(*(batch[k] for k in ("block", "places", "counts", "often", "beyond"))):
                total = sums.setdefault(b, np.zeros(1 << bits, np.int64))
                total[np.unpackbits(np.frombuffer(places, np.uint8)).astype(bool)] += np.frombuffer(counts, np.uint8)
                total[np.frombuffer(often, "<i4")] += np.frombuffer(beyond, "<i8")
        for b, part in sums.items():
            yield {"block": [b], "data": [np.frexp(part.astype(np.float64))[1].astype(np.uint8).tobytes()]}

    schema = "block int, places binary, counts binary, often binary, beyond binary"
    sent = map_batches(_own(docs), run, schema).repartition(blocks, "block")
    rarity = np.zeros(1 << TABLE_BITS, np.uint8)
    for row in map_batches(sent, merge, "block int, data binary").toLocalIterator():
        rarity[row.block << bits : (row.block + 1) << bits] = np.frombuffer(row.data, np.uint8)
    return docs.sparkSession.sparkContext.broadcast(rarity)


_POSTING = "r int, token long, c long, n long, place int, signature binary"


def _postings(docs: DataFrame, width: int, percent: int, frequency, orders: list[int], bitmap=None) -> DataFrame:
    """``r, token, c, n, place, signature``: prefix tokens of the classes under the orders, once for each task."""
    sent = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        rarity, bitmap = frequency.value, sent.value
        hashes, seen = WordHashes(), set()
        for batch in pieces(batches):
            out: dict[str, list] = {k.split()[0]: [] for k in _POSTING.split(", ")}
            for text, h in zip(batch["text"], batch["h"]):
                if bitmap is not None and not in_bitmap(bitmap, h):
                    continue
                tokens = shingles(text, width, hashes)
                c = class_of(tokens) if len(tokens) else None
                if c is None or c in seen:
                    continue
                if len(seen) >= 500_000:
                    seen.clear()
                seen.add(c)
                bits = signature(tokens, percent)
                for r in orders:
                    own = prefix(tokens, rarity, r, percent).view(np.int64)
                    out["token"].append(own)
                    out["place"].append(np.arange(len(own)))
                    for name, value in (("r", r), ("c", c), ("n", len(tokens))):
                        out[name].append(np.full(len(own), value))
                    out["signature"] += [bits] * len(own)
            if out["r"]:
                yield {k: v if k == "signature" else np.concatenate(v) for k, v in out.items()}

    own = _own(docs).withColumn("h", F.xxhash64("doc_id"))
    return map_batches(own, run, _POSTING)


class Lists:
    """Posting lists, sorted by list and by size within each."""

    def __init__(self, columns: dict[str, np.ndarray], signatures: list[bytes], percent: int):
        change = np.flatnonzero(np.any([np.diff(columns[k]) != 0 for k in ("g", "r", "token")], axis=0)) + 1
        size = len(columns["c"])
        self.starts = np.r_[0, change, size] if size else np.zeros(1, np.int64)
        self.of = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        order = np.lexsort((columns["c"], columns["n"], self.of))
        self.columns = {k: v[order] for k, v in columns.items()}
        self.n, self.left = self.columns["n"], self.columns["n"] - self.columns["place"]
        self.signatures = Signatures([signatures[i] for i in order])
        self.percent = percent

    def together(self, i, j) -> np.ndarray:
        """May rows i and j be as alike as asked, meeting here first? What they share is at most what is left of either."""
        both = self.n[i] + self.n[j]
        out = (100 + self.percent) * np.minimum(self.left[i], self.left[j]) >= self.percent * both
        some = np.flatnonzero(out)
        differ = self.signatures.differ(i if np.ndim(i) == 0 else i[some], j[some])
        out[some] = (100 + self.percent) * differ <= (100 - self.percent) * both[some]
        return out

    def trees(self) -> tuple[np.ndarray, np.ndarray]:
        """Each row's row of lowest place that it hangs together with, by whatever ways, in its list; first those of long lists."""
        root = np.arange(len(self.n))
        long = np.diff(self.starts) > LONG_LIST
        for a, b in zip(self.starts[:-1][long].tolist(), self.starts[1:][long].tolist()):
            self._search(root, a, b)
        alive = np.flatnonzero(~long[self.of]) if len(self.of) else np.zeros(0, np.int64)
        lows, highs, step = [], [], 0
        while len(alive):
            step += 1
            alive = alive[alive + step < len(self.n)]
            other = alive + step
            # Sizes rise within a list, so a row is done with the first one that is too large for it.
            near = (self.of[alive] == self.of[other]) & (100 * self.n[alive] >= self.percent * self.n[other])
            alive, other = alive[near], other[near]
            right = self.together(alive, other)
            lows.append(alive[right])
            highs.append(other[right])
        if lows:
            _hang(root, np.concatenate(lows), np.concatenate(highs))
        return root, self.columns["c"]

    def _search(self, root: np.ndarray, a: int, b: int) -> None:
        """A long list: from a row to all that it stays with, and on from these, until none is left."""
        left = np.arange(a, b)
        while len(left):
            first, left, queue = left[0], left[1:], [left[0]]
            while queue and len(left):
                row = queue.pop()
                low = np.searchsorted(100 * self.n[left], self.percent * self.n[row])
                high = np.searchsorted(self.percent * self.n[left], 100 * self.n[row], "right")
                right = np.zeros(len(left), bool)
                right[low:high] = self.together(row, left[low:high])
                found = left[right]
                root[found] = first
                queue.extend(found.tolist())
                left = left[~right]


def _hang(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of the pairs, with the lowest row as root."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return
        low, high = np.minimum(x, y)[apart], np.maximum(x, y)[apart]
        np.minimum.at(root, high, low)
        while (root != root[root]).any():
            root[:] = root[root]


def _trees(postings: DataFrame, percent: int) -> DataFrame:
    """``r, a, b``: trees over the classes of each list that may be alike; lists are those of ``g, r, token``."""
    names = ["g", "r", "token", "c", "n", "place"]

    def run(batches):
        held: tuple[dict[str, np.ndarray], list[bytes]] | None = None
        for batch in batches:
            now, signatures = {k: np.asarray(batch[k]).astype(np.int64) for k in names}, list(batch["signature"])
            if held is not None:
                now, signatures = {k: np.concatenate([held[0][k], now[k]]) for k in now}, held[1] + signatures
            change = np.flatnonzero(np.any([np.diff(now[k]) != 0 for k in ("g", "r", "token")], axis=0)) + 1
            cut = int(change[-1]) if len(change) else 0
            yield from edges({k: v[:cut] for k, v in now.items()}, signatures[:cut])
            held = {k: v[cut:] for k, v in now.items()}, signatures[cut:]
        if held is not None:
            yield from edges(*held)

    def edges(columns, signatures):
        # Alone in its list, a row has nobody to meet.
        same = np.all([np.diff(columns[k]) == 0 for k in ("g", "r", "token")], axis=0)
        some = np.flatnonzero(np.r_[False, same] | np.r_[same, False]) if len(columns["c"]) else np.zeros(0, np.int64)
        if not len(some):
            return
        lists = Lists({k: v[some] for k, v in columns.items()}, [signatures[i] for i in some], percent)
        root, c = lists.trees()
        a, b = c[root], c
        moved = a != b
        if moved.any():
            edge = np.unique(np.stack([lists.columns["r"], np.minimum(a, b), np.maximum(a, b)], 1)[moved], axis=0)
            yield {"r": edge[:, 0], "a": edge[:, 1], "b": edge[:, 2]}

    dealt = postings.repartition("g", "r", "token").sortWithinPartitions("g", "r", "token")
    return map_batches(dealt.select(*names, "signature"), run, "r int, a long, b long").distinct()


def _sets(docs: DataFrame, width: int, bitmap: np.ndarray) -> DataFrame:
    """``c, tokens`` of the documents whose id passes the bitmap."""
    sent = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        bitmap, hashes = sent.value, WordHashes()
        for batch in pieces(batches):
            sets = [shingles(t, width, hashes) for t, h in zip(batch["text"], batch["h"]) if in_bitmap(bitmap, h)]
            sets = [s for s in sets if len(s)]
            if sets:
                yield {"c": [class_of(s) for s in sets], "tokens": [s.tobytes() for s in sets]}

    return map_batches(_own(docs).withColumn("h", F.xxhash64("doc_id")), run, "c long, tokens binary")


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many tokens each two of the sets share."""
    m = len(sets)
    out = np.zeros((m, m), np.float32)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    tokens, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    twice = times[at] > 1
    owner = owner[twice]
    place = (np.cumsum(times > 1) - 1)[at[twice]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    step = 4096
    for low in range(0, int(place[-1]) + 1 if len(place) else 0, step):
        s, e = np.searchsorted(place, [low, low + step])
        part = np.zeros((m, step), np.float32)
        part[owner[s:e], place[s:e] - low] = 1
        out += part @ part.T
    return out.astype(np.int64)


def _linked(sets: list[np.ndarray], blocks: np.ndarray, percent: int, mixed_blocks: bool) -> np.ndarray:
    n = np.array([len(s) for s in sets])
    both = shared_counts(sets)
    link = 100 * both >= percent * (n[:, None] + n[None, :] - both)
    if mixed_blocks:  # the links within a block are counted by its own group
        link &= blocks[:, None] != blocks[None, :]
    np.fill_diagonal(link, False)
    return link


def _verified(rows: DataFrame, percent: int) -> DataFrame:
    """``c, root, links`` from ``g, i, j, k, c, copies, tokens`` sorted by group."""

    def group(members: list[tuple], mixed_blocks: bool) -> dict:
        unique = {m[1]: m for m in members}  # repeated rows come with the same class
        members = list(unique.values())
        c, copies = np.array([m[1] for m in members]), np.array([m[2] for m in members])
        sets = [np.frombuffer(m[3], np.uint64) for m in members]
        link = _linked(sets, np.array([m[0] for m in members]), percent, mixed_blocks)
        root = np.arange(len(c))
        while True:
            low = np.minimum(root, np.where(link, root[None, :], len(c)).min(1, initial=len(c)))
            low = np.minimum(low, low[low])
            if (low == root).all():
                break
            root = low
        return {"c": c, "root": c[root], "links": (link * copies[None, :]).sum(1)}

    def run(batches):
        key, members = None, []

        def whole() -> bool:
            return len(members) > 1 and (key[1] == key[2] or len({m[0] for m in members}) > 1)

        for batch in batches:
            for g, i, j, *rest in zip(*(batch[k] for k in ("g", "i", "j", "k", "c", "copies", "tokens"))):
                if (g, i, j) != key:
                    if whole():
                        yield group(members, key[1] != key[2])
                    key, members = (g, i, j), []
                members.append(rest)
        if whole():
            yield group(members, key[1] != key[2])

    dealt = rows.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j")
    return map_batches(dealt.select("g", "i", "j", "k", "c", "copies", "tokens"), run, "c long, root long, links long")


def candidates(docs: DataFrame, classes: DataFrame, frequency, width: int, percent: int) -> DataFrame:
    """``g, c``: the groups of classes that hang together under every order."""
    first = _postings(docs, width, percent, frequency, [0]).withColumn("g", F.lit(0).cast("long"))
    groups = checkpointed(components(_trees(first, percent)).select(F.col("label").alias("g"), F.col("node").alias("c")))
    release(docs.sparkSession)
    bitmap = bitmap_of(classes.join(groups, "c", "left_semi"), F.xxhash64("first_id"))
    rest = _postings(docs, width, percent, frequency, list(range(1, ORDERS)), bitmap).join(groups, "c")
    edges = checkpointed(_trees(rest, percent))
    release(docs.sparkSession)
    for r in range(1, ORDERS):
        under = components(edges.where(F.col("r") == r))
        groups = groups.join(under.select(F.col("node").alias("c"), "label"), "c").select(F.xxhash64("g", "label").alias("g"), "c")
    return groups


def ngram_join(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` of every document.

    A document's set is its distinct n-grams of ``width`` words, where A-Z are lower-cased; a text
    of fewer words is one n-gram, and a null or empty text, or one without words, is linked with nothing. Two documents link
    when their sets have a Jaccard likeness of at least ``percent`` per cent. ``component_id`` is the
    smallest id that links lead to, ``n_links`` the number of documents linked directly; copies
    and repeated rows count. A null id is never the smallest. An empty table gives no rows.
    """
    found = _sizes(docs, width)
    classes = checkpointed(
        found.where(F.col("c").isNotNull())
        .groupBy("c")
        .agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("n"))
    )
    frequency = _rarity(docs, width, percent)
    cluster = checkpointed(candidates(docs, classes, frequency, width, percent).join(classes, "c"))
    blocks = cluster.groupBy("g").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES), F.ceil(F.sum("n") / BLOCK_TOKENS)).cast("int").alias("nb"),
        F.count(F.lit(1)).alias("members"),
    )
    placed = (
        cluster.join(blocks.where(F.col("members") > 1), "g")
        .withColumn("k", F.pmod(F.xxhash64("c"), F.col("nb")).cast("int"))
        .select("g", "k", "nb", "c", "copies")
    )
    sets = _sets(docs, width, bitmap_of(cluster, F.xxhash64("first_id")))
    # Only where sets and places have met is a class dealt to its pairs of blocks.
    if cluster.count() * PLACE_BYTES <= BROADCAST_BYTES:
        placed = F.broadcast(placed)
    dealt = (
        sets.join(placed, "c")
        .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
        .select("g", F.least("k", "o").alias("i"), F.greatest("k", "o").alias("j"), "k", "c", "copies", "tokens")
    )
    linked = checkpointed(_verified(dealt, percent))
    labels = components(linked.select(F.col("c").alias("a"), F.col("root").alias("b")))
    links = linked.groupBy("c").agg(F.sum("links").alias("links"))
    named = (
        classes.join(labels.select(F.col("node").alias("c"), "label"), "c", "left")
        .join(links, "c", "left")
        .withColumn("label", F.coalesce("label", "c"))
    )
    lowest = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    answer = named.join(lowest, "label").select(
        "c", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    return found.join(answer, "c", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents without near copies: of each component the one with the smallest id stays.

    All columns stay. Rows that are equal in all columns become one; documents without words all stay, and so do those with a null id and
    no words.
    """
    found = ngram_join(docs, width, percent)
    gone = found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    # Not all kinds of columns can be compared, but all can be written.
    whole = F.struct(*kept.columns)
    return kept.select(whole.alias("doc"), F.md5(F.to_json(whole)).alias("key")).dropDuplicates(["key"]).select("doc.*")
