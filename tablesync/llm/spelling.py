"""Spelling variants: words one edit apart, found by k-d trees over their letter counts.

One inserted or deleted letter changes one letter count by one, a replaced one changes two: the count vectors of words
that are near lie at most two apart in L1 distance. A word's counts are kept in unary, a few bits for each letter, so the
distance of two vectors, and of a vector to the box around some, is a count of bits; a count beyond its bits only
makes distances smaller, so nothing is lost.

Words of one length form one tree. It is searched by the words of that length (one letter more and one less)
and by those one letter shorter (one more), that is, for each pair of lengths. The top of each tree is fitted on a bounded sample
of the words on the driver; its leaves are the cells that words are dealt to, home and, as a query, to every cell whose
box is near enough. In each cell the task builds the rest of the tree, prunes it by the tight boxes of its
nodes, and verifies the order of letters of what is left. What goes on are sums for each word, never
pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import checkpointed, map_batches

LETTERS = r"[A-Za-zÀ-ÿ]"
SAMPLE_WORDS = 1 << 18
CELL_WORDS = 1 << 15
LEAF_WORDS = 48
QUERIES_AT_ONCE = 1 << 15
# Bits for each letter: four for a-z, two for the others of Latin-1, in four words of 64 bits.
_BITS = [(c, 4) for c in range(97, 123)] + [(c, 2) for c in range(192, 256)]


def word_counts(docs: DataFrame, least_letters: int = 6, least_times: int = 5, every: int = 199) -> DataFrame:
    """``word, n``: the words of at least so many letters and occurrences.

    A word is a run of letters with A-Z lower-cased. Of one run in ``every``, by the checksum of ``<doc_id>:<run>``, a letter is deleted.
    """
    # A shorter run cannot become a word, so that only these are cut out.
    found = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"({LETTERS}{{{max(least_letters, 1)},}})"), F.lit(1))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))
    lower = runs.select("id", F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("run"))
    hashed = lower.select("run", F.crc32(F.concat("id", F.lit(":"), F.col("run")).cast("binary")).alias("h"))
    at = F.expr("cast(h % length(run) as int)")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    word = F.when(F.col("h") % every == 0, cut).otherwise(F.col("run"))
    words = hashed.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return words.where((F.length("word") >= least_letters) & (F.col("n") >= least_times))


def letters(words: list[bytes], length: int) -> np.ndarray:
    """Words of one length as rows of Latin-1 bytes."""
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), length)


def unary(rows: np.ndarray) -> np.ndarray:
    """The letter counts of each row in unary, as four 64-bit words."""
    size = len(rows)
    counts = np.zeros((size, 256), np.int32)
    np.add.at(counts, (np.repeat(np.arange(size), rows.shape[1]), rows.ravel()), 1)
    out = np.zeros((size, 256), bool)
    at = 0
    for letter, bits in _BITS:
        for k in range(bits):
            out[:, at] = counts[:, letter] > k
            at += 1
    return np.packbits(out, axis=1, bitorder="little").view("<u8")


def _per_bit(codes: np.ndarray) -> np.ndarray:
    """How many of the codes have each bit."""
    out = np.zeros(256, np.int64)
    for low in range(0, len(codes), 1 << 16):
        part = np.ascontiguousarray(codes[low : low + (1 << 16)])
        out += np.unpackbits(part.view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return out


def _has(codes: np.ndarray, bit: int) -> np.ndarray:
    return codes[:, bit >> 6] >> np.uint64(bit & 63) & np.uint64(1) == 1


class Node:
    """A box around codes: bits that all have, bits that any has, and two halves or the members of a leaf."""

    __slots__ = ("low", "high", "halves", "members", "bit")

    def __init__(self, low, high, halves=None, members=None, bit=-1):
        self.low, self.high, self.halves, self.members, self.bit = low, high, halves, members, bit


def build(codes: np.ndarray, members: np.ndarray, leaf: int) -> Node:
    """Halved at the letter count that comes nearest to a half, down to ``leaf`` members or equal codes."""
    own = codes[members]
    low, high = np.bitwise_and.reduce(own, 0), np.bitwise_or.reduce(own, 0)
    if len(members) <= leaf or (low == high).all():
        return Node(low, high, members=members)
    bit = int(np.abs(_per_bit(own) - len(members) / 2).argmin())
    more = _has(own, bit)
    return Node(low, high, (build(codes, members[~more], leaf), build(codes, members[more], leaf)), bit=bit)


def near_box(node: Node, codes: np.ndarray, more: int, less: int) -> np.ndarray:
    """Which codes may reach the box with so many letters more and so many less."""
    up = np.bitwise_count(node.low & ~codes).sum(1, dtype=np.int16)
    down = np.bitwise_count(codes & ~node.high).sum(1, dtype=np.int16)
    return (up <= more) & (down <= less)


def reached(node: Node, codes: np.ndarray, chosen: np.ndarray, more: int, less: int) -> Iterator[tuple[Node, np.ndarray]]:
    """The leaves and which of the chosen codes reach them."""
    stack = [(node, chosen)]
    while stack:
        node, chosen = stack.pop()
        chosen = chosen[near_box(node, codes[chosen], more, less)]
        if not len(chosen):
            continue
        if node.halves is None:
            yield node, chosen
        else:
            stack += [(half, chosen) for half in node.halves]


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(1) == 1


def one_inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Is ``b`` the word ``a`` with one letter more? The letters they share at both ends must cover ``a``."""
    same, shifted = a == b[:, :-1], a == b[:, 1:]
    ahead = np.where(same.all(1), a.shape[1], same.argmin(1))
    behind = np.where(shifted.all(1), a.shape[1], shifted[:, ::-1].argmin(1))
    return ahead + behind >= a.shape[1]


def near_pairs(tree: Node, codes: np.ndarray, words: np.ndarray, q_codes: np.ndarray, q_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``query, word`` of all that are one edit apart: queries of the same length or one letter shorter."""
    longer = words.shape[1] > q_words.shape[1]
    check = one_inserted if longer else one_replaced
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for leaf, chosen in reached(tree, q_codes, np.arange(len(q_codes)), 1, 0 if longer else 1):
        own = codes[leaf.members]
        step = max(1, (1 << 20) // len(own))
        for at in range(0, len(chosen), step):
            part = chosen[at : at + step]
            differ = np.bitwise_count(q_codes[part][:, None, :] ^ own[None, :, :]).sum(2, dtype=np.int16)
            q, w = np.nonzero(differ <= (1 if longer else 2))
            q, w = part[q], leaf.members[w]
            right = check(q_words[q], words[w])
            found.append((q[right], w[right]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


class Cells:
    """The top of the tree of one length, fitted on a sample: its cells, and over how many tasks each is spread."""

    def __init__(self, length: int, sample: list[bytes], words: int, most: int):
        codes = unary(letters(sample, length))
        share = words / len(sample)
        self.root = build(codes, np.arange(len(codes)), max(1, int(most / share)))
        # A box of the sample need not hold all words, so cells are known by the counts that they were split at.
        none, every = np.zeros(4, np.uint64), np.full(4, ~np.uint64(0))
        self.spread: list[int] = []
        stack = [(self.root, none, every)]
        while stack:
            node, node.low, node.high = stack.pop()
            if node.halves is None:
                self.spread.append(max(1, -(-int(len(node.members) * share) // most)))
                node.members = len(self.spread) - 1
                continue
            bit = np.zeros(4, np.uint64)
            bit[node.bit >> 6] = np.uint64(1) << np.uint64(node.bit & 63)
            stack += [(node.halves[0], node.low, node.high & ~bit), (node.halves[1], node.low | bit, node.high)]

    def homes(self, codes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(codes), np.int64)
        for leaf, chosen in reached(self.root, codes, np.arange(len(codes)), 0, 0):
            out[chosen] = leaf.members
        return out


def _cells(words: DataFrame, sample_words: int, most: int) -> dict[int, Cells]:
    """The cells of each length. All lengths together send at most ``sample_words`` words to the driver, the ones of least hash."""
    sizes = {r["length"]: r["count"] for r in words.groupBy("length").count().collect()}
    total = sum(sizes.values())
    chosen: dict[int, list[bytes]] = {}
    sampled = words.where(F.pmod(F.xxhash64("word"), F.lit(1 << 20)) <= (sample_words << 20) // max(total, 1))
    for row in sampled.orderBy(F.xxhash64("word")).limit(sample_words).collect():
        chosen.setdefault(row["length"], []).append(row["word"].encode("latin-1"))
    # A length of which the sample has no word is one cell.
    return {k: Cells(k, chosen.get(k, [b"a" * k]), n, most) for k, n in sizes.items()}


def _dealt(words: DataFrame, cells: dict[int, Cells]) -> DataFrame:
    """``length, cell, part, kind, word, n``: words (kind 0) at home, and as queries (1: shorter, 2: as long) wherever near."""
    sent = words.sparkSession.sparkContext.broadcast(cells)

    def run(batches):
        cells = sent.value
        for batch in batches:
            lengths = np.asarray(batch["length"])
            for size in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == size)
                own, n = [batch["word"][i].encode("latin-1") for i in at], np.asarray(batch["n"])[at]
                codes = unary(letters(own, size))
                hashes = np.fromiter((hash_of(w) for w in own), np.int64, len(own))
                tree = cells[size]
                home = tree.homes(codes)
                spread = np.array(tree.spread)
                yield _rows(size, home, hashes % spread[home], 0, own, n, np.arange(len(own)))
                for target, kind, less in ((size + 1, 1, 0), (size, 2, 1)):
                    if target not in cells:
                        continue
                    for leaf, chosen in reached(cells[target].root, codes, np.arange(len(own)), 1, less):
                        for part in range(cells[target].spread[leaf.members]):
                            yield _rows(target, leaf.members, part, kind, own, n, chosen)

    return map_batches(words, run, "length int, cell int, part int, kind int, word string, n long")


def hash_of(word: bytes) -> int:
    import zlib

    return zlib.crc32(word)


def _rows(length, cell, part, kind, words, n, chosen) -> dict:
    size = len(chosen)
    return {
        "length": np.full(size, length),
        "cell": np.broadcast_to(cell, size),
        "part": np.broadcast_to(part, size),
        "kind": np.full(size, kind),
        "word": [words[i].decode("latin-1") for i in chosen],
        "n": n[chosen],
    }


def _best(owner: np.ndarray, other: np.ndarray, own: list[bytes], others: list[bytes], n: np.ndarray) -> dict | None:
    """For each word that is near another: how many, and the one of largest ``n``, the first in order of code points."""
    if not len(owner):
        return None
    turn = np.empty(len(others), np.int64)
    turn[sorted(range(len(others)), key=lambda i: (-n[i], others[i]))] = np.arange(len(others))
    order = np.lexsort((turn[other], owner))
    first = np.flatnonzero(np.r_[True, np.diff(owner[order]) != 0])
    near = np.diff(np.r_[first, len(order)])
    best = other[order][first]
    return {
        "word": [own[i].decode("latin-1") for i in owner[order][first]],
        "n_near": near,
        "best_n": n[best],
        "best": [others[i].decode("latin-1") for i in best],
    }


def _searched(dealt: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best`` of each cell's pairs, several rows for a word."""

    def run(batches):
        key, rows = None, {}
        for batch in batches:
            columns = {k: np.asarray(batch[k]) for k in ("length", "cell", "part", "kind", "n")}
            groups = np.stack([columns[k] for k in ("length", "cell", "part", "kind")])
            change = np.flatnonzero((np.diff(groups) != 0).any(0)) + 1
            for a, b in zip(np.r_[0, change], np.r_[change, len(batch["word"])]):
                *now, kind = groups[:, a].tolist()
                if now != key:
                    yield from search(key, rows)
                    key, rows, tree = now, {}, None
                words, n = rows.setdefault(kind, ([], []))
                words += [w.encode("latin-1") for w in batch["word"][a:b]]
                n.append(columns["n"][a:b])
                if kind and len(words) >= QUERIES_AT_ONCE:
                    yield from search(key, rows)
        yield from search(key, rows)

    def search(key, rows):
        """Answer the queries that have come; the words and their tree stay."""
        if key is None or 0 not in rows:
            return
        words, n = rows[0]
        if "tree" not in rows:
            block = letters(words, key[0])
            codes = unary(block)
            rows["tree"] = (build(codes, np.arange(len(codes)), LEAF_WORDS), codes, block, np.concatenate(n))
        tree, codes, block, n = rows["tree"]
        for kind in (1, 2):
            if kind not in rows:
                continue
            asked, times = rows.pop(kind)
            own = letters(asked, key[0] - (kind == 1))
            times = np.concatenate(times)
            q, w = near_pairs(tree, codes, block, unary(own), own)
            sides = [(q, w, asked, words, n)] + [(w, q, words, asked, times)] * (kind == 1)
            yield from filter(None, (_best(*side) for side in sides))

    order = ("length", "cell", "part", "kind")
    dealt = dealt.repartition("length", "cell", "part").sortWithinPartitions(*order)
    return map_batches(dealt, run, "word string, n_near long, best_n long, best string")


def _roots(words: DataFrame) -> DataFrame:
    """``word, root`` of the words that have a form, by doubling the steps towards the root."""
    now = checkpointed(words.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = checkpointed(now.join(further, "root", "left").select("word", "root", "next"))
        if moved.where(F.col("next").isNotNull()).isEmpty():
            return now
        now = moved.select("word", F.coalesce("next", "root").alias("root"))


def _whole(n: Column, best_n: Column, ratio: int) -> Column:
    return best_n >= ratio * n


def group_variants(
    docs: DataFrame,
    least_letters: int = 6,
    least_times: int = 5,
    every: int = 199,
    ratio: int = 5,
    cell_words: int = CELL_WORDS,
    sample_words: int = SAMPLE_WORDS,
) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word.

    Two words are near if one inserted, deleted or replaced letter tells them apart. A word's form is its near word of largest ``n``, of several
    the first in the order of code points, if that ``n`` is at least ``ratio`` times its own; ``root`` is where the forms lead. A null
    or empty text has no words, a null id is an empty one in the checksum, repeated rows count again, and words may be of any length. An
    empty table gives no rows.
    """
    words = checkpointed(
        word_counts(docs, least_letters, least_times, every).withColumn("length", F.length("word"))
    )
    found = _searched(_dealt(words, _cells(words, sample_words, cell_words)))
    near = found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best"))).alias("best")
    )
    is_form = F.coalesce(_whole(F.col("n"), -F.col("best.less"), ratio), F.lit(False))
    joined = checkpointed(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(is_form, F.col("best.best")).alias("form"),
            F.when(is_form, -F.col("best.less")).alias("form_n"),
        )
    )
    return joined.join(_roots(joined), "word", "left").withColumn("root", F.coalesce("root", "word"))
