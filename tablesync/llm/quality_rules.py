"""Quality rules: document statistics, hard base rules, and boosted trees over the statistics.

The trees are grown on a bounded sample of labelled documents, by histograms of binned values and with the
sign of chosen features held fixed (more repetition never raises a score). For scoring they are
flat numpy arrays of nodes: all documents of a batch go down all trees level by level.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import FIT_ROWS, fit_sample, map_batches, pieces

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30  # per cent of the words
KEEP_AT = 0.3
SYMBOLS = b"#*$%&|<>"  # fixed by the contract
UPPER, DIGITS, PUNCT = bytes(range(65, 91)), b"0123456789", b".,;:!?'\"()-"
CONTINUATION = bytes(range(0x80, 0xC0))

# Inputs of the trees and the sign their effect must have: 1 never lowers, -1 never raises, 0 free.
FEATURES = {
    "log_words": 0,
    "word_length": 0,
    "symbols_per_word": -1,
    "duplicate_lines": -1,
    "repeated_words": -1,
    "distinct_words": 0,
    "upper": 0,
    "digits": 0,
    "punctuation": 0,
    "words_per_line": 0,
    "top_word": -1,
}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

# Odd multipliers of a window's words, from a fixed seed.
_ODD = np.random.default_rng(9).integers(0, 2**63, WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def repeated_words(codes: np.ndarray) -> int:
    """How many words lie in windows of eight words that are found twice or more."""
    n = len(codes) - WINDOW + 1
    if n < 2:
        return 0
    x = codes.astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for j, odd in enumerate(_ODD):
        part = (x[j : j + n] + np.uint64(1)) * odd
        key = (key ^ part ^ (part >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(n + WINDOW, np.int64)
    starts = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    np.add.at(twice, starts, 1)
    np.add.at(twice, starts + WINDOW, -1)
    return int((np.cumsum(twice) > 0).sum())


def statistics(data: bytes | None) -> tuple[tuple[int, ...], list[float]]:
    """The base counts of a text and the inputs of the trees."""
    data = data or b""
    words = data.split()
    n = len(words)
    codes: dict[bytes, int] = {}
    ids = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, n)
    joined = b"".join(words)
    word_chars = len(joined) - (0 if joined.isascii() else len(joined) - len(joined.translate(None, CONTINUATION)))
    n_symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [line for line in data.split(b"\n") if line.strip()]
    n_dup = len(lines) - len(set(lines))
    n_repeat = repeated_words(ids)
    some, chars = max(n, 1), max(word_chars, 1)
    of = lambda kind: len(joined) - len(joined.translate(None, kind))
    inputs = [
        float(np.log1p(n)),
        word_chars / some,
        n_symbols / some,
        n_dup / max(len(lines), 1),
        n_repeat / some,
        len(codes) / some,
        of(UPPER) / chars,
        of(DIGITS) / chars,
        of(PUNCT) / chars,
        n / max(len(lines), 1),
        (np.bincount(ids).max() / n) if n else 0.0,
    ]
    return (n, word_chars, n_symbols, n_dup, n_repeat), inputs


@dataclass
class Trees:
    """Boosted trees as flat arrays, one row for each tree; a leaf points to itself."""

    start: float
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))[:, None]
        trees = np.arange(len(self.feature))[None, :]
        at = np.zeros((len(x), len(self.feature)), np.int64)
        for _ in range(self.depth):
            goes = x[rows, self.feature[trees, at]] <= self.threshold[trees, at]
            at = np.where(goes, self.left[trees, at], self.right[trees, at])
        return self.start + self.value[trees, at].sum(1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def grow(
    x: np.ndarray,
    y: np.ndarray,
    signs: list[int],
    trees: int = 60,
    depth: int = 3,
    bins: int = 64,
    rate: float = 0.2,
    l2: float = 1.0,
    least: int = 5,
    balanced: bool = True,
) -> Trees:
    """Boost trees on the logistic loss; ``balanced`` makes the two classes weigh the same.

    A split on a feature with a sign needs child values in that order, and both subtrees keep to
    their side of the midpoint between them.
    """
    n, k = x.shape
    size = 2 ** (depth + 1) - 1
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(k)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(k)], 1)
    positive = y.sum()
    weight = np.where(y == 1, n / (2 * max(positive, 1)), n / (2 * max(n - positive, 1))) if balanced else np.ones(n)
    out = Trees(
        0.0,
        np.zeros((trees, size), np.int64),
        np.zeros((trees, size)),
        np.tile(np.arange(size), (trees, 1)),
        np.tile(np.arange(size), (trees, 1)),
        np.zeros((trees, size)),
        depth,
    )
    margin = np.zeros(n)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = weight * (y - p), weight * p * (1 - p)
        todo = [(0, np.arange(n), 0, -np.inf, np.inf)]
        while todo:
            node, rows, level, low, high = todo.pop()
            best = None
            if level < depth and len(rows) >= 2 * least:
                best = _split(binned[rows], g[rows], h[rows], edges, signs, l2, least, low, high)
            if best is None:
                value = np.clip(g[rows].sum() / (h[rows].sum() + l2), low, high) if len(rows) else 0.0
                out.value[t, node] = rate * value
                margin[rows] += rate * value
                continue
            f, cut, vl, vr = best
            out.feature[t, node], out.threshold[t, node] = f, edges[f][cut]
            out.left[t, node], out.right[t, node] = 2 * node + 1, 2 * node + 2
            mid = (vl + vr) / 2
            bounds = {1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid))}.get(signs[f], ((low, high),) * 2)
            goes = binned[rows, f] <= cut
            todo.append((2 * node + 1, rows[goes], level + 1, *bounds[0]))
            todo.append((2 * node + 2, rows[~goes], level + 1, *bounds[1]))
    return out


def _split(binned, g, h, edges, signs, l2, least, low, high):
    best, gain_of_best = None, 1e-6
    whole = g.sum() ** 2 / (h.sum() + l2)
    for f, cuts in enumerate(edges):
        if not len(cuts):
            continue
        m = len(cuts) + 1
        gl = np.cumsum(np.bincount(binned[:, f], g, m))[:-1]
        hl = np.cumsum(np.bincount(binned[:, f], h, m))[:-1]
        nl = np.cumsum(np.bincount(binned[:, f], minlength=m))[:-1]
        gr, hr = g.sum() - gl, h.sum() - hl
        vl, vr = np.clip(gl / (hl + l2), low, high), np.clip(gr / (hr + l2), low, high)
        gain = gl**2 / (hl + l2) + gr**2 / (hr + l2) - whole
        allowed = (nl >= least) & (len(g) - nl >= least) & (signs[f] * (vr - vl) >= 0)
        gain = np.where(allowed, gain, -np.inf)
        cut = int(np.argmax(gain))
        if gain[cut] > gain_of_best:
            best, gain_of_best = (f, cut, float(vl[cut]), float(vr[cut])), gain[cut]
    return best


def fit_rules(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Trees | None:
    """Trees for ``labels.quality`` from at most ``rows`` documents outside the held-out fold.

    None where there is no label to learn from or only one class.
    """
    names = list(FEATURES)

    def run(batches):
        for batch in pieces(batches):
            found = np.array([statistics(t)[1] for t in batch["text"]])
            yield {"label": batch["label"], "inputs": list(found)}

    sample = map_batches(fit_sample(docs, labels, "quality", rows), run, "label int, inputs array<double>").collect()
    y = np.array([r.label for r in sample])
    if len(set(y.tolist())) < 2:
        return None
    x = np.array([r.inputs for r in sample])
    order = np.lexsort([*x.T, y])  # the same trees whatever order the rows came in
    return grow(x[order], y[order].astype(float), [FEATURES[n] for n in names])


def apply_rules(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, keep_at: float = KEEP_AT) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``kept`` and ``score`` of every document.

    ``base_failed``: fewer than 20 words, or more than 30 per cent of the words in windows of
    eight words that are found twice or more. ``kept`` is false then, else it says
    whether the trees give at least ``keep_at``. Without labels of both classes every score is
    0.5. A null text counts as empty; repeated rows are scored alike.
    """
    trees = fit_rules(docs, labels, rows)
    sent = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches):
        trees = sent.value
        for batch in pieces(batches):
            found = [statistics(t) for t in batch["text"]]
            base = np.array([f[0] for f in found], np.int64)
            x = np.array([f[1] for f in found])
            score = trees.score(x) if trees else np.full(len(x), 0.5)
            failed = (base[:, 0] < MIN_WORDS) | (100 * base[:, 4] > MAX_REPEATED * base[:, 0])
            yield {
                "doc_id": batch["doc_id"],
                **{n: base[:, i] for i, n in enumerate(BASE)},
                "base_failed": failed,
                "kept": ~failed & (score >= keep_at),
                "score": score,
            }

    schema = "doc_id long, " + ", ".join(f"{n} long" for n in BASE) + ", base_failed boolean, kept boolean, score double"
    return map_batches(docs.select("doc_id", F.col("text").cast("binary").alias("text")), run, schema)
