"""Ranked search, spelling variants and exact copies on odd documents against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest

from tablesync.llm import exact_dedup, ranked_search, spelling

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(brute.ascii_lower(text or ""))


def ranked(docs, items, k):
    """``item_id, rank, doc_id, score`` by scoring every document."""
    counts = [(d, Counter(terms(t))) for d, t in docs]
    n_docs = sum(bool(c) for _, c in counts)
    n_all = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        found = []
        for d, c in counts:
            score = 0
            for t in terms(text):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 100 - 25 + 25 * sum(c.values()) * n_docs // n_all
                    score += w * (1000000000 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0 and d is not None:
                found.append((-score, d))
        out += [(item, i + 1, d, -s) for i, (s, d) in enumerate(sorted(found)[:k])]
    return out


def items_of(rows):
    words = [w for _, t, *_ in rows for w in terms(t)][::37]
    own = [(i, " ".join(words[7 * i : 7 * i + 1 + i])) for i in range(12)]
    return own + [(20, None), (21, ""), (22, "unheardof"), (23, "SHARED shared Line été 42"), own[3], (3, "shared"), (None, "line")]


@pytest.mark.parametrize("options", [{}, {"segment_postings": 40, "k": 3}, {"block_bytes": 60, "k": 50}])
def test_ranked_search(spark, odd, odd_rows, options):
    items = items_of(odd_rows)
    table = spark.createDataFrame([(*i, 5) for i in items], "item_id long, text string, rank int")
    found = ranked_search.ranked_search(odd, table, **options).collect()
    assert Counter(map(tuple, found)) == Counter(ranked([r[:2] for r in odd_rows], items, options.get("k", 20)))


def test_ranked_search_ties_and_nulls(spark):
    docs = [(None, "red green"), (9, "red green"), (4, "red green"), (4, "red green"), (1, None), (2, ""), (3, "...")]
    docs += [(50 + i, "blue " * 3) for i in range(40)]
    docs += [(100 + i, "other words here") for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    items = [("a", "blue"), ("b", "red green green"), ("c", "blue red")]
    found = ranked_search.ranked_search(df, spark.createDataFrame(items, "item_id string, text string"), segment_postings=7)
    assert Counter(map(tuple, found.collect())) == Counter(ranked(docs, items, 20))


def test_ranked_search_empty(spark, none, odd):
    items = spark.createDataFrame([(1, "shared line")], "item_id long, text string")
    assert ranked_search.ranked_search(none, items).collect() == []
    assert ranked_search.ranked_search(odd, items.limit(0)).collect() == []
    assert ranked_search.ranked_search(odd, items.selectExpr("item_id", "cast(null as string) as text")).columns == [
        "item_id", "rank", "doc_id", "score",
    ]


def _segment(rng, docs, n_terms):
    lengths = rng.integers(1, 6, docs)
    own = [np.sort(rng.choice(n_terms, n, replace=False)) for n in lengths]
    return ranked_search.Segment(
        np.arange(docs), lengths, np.concatenate(own), rng.integers(1, 9, lengths.sum()), rng.integers(75, 200, docs), n_terms
    )


def test_best_positions_stop_early():
    rng = np.random.default_rng(3)
    segment = _segment(rng, 20_000, 6)
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    asked, weights = np.array([0, 3]), np.array([900, 20])
    scores, ids, looked_up = segment.search(asked, weights, 20, none)
    every = np.zeros(20_000, np.int64)
    for t, w in zip(asked, weights):
        a, b = segment.list_starts[t : t + 2]
        np.add.at(every, segment.list_docs[a:b], w * segment.list_impacts[a:b])
    order = np.lexsort((np.arange(20_000), -every))[:20]
    assert (ids == order).all() and (scores == every[order]).all()
    assert looked_up < (every > 0).sum() / 3
    assert (segment.slots == -1).all()


def counted(docs, letters=6, times=5, every=199):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = brute.ascii_lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= letters and n >= times}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(words, ratio=5):
    near = defaultdict(list)
    for a in words:
        near[a] = [b for b in words if abs(len(a) - len(b)) < 2 and one_edit(a, b)]
    form = {}
    for a, n in words.items():
        best = min(near[a], key=lambda b: (-words[b], b), default=None)
        if best is not None and words[best] >= ratio * n:
            form[a] = best
    out = []
    for a, n in words.items():
        root = a
        while root in form:
            root = form[root]
        out.append((a, n, len(near[a]), form.get(a), words.get(form.get(a)), root))
    return out


COLUMNS = ("word", "n", "n_near", "form", "form_n", "root")


def misspelt(rng):
    """Words with chains of variants, anagrams, repeated letters, accents, and one of 300 letters."""
    base = ["".join(rng.choice(list("abcdeéÿ")) for _ in range(rng.integers(6, 9))) for _ in range(25)]
    base += ["aaaaaaaa", "aaaaaaa", "aaaaaab", "abcdefg", "gfedcba", "abcdegf", "x" * 300, "x" * 299, "x" * 300 + "y"]
    out = Counter()
    for word in base:
        n = 400
        while n >= 2:
            out[word] += n
            at, n = int(rng.integers(len(word))), n // 6
            word = word[:at] + str(rng.choice(["", "é", "b", word[at] + "a"])) + word[at + 1 :]
    return out


@pytest.mark.parametrize("options", [{}, {"cell_words": 5, "sample_words": 40}, {"cell_words": 3}])
def test_spelling(spark, monkeypatch, options):
    monkeypatch.setattr(spelling, "LEAF_WORDS", 4)
    monkeypatch.setattr(spelling, "QUERIES_AT_ONCE", 9)
    words = misspelt(np.random.default_rng(5))
    docs = [(i, f"{w.upper() if i % 3 else w}, " * n + "short") for i, (w, n) in enumerate(words.items())]
    docs += [(None, "wordswithnullid " * 7), (1, None), (2, ""), (3, "12 !?")]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, word string").repartition(4)
    found = spelling.group_variants(df, every=3, **options).select(*COLUMNS).collect()
    assert Counter(map(tuple, found)) == Counter(variants(counted(docs, every=3)))


def test_spelling_odd(odd, odd_rows, none):
    found = spelling.group_variants(odd, least_letters=4, least_times=2).select(*COLUMNS).collect()
    assert Counter(map(tuple, found)) == Counter(variants(counted([r[:2] for r in odd_rows], 4, 2)))
    assert spelling.group_variants(none).collect() == []


def copies(docs):
    groups = defaultdict(list)
    for i, (doc_id, text) in enumerate(docs):
        groups[text or ""].append((-1 if doc_id is None else doc_id, i))
    out = Counter()
    for text, own in groups.items():
        top = max(own)
        for doc_id, i in own:
            ids = [None if x < 0 else x for x in (doc_id, top[0])]
            out[*ids, len(own), (doc_id, i) == top, hashlib.sha256(text.encode()).hexdigest()] += 1
    return out


def written(df, folder):
    df.coalesce(2).write.mode("append").parquet(str(folder))
    return str(folder)


@pytest.mark.parametrize("digest_bytes", [32, 1, 0])
def test_exact_dedup(spark, odd, odd_rows, tmp_path, digest_bytes):
    # With one byte, or none, other texts have the same digest.
    path = written(odd, tmp_path / "docs")
    found = exact_dedup.dedup_report(spark, path, files_per_batch=1, digest_bytes=digest_bytes)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(map(tuple, found.collect())) == copies([r[:2] for r in odd_rows])
    kept = exact_dedup.unique_documents(spark, path, digest_bytes=digest_bytes)
    assert kept.columns == odd.columns and kept.count() == len({r[1] or "" for r in odd_rows})


def test_exact_dedup_goes_on(spark, tmp_path):
    schema, path, state = "doc_id long, text string, _metadata int, __keep int", tmp_path / "docs", str(tmp_path / "state")
    first = [(1, "a", 0, 0), (2, "b", 0, 0), (None, "c", 0, 0), (None, "c", 0, 0)]
    later = [(3, "a", 0, 0), (0, "b", 0, 0), (4, None, 0, 0), (5, "", 0, 0), (5, "", 0, 0)]
    for rows, so_far in ((first, first), (later, first + later)):
        written(spark.createDataFrame(rows, schema), path)
        found = exact_dedup.dedup_report(spark, str(path), state=state)
        assert Counter(map(tuple, found.collect())) == copies([r[:2] for r in so_far])
    assert exact_dedup.unique_documents(spark, str(path), state=state).columns == ["doc_id", "text", "_metadata", "__keep"]
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_exact_dedup_empty(spark, none, tmp_path):
    assert exact_dedup.dedup_report(spark, written(none, tmp_path / "none")).collect() == []
