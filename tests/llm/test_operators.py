"""The operators on odd documents against brute force."""

import gc
import hashlib
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from cases import texts
from pyspark.sql import functions as F

from tablesync.llm import (
    line_dedup,
    mixing,
    ngram_join,
    packing,
    quality_net,
    quality_rules,
    quotes,
    span_dedup,
    toxicity,
    winnowing,
    words,
)


def bag(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def plain(rows):
    return [(r[0], r[1]) for r in rows]


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80), (2, 50)])
def test_ngram_join(odd, odd_rows, width, percent):
    found = bag(ngram_join.ngram_join(odd, width, percent), "doc_id", "n_shingles", "component_id", "n_links")
    assert found == Counter(brute.joined(plain(odd_rows), width, percent))


@pytest.mark.parametrize("run, width, percent", [(ngram_join.ngram_join, 3, 90), (ngram_join.keep_one, 5, 80)])
def test_ngram_join_counts_the_tokens_of_all_documents(spark, monkeypatch, run, width, percent):
    monkeypatch.setattr(ngram_join, "SAMPLE_TOKENS", 1, raising=False)
    monkeypatch.setattr(ngram_join, "COUNTED_AT_ONCE", 1000, raising=False)
    common = " ".join(f"c{k}" for k in range(40))
    texts = [common + "".join(f" w{(i * k) % 97}" for k in range(1, 60)) for i in range(300)]
    seen, postings = [], ngram_join._postings

    def spied(docs, width, percent, frequency, *rest):
        seen.append(frequency.value)
        return postings(docs, width, percent, frequency, *rest)

    monkeypatch.setattr(ngram_join, "_postings", spied)
    run(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1))
    hashes, counts = ngram_join.WordHashes(), np.zeros(1 << ngram_join.TABLE_BITS, np.int64)
    for text in texts:
        tokens = ngram_join.shingles(text.encode(), width, hashes)
        counts[tokens[ngram_join.leading(tokens, percent)] >> np.uint64(64 - ngram_join.TABLE_BITS)] += 1
    assert counts.max() > 255 and all((rarity == np.frexp(counts.astype(float))[1]).all() for rarity in seen)


def test_ngram_join_long_lists_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LONG_LIST", 3)
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 4)
    base = [f"w{i}" for i in range(60)]
    docs = []
    for i in range(40):
        own = list(base)
        for k in range(i % 4):
            own[(7 * i + 13 * k) % 60] = f"new{i}x{k}"
        docs.append((i, " ".join(own)))
    docs += [(100 + i, " ".join(f"o{i}p{k}" for k in range(30))) for i in range(10)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = bag(ngram_join.ngram_join(df, 3, 80), "doc_id", "n_shingles", "component_id", "n_links")
    assert found == Counter(brute.joined(docs, 3, 80))


def test_ngram_join_empty_blocks(spark, monkeypatch):
    # More blocks than the classes of a component fill.
    monkeypatch.setattr(ngram_join, "BLOCK_TOKENS", 30)
    docs = []
    for i in range(12):
        for k in range(2 + i % 2):
            docs.append((10 * i + k, " ".join([*(f"b{i}w{x}" for x in range(60)), *(["end"] * k)])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = bag(ngram_join.ngram_join(df, 3, 80), "doc_id", "n_shingles", "component_id", "n_links")
    assert found == Counter(brute.joined(docs, 3, 80))


def test_ngram_join_sends_each_class_once(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 4)
    sent, hint = [], F.broadcast
    monkeypatch.setattr(F, "broadcast", lambda df: sent.append(df.count()) or hint(df))
    docs = [(i, " ".join(f"w{k}" if k != i else f"new{i}" for k in range(60))) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = bag(ngram_join.ngram_join(df, 3, 80), "doc_id", "n_shingles", "component_id", "n_links")
    assert found == Counter(brute.joined(docs, 3, 80))
    assert sent and max(sent) <= 40


@pytest.mark.parametrize("long", [0, 5, 1000])
def test_trees_join_all_that_may_be_alike(monkeypatch, long):
    monkeypatch.setattr(ngram_join, "LONG_LIST", long)
    rng = np.random.default_rng(long)
    sets = []
    for _ in range(30):
        base = rng.integers(0, 2**63, rng.integers(3, 60), dtype=np.uint64)
        sets += [np.unique(np.r_[base[rng.random(len(base)) < 0.95], base[:1], rng.integers(0, 2**63, 1, dtype=np.uint64)]) for _ in range(4)]
    size = len(sets)
    columns = {
        "g": np.zeros(size, np.int64), "r": np.zeros(size, np.int64), "token": np.sort(rng.integers(0, 4, size)),
        "c": np.arange(size), "n": np.array([len(s) for s in sets]), "place": np.array([rng.integers(0, 1 + len(s) // 9) for s in sets]),
    }
    marks = [ngram_join.signature(s, 80) for s in sets]
    lists = ngram_join.Lists(columns, marks, 80)
    root, c = lists.trees()
    up = list(range(size))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    n, place = lists.columns["n"], lists.columns["place"]
    for i in range(size):
        for j in range(i):
            a, b = sets[c[i]], sets[c[j]]
            differ = ngram_join.Signatures([marks[c[i]], marks[c[j]]]).differ(0, np.array([1]))[0]
            assert differ <= len(np.setxor1d(a, b))
            most = min(n[i] - place[i], n[j] - place[j], (n[i] + n[j] - differ) / 2)
            if lists.of[i] == lists.of[j] and 100 * most >= 80 * (n[i] + n[j] - most):
                up[top(i)] = top(j)
    assert [top(i) == top(j) for i in range(size) for j in range(i)] == [root[i] == root[j] for i in range(size) for j in range(i)]


def test_signatures_fold_to_the_smaller_width():
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (5, 300, 900, 4000, 20_000)]
    marks = [ngram_join.signature(s, 90) for s in sets]
    assert len({len(m) for m in marks}) > 3
    every = ngram_join.Signatures(marks)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            bits = 8 * min(len(marks[i]), len(marks[j]))
            odd = [np.bincount((words.mixed(s, 99) >> np.uint64(32)).astype(np.int64) % bits, minlength=bits) & 1 for s in (a, b)]
            assert every.differ(i, np.array([j]))[0] == (odd[0] != odd[1]).sum() <= len(np.setxor1d(a, b))


def test_keep_one_of_odd_columns(spark):
    rows = [(i % 4, "same words in every row of it", {"k": i % 2}, (i % 2,)) for i in range(8)] + [(9, None, None, None)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, tags map<string,int>, `odd name` struct<`a b`: int>")
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns
    assert Counter(map(str, kept.collect())) == Counter(map(str, spark.createDataFrame([rows[0], rows[-1]], df.schema).collect()))


def test_keep_one(odd, odd_rows):
    kept = ngram_join.keep_one(odd)
    unique = [tuple(r) for r in dict.fromkeys(odd_rows)]
    low = {d: c for d, _, c, _ in brute.joined(plain(odd_rows), 5, 80)}
    assert Counter(map(tuple, kept.collect())) == Counter(r for r in unique if low[r[0]] == r[0])
    assert kept.columns == odd.columns


def test_word_hashes(monkeypatch):
    text = " ".join(t or "" for t in texts()).encode()
    whole = words.WordHashes()(text)
    assert len(whole) == len(text.split()) and len(set(whole.tolist())) == len(set(text.split()))
    same = {}
    assert all(same.setdefault(w, h) == h for w, h in zip(text.split(), whole.tolist()))
    monkeypatch.setattr(words, "_PIECE", 40)
    assert (words.WordHashes()(text) == whole).all()
    assert [len(words.WordHashes()(t)) for t in (b"", b" \n\t", b"x")] == [0, 0, 1]


def test_prefixes_of_every_order_meet():
    rng = np.random.default_rng(1)
    rarity = rng.integers(0, 5, 1 << ngram_join.TABLE_BITS, dtype=np.uint8)
    for _ in range(50):
        a = np.unique(rng.integers(0, 2**63, 40, dtype=np.uint64))
        b = np.unique(np.r_[a[rng.permutation(len(a))[:37]], rng.integers(0, 2**63, 1, dtype=np.uint64)])
        if 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b)):
            for r in range(3):
                assert len(np.intersect1d(*(ngram_join.prefix(x, rarity, r, 80) for x in (a, b))))


def test_packing_round_trip(odd, odd_rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    want = Counter()
    for doc_id, text, *_ in odd_rows:
        want[doc_id, np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4").tobytes()] += 1
    ids = {k[0]: k[1] for k in want}
    rows = packing.pack(odd, block_tokens=3000).toPandas()
    assert set(rows.doc_id) == set(ids)
    times = Counter(k[0] for k in want.elements())
    for doc_id, own in rows.groupby("doc_id"):
        data = ids[doc_id]
        assert (own.doc_tokens == len(data) // 4).all()
        covered = np.zeros(len(data) // 4, int)
        for p in own.itertuples():
            covered[p.start : p.start + p.length] += 1
            assert p.ids_crc32 == zlib.crc32(data[4 * p.start : 4 * (p.start + p.length)])
        assert (covered == times[doc_id]).all()
    sizes = rows.groupby("sequence_id").length.sum()
    assert ((sizes == 2048) | (sizes & (sizes - 1) == 0)).all() and sizes.max() <= 2048
    for _, own in rows.sort_values("offset").groupby("sequence_id"):
        assert (own.offset == np.r_[0, np.cumsum(own.length)[:-1]]).all()


def test_encoder_goes_at_once():
    """A task's encoder is not left to the garbage collector, which sees little of its memory and so comes late."""
    gc.collect()
    gc.disable()
    try:
        encode = packing.Encoder(packing.tokenizer_path())
        encode("some Words, of all kinds: 12 \u00e9t\u00e9 \u4e2d\u6587")
        del encode
        assert gc.collect() == 0
    finally:
        gc.enable()


def test_encoder_remembers_little(monkeypatch):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.tokenizer_path())
    monkeypatch.setattr(packing, "KEPT_WORDS", 5)
    encode = packing.Encoder(packing.tokenizer_path())
    for text in [*texts(), "x" * 500 + " one two three four five six seven  one", "ab" * 40 + ". eight"]:
        text = text or ""
        assert np.frombuffer(encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
        assert len(encode.words) <= 5 and all(len(w) <= packing.KEPT_LENGTH for w in encode.words)


def test_lines_are_dropped_in_one_worker(odd):
    for df in (line_dedup.drop_lines(odd, 2), line_dedup.line_report(odd, 2)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_packing_plan_uses_whole_windows():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 50, 800):
        lengths = [int(x) for x in np.minimum(rng.lognormal(6, 1.2, n), 2047)]
        plan = packing.plan(lengths)
        sizes = [sum(k for _, _, k in s) for s in plan]
        assert sum(sizes) == sum(lengths)
        assert all(s == 2048 or s & (s - 1) == 0 for s in sizes)
        got = Counter()
        for s in plan:
            for i, _, k in s:
                got[i] += k
        assert got == Counter({i: x for i, x in enumerate(lengths) if x})


def test_nonnegative_solution():
    use = packing.combinations(8)
    target = use.T @ np.arange(len(use), dtype=float)
    x = packing.solve(use, target, 5000)
    assert (x >= 0).all() and np.abs(x @ use - target).max() < 2


def test_winnowing(odd, odd_rows):
    rows = list(dict.fromkeys(plain(odd_rows)))
    found = {r.doc_id: r for r in winnowing.fingerprints(odd).collect()}
    chosen = lambda t: brute.winnow(t, 4, 8, winnowing.PRIME, winnowing.BASE)
    shown = lambda f: " ".join(f"{h:X}:{p}" for h, p in f)

    def like(a, b):
        a, b = {h for h, _ in a}, {h for h, _ in b}
        return len(a & b) / len(a | b) if a | b else 1.0

    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        m = len(text) // 4
        edited = text[: len(text) - m] + after[:m]
        r = found[doc_id]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        if text.lower().isascii():
            assert r.fingerprint == shown(chosen(text))
        if (text + edited + after).isascii():
            assert r.near_edited == pytest.approx(like(chosen(text), chosen(edited)))
            assert r.near_next == pytest.approx(like(chosen(text), chosen(after)))


def test_winnowing_guarantee():
    # Any shared run of gram + window - 1 words leaves a common hash.
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    shared = " ".join(f"s{i}" for i in range(11))
    f, g = (brute.winnow(x, 4, 8, winnowing.PRIME, winnowing.BASE) for x in (f"{a} {shared}", f"{shared} {b}"))
    assert {h for h, _ in f} & {h for h, _ in g}


@pytest.mark.parametrize("options", [{}, {"round_bytes": 1, "shard_keys": 1}])
def test_lines(odd, odd_rows, options):
    want = Counter(
        (d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
        for d, lines, kept in brute.kept_lines(plain(odd_rows), 3)
    )
    assert bag(line_dedup.line_report(odd, 3, **options), "doc_id", "n_lines", "n_dropped", "kept_sha256") == want


def test_drop_lines_keeps_columns(odd, odd_rows):
    kept = {d: "\n".join(k) for d, _, k in brute.kept_lines(plain(odd_rows), 3)}
    want = Counter((r[0], None if r[1] is None else kept[r[0]], *r[2:4], None if r[1] is None else len(kept[r[0]]), *r[5:]) for r in odd_rows)
    out = line_dedup.drop_lines(odd, 3)
    assert out.schema == odd.schema and Counter(map(tuple, out.collect())) == want


def test_perfect_hash():
    for n in (0, 1, 5, 5000):
        keys = line_dedup.hashes([f"k{i}".encode() for i in range(n)])
        table = line_dedup.PerfectHash.from_bytes(line_dedup.PerfectHash.build(keys, np.arange(n) + 10).to_bytes())
        assert sorted(table.slots(keys).tolist()) == list(range(n))
        assert table.count(keys).tolist() == list(range(10, n + 10))
        other = line_dedup.hashes([f"o{i}".encode() for i in range(1000)])
        assert table.count(other).sum() == 0


def test_quality_rules(odd, odd_rows, no_labels):
    found = quality_rules.apply_rules(odd, no_labels)
    want = Counter()
    for doc_id, text, *_ in odd_rows:
        counts = brute.base_counts(text)
        failed = counts[0] < 20 or 100 * counts[4] > 30 * counts[0]
        want[(doc_id, *counts, failed, not failed)] += 1
    assert bag(found, "doc_id", *quality_rules.BASE, "base_failed", "kept") == want


def test_trees_learn_and_keep_signs():
    rng = np.random.default_rng(4)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (rng.random(3000) < 0.1)).astype(float)
    trees = quality_rules.grow(x, y, [1, -1, 0], trees=30)
    assert ((trees.score(x) > 0.5) == (x[:, 0] > 0.5)).mean() > 0.97
    step = np.linspace(0, 1, 50)
    for other in rng.random((20, 2)):
        up = trees.margin(np.c_[step, np.tile(other, (50, 1))])
        down = trees.margin(np.c_[np.full(50, other[0]), step, np.full(50, other[1])])
        assert (np.diff(up) >= -1e-9).all() and (np.diff(down) <= 1e-9).all()


def test_spans(odd, odd_rows):
    rows = list(dict.fromkeys(plain(odd_rows)))
    found = bag(span_dedup.span_report(odd).distinct(), "doc_id", "n_sentences", "n_removed", "kept_sha256")
    assert found == Counter(brute.spans(rows, 2, 20))
    assert any(r[2] for r in found)


def test_spans_to_the_end_of_a_copied_passage(spark):
    line = lambda p, n: " ".join(f"{p}{i}" for i in range(n)) + ". "
    passage = line("a", 36) + line("b", 10) + line("c", 6)
    docs = [(k, line(f"x{k}", 9) + passage + line(f"y{k}", 30)) for k in range(3)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r.doc_id: (r.n_removed, r.first_ids) for r in span_dedup.span_report(df).collect()}
    assert found == {0: (0, []), 1: (3, [0]), 2: (3, [0])}
    odd = df.selectExpr("*", "named_struct('a b', 1, 'c:d', array(doc_id)) AS `odd name`", "map('k', doc_id) AS tags")
    for out in (span_dedup.drop_spans(odd), line_dedup.drop_lines(odd)):
        assert out.schema == odd.schema and out.count() == 3


def test_drop_toxic_keeps_odd_columns(spark, no_labels):
    df = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string").selectExpr(
        "*", "named_struct('a b', 1, 'c:d', array(doc_id)) AS `odd name`", "map('k', doc_id) AS tags"
    )
    out = toxicity.drop_toxic(df, no_labels)
    assert out.schema == df.schema and sorted(map(str, out.collect())) == sorted(map(str, df.collect()))


def test_drop_spans_keeps_columns(odd):
    out = span_dedup.drop_spans(odd)
    assert out.schema == odd.schema and out.count() == odd.count()
    hashes = {r.doc_id: r.kept_sha256 for r in span_dedup.span_report(odd).collect()}
    for r in out.collect():
        assert hashes[r.doc_id] == hashlib.sha256((r.text or "").encode()).hexdigest()


WEIGHTS = {"lang": {"en": 5, "de": 2, "fr": 0}, "source": {"src0": 3}}


def levels():
    return {"lang": F.col("lang"), "source": F.col("source")}


@pytest.mark.parametrize("share, epochs", [(0.6, 2), (0.05, 1), (9.0, 3)])
def test_mixing(odd, odd_rows, share, epochs):
    want = brute.mixed(odd_rows, WEIGHTS, epochs, share, 9)
    mixed = mixing.mix(odd, levels(), WEIGHTS, lambda t: t * share, epochs, seed=9)
    assert bag(mixed, "doc_id", "__times") == want
    assert mixing.taken(odd, levels=levels(), weights=WEIGHTS, total=lambda t: t * share, epochs=epochs, seed=9).count() == sum(
        k[1] * n for k, n in want.items()
    )


def test_mixing_spends_the_budget_below_zero_weights(spark):
    rows = [(k, "a b c", "en" if k % 2 else "de", f"s{k % 4}") for k in range(80)]
    rows += [(100 + k, None if k else "", "it", "s1") for k in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    weights = {"lang": {}, "source": {"s3": 0}}
    mixed = mixing.mix(df, levels(), weights, lambda t: t * 0 + 150, 2, seed=3)
    assert bag(mixed, "doc_id", "__times") == brute.mixed(rows, weights, 2, 150 / 240, 3)
    assert mixed.agg(F.sum(F.col("__tokens") * F.col("__times"))).first()[0] == 150
    # Of a leaf without tokens every document is there once; those of weight 0 are not taken, and not lost.
    assert mixed.where("lang = 'it' and __times = 1").count() == 3 and mixed.where("source = 's3' and __times = 0").count() == 20
    assert mixing.mix(df.limit(0), levels(), weights, lambda t: t, 2).collect() == []


MAIL = [
    (1, 0, "user", "Hello there\nsecond line"),
    (1, 1, "assistant", "> Hello there\nMy answer"),
    (1, 2, "user", "> >  HELLO   there\n> My answer\nThanks"),
    (1, 3, "user", "> second line\nAnother thing"),
    (1, 4, "user", "> never said\n>\nAlone"),
    (2, 0, "user", "> My answer\nfrom elsewhere"),
    (2, 1, None, None),
    (2, 1, "user", ""),
    (None, 0, "user", "lost"),
]


def test_quotes(spark):
    df = spark.createDataFrame(MAIL, "conv_id long, turn long, role string, text string").withColumn("key", F.lit(1))
    found = {(r.conv_id, r.turn, r.role): r for r in quotes.conversations(df).collect()}
    assert len(found) == 8
    reply = {k[:2]: (r.reply_to, r.thread, r.depth, r.place) for k, r in found.items() if k[2]}
    assert reply == {
        (1, 0): (None, 0, 0, 1),
        (1, 1): (0, 0, 1, 2),
        (1, 2): (1, 0, 2, 3),
        (1, 3): (0, 0, 1, 4),
        (1, 4): (None, 4, 0, 1),
        (2, 0): (None, 0, 0, 1),
        (2, 1): (None, 1, 0, 2),
    }
    assert found[1, 2, "user"].said == "Thanks" and found[1, 2, "user"].n_linked == 2
    assert found[1, 4, "user"].n_quoted == 1 and found[1, 4, "user"].n_linked == 0
    assert found[2, 0, "user"].n_linked == 1
    assert [(r.origin_conv, r.origin_turn) for r in (found[2, 0, "user"], found[1, 1, "assistant"])] == [(1, 1), (None, None)]


def test_quotes_find_another_conversation_behind_the_own_later_turn(spark):
    rows = [(1, 0, "user", "> late line\nfirst"), (1, 1, "user", "late line"), (2, 5, "user", "late line"), (3, 0, "user", "Late  LINE")]
    found = {(r.conv_id, r.turn): r for r in quotes.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert (found[1, 0].n_linked, found[1, 0].origin_conv, found[1, 0].origin_turn, found[1, 0].reply_to) == (1, 2, 5, None)


def test_scores_without_labels(odd, none, no_labels):
    for df, n in ((odd, odd.count()), (none, 0)):
        assert quality_net.score_quality(df, no_labels).where("score = 0.5 and predicted = 1").count() == n
        assert toxicity.score_toxicity(df, no_labels).where("score = 0 and predicted = 0").count() == n
    assert toxicity.drop_toxic(odd, no_labels).schema == odd.schema


def test_toxic_words_of_ordinary_syllables(spark):
    # Every piece of five bytes of the toxic words is in ordinary words too.
    rng = np.random.default_rng(5)
    syllables = ["ka", "lo", "me", "ru"]
    make = lambda n: "".join(syllables[k] for k in rng.integers(0, 4, n))
    toxic = ["kalomerukalo", "rumelokameru", "lokarumelome", "meruloka" * 2]
    docs, labels = [], []
    for i in range(600):
        own = [make(n) for n in rng.integers(3, 6, 60)]
        if i % 5 == 0:
            for k in range(0, 60, 6):
                own[k] = toxic[rng.integers(0, 4)]
        docs.append((i, " ".join(own)))
        labels.append((i, 1, int(i % 5 == 0)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    assert all(f" {w} ".encode() in model.toxic for w in toxic)
    rows = toxicity.score_toxicity(docs, labels).where("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted for r in rows if r.toxic) >= 0.8 * sum(r.toxic for r in rows)


def test_empty_tables(none, no_labels, spark):
    assert ngram_join.ngram_join(none).count() == 0 and ngram_join.keep_one(none).count() == 0
    assert packing.pack(none).count() == 0
    assert winnowing.fingerprints(none).count() == 0
    assert line_dedup.line_report(none).count() == 0 and line_dedup.drop_lines(none).count() == 0
    assert span_dedup.span_report(none).count() == 0
    assert quality_rules.apply_rules(none, no_labels).count() == 0
    levels = {"lang": F.col("lang"), "source": F.col("source")}
    assert mixing.mix(none, levels, WEIGHTS, lambda t: t, 2).count() == 0
    mail = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert quotes.conversations(mail).count() == 0


def test_null_ids(spark):
    text = "one two three four five six seven eight"
    df = spark.createDataFrame([(None, text), (3, text), (None, None)], "doc_id long, text string")
    assert bag(ngram_join.ngram_join(df), "doc_id", "component_id", "n_links") == Counter({(None, 3, 1): 1, (3, 3, 1): 1, (None, None, 0): 1})
    assert winnowing.fingerprints(df).count() == 3
    assert packing.pack(df).count() >= 3
    assert line_dedup.line_report(df).count() == 3
    assert span_dedup.span_report(df).count() == 3
