"""The registered queries on given tables: against SQL, or by held-out accuracy and brute force."""

from collections import Counter

import brute
import pytest
from oracle import bag, connect

import corpus_pipeline
from tablesync.llm import toxicity
from tablesync.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
LABELLED = "/root/testdata/sf0.1"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    df = QUERIES[name](spark, FOLDER)
    left = bag(df.columns, [tuple(r) for r in df.collect()])
    found = connect(FOLDER).execute(ORACLES[name])
    assert left == bag([d[0] for d in found.description], found.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_whole_table(spark, name):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert QUERIES[name](spark, FOLDER).select("doc_id").distinct().count() == documents.count()


@pytest.mark.parametrize("name, label, least", [("op3_quality_net", "quality", 0.97), ("op6_toxicity", "toxic", 0.93)])
def test_held_out(spark, name, label, least):
    labels = spark.read.parquet(f"{LABELLED}/labels.parquet")
    rows = QUERIES[name](spark, LABELLED).where("held_out").join(labels, "doc_id").select("predicted", label).collect()
    assert sum(r[0] == r[1] for r in rows) / len(rows) >= least


def test_rules_held_out(spark):
    labels = spark.read.parquet(f"{LABELLED}/labels.parquet")
    rows = (
        QUERIES["op9_quality_rules"](spark, LABELLED)
        .where("crc32(cast(doc_id as string)) % 5 = 0 and not base_failed")
        .join(labels, "doc_id")
        .select("kept", "quality")
        .collect()
    )
    assert sum(r.kept == (r.quality == 1) for r in rows) / len(rows) >= 0.97


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, found = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        found[name] = ([tuple(r) for r in before.collect()], [tuple(r) for r in docs.collect()])
        if name != "packing":
            assert docs.columns == columns
    assert list(found) == ["toxicity", "line_dedup", "ngram_join", "mixing", "packing"]

    given, kept = found["toxicity"]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    scores = toxicity.score_toxicity(spark.createDataFrame(given, SCHEMA), labels)
    toxic = {r.doc_id for r in scores.where("predicted = 1").collect()}
    assert Counter(kept) == Counter(r for r in given if r[0] not in toxic)

    given, kept = found["line_dedup"]
    lines = {d: "\n".join(k) for d, _, k in brute.kept_lines([r[:2] for r in given], 10)}
    assert Counter(kept) == Counter((r[0], lines[r[0]], r[2], r[3], len(lines[r[0]])) for r in given)

    given, kept = found["ngram_join"]
    low = {d: c for d, _, c, _ in brute.joined([r[:2] for r in given], 5, 80)}
    assert Counter(kept) == Counter(r for r in given if low[r[0]] == r[0])

    given, kept = found["mixing"]
    assert not Counter(kept).keys() - Counter(given).keys()
    count = lambda rows: sum(len(brute.words(r[1])) for r in rows)
    assert 0.6 * count(given) <= count(kept) <= 0.75 * count(given)

    given, pieces = found["packing"]
    from tablesync.llm.packing import Encoder, tokenizer_path

    encode, times = Encoder(tokenizer_path()), Counter(r[0] for r in given)
    sizes = {r[0]: len(encode(r[1] or "")) // 4 + 1 for r in given}
    got = Counter()
    for doc_id, _, length, *_ in pieces:
        got[doc_id] += length
    assert got == Counter({d: sizes[d] * n for d, n in times.items()})


def test_entry_registers_everything():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {"pipeline", *QUERIES} <= names and {f"op{n}" for n in range(1, 14)} <= {q.split("_")[0] for q in names}
    assert set(ORACLES) <= set(entry.oracle_sql())
