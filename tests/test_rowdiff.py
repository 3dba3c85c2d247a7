from collections import Counter

import pytest
from pyspark.sql import functions as F

from tablesync.operators import rowdiff
from tablesync.operators.rowdiff import KeyMissing, RowDiff, key_quality, schema_diff

SOURCE = [(1, None), (2, "x"), (3, None), (None, "q")]
TARGET = [(1, None), (2, "y"), (None, "q")]


@pytest.fixture(scope="module")
def edge(spark):
    schema = "k int, v string"
    return spark.createDataFrame(SOURCE, schema), spark.createDataFrame(TARGET, schema)


def found(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


@pytest.mark.parametrize("unique_keys", [False, True])
def test_edge_rows(edge, unique_keys):
    diff = RowDiff(*edge, "k", unique_keys=unique_keys)
    assert diff.aligned().count() == 5
    assert found(diff.rows(), "k", "row_status", "mismatched_columns", "old__v", "new__v") == Counter(
        [
            (2, "changed", "v", "x", "y"),
            (3, "only_source", "", None, None),
            (None, "only_source", "v", "q", None),
            (None, "only_target", "v", None, "q"),
        ]
    )
    lenient = RowDiff(*edge, "k", strict=False, unique_keys=unique_keys)
    assert lenient.rows().count() == 3
    assert lenient.count().first()[0] == 3


@pytest.mark.parametrize("unique_keys", [False, True])
def test_null_keys_can_match(edge, unique_keys):
    diff = RowDiff(*edge, "k", null_keys="match", unique_keys=unique_keys)
    assert found(diff.rows(), "k", "row_status") == Counter([(2, "changed"), (3, "only_source")])


def test_equal_sides_are_ok(edge):
    source, _ = edge
    row = RowDiff(source, source, "k", null_keys="match").verdict().first()
    assert row["validation_status"] == "ok"
    assert row["source_count"] == row["target_count"] == 4


def test_key_must_be_on_both_sides(edge):
    source, target = edge
    with pytest.raises(KeyMissing):
        RowDiff(source, target.withColumnRenamed("k", "other"), "k")


def test_only_keys(spark):
    source = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    target = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    assert found(RowDiff(source, target, "k").rows(), "k", "row_status", "row_copies") == Counter(
        [(2, "only_source", 1), (3, "only_target", 1)]
    )


def brute_force(source, target):
    """Bags per key: what is equal cancels, one row left on both sides is a change."""
    old, new = Counter(source), Counter(target)
    more_old, more_new = old - new, new - old
    out = Counter()
    for k in {r[0] for r in [*more_old, *more_new]}:
        o = [r for r in more_old.elements() if r[0] == k]
        n = [r for r in more_new.elements() if r[0] == k]
        if len(o) == 1 and len(n) == 1:
            out[(k, "changed", o[0][1], n[0][1])] += 1
        else:
            for r in o:
                out[(k, "only_source", r[1], None)] += 1
            for r in n:
                out[(k, "only_target", None, r[1])] += 1
    return out


def test_hot_key_gives_no_pairs(spark):
    """A key with a third of the rows, and others twice: bags, exactly as by brute force."""
    source = [(0, i % 700) for i in range(2000)] + [(1 + i // 2, i) for i in range(4000)]
    target = [(0, i % 650) for i in range(1990)] + [(1 + i // 2, i + (i % 9 == 0)) for i in range(4000)]
    schema = "k int, v int"
    diff = RowDiff(
        spark.createDataFrame(source, schema), spark.createDataFrame(target, schema), "k"
    )
    got = Counter()
    for r in diff.rows().collect():
        got[(r["k"], r["row_status"], r["old__v"], r["new__v"])] += r["row_copies"]
    assert got == brute_force(source, target)
    summary = diff.summary().first()
    assert (summary["source_count"], summary["target_count"]) == (len(source), len(target))
    assert summary["mismatched_rows"] == sum(got.values())
    assert sum(r["row_copies"] for r in diff.aligned().collect()) == sum(
        (Counter(source) & Counter(target)).values()
    ) + sum(got.values())


def joined_counts(source, target, width):
    """The plain full outer join, pair by pair."""
    rows = []
    for s in source:
        met = [t for t in target if s[0] is not None and t[0] == s[0]]
        rows += [(s[1:], t[1:]) for t in met] or [(s[1:], (None,) * width)]
    keys = {s[0] for s in source if s[0] is not None}
    rows += [((None,) * width, t[1:]) for t in target if t[0] not in keys]
    return rows


@pytest.mark.parametrize("width", [1, 2])
def test_pair_counts_are_those_of_the_join(spark, width):
    source = [(i % 7 or None, i % 3 or None, i % 5)[: width + 1] for i in range(60)]
    target = [(i % 8 or None, i % 4 or None, i % 5)[: width + 1] for i in range(50)]
    schema = "k int, a int, b int" if width == 2 else "k int, a int"
    diff = RowDiff(spark.createDataFrame(source, schema), spark.createDataFrame(target, schema), "k")
    rows = joined_counts(source, target, width)
    want = {"*": sum(o != n for o, n in rows)}
    want |= {c: sum(o[i] != n[i] for o, n in rows) for i, c in enumerate("ab"[:width])}
    assert {r[0]: int(r[1]) for r in diff.pair_counts().collect()} == want


@pytest.mark.parametrize("most", [0, 8, 64])
@pytest.mark.parametrize("null_keys", ["separate", "match"])
def test_pair_counts_of_hot_and_other_keys(spark, monkeypatch, most, null_keys):
    monkeypatch.setattr(rowdiff, "PAIRED_ROWS", most, raising=False)
    source = [(i % 7 or None, i % 3 or None, i % 5) for i in range(40)] + [(3, 1, i) for i in range(30)] + [(90, None, None)] * 20
    target = [(i % 8 or None, i % 4 or None, i % 5) for i in range(30)] + [(91, i, None) for i in range(3)]
    schema = "k int, a int, b int"
    both = [spark.createDataFrame(rows, schema) for rows in (source, target)]
    met = [[(-1 if k is None and null_keys == "match" else k, *rest) for k, *rest in side] for side in (source, target)]
    rows = joined_counts(*met, 2)
    want = {"*": sum(o != n for o, n in rows)}
    want |= {c: sum(o[i] != n[i] for o, n in rows) for i, c in enumerate("ab")}
    assert {r[0]: int(r[1]) for r in RowDiff(*both, "k", null_keys=null_keys).pair_counts().collect()} == want
    none = RowDiff(both[0].where("false"), both[1].where("false"), "k", null_keys=null_keys)
    assert none.pair_counts().collect() == []


def test_pair_counts_send_a_row_once(spark, capsys):
    """Rows of keys that hardly repeat are not sent once more for each column."""
    rows = spark.range(1000).selectExpr("id DIV 2 AS k", *[f"id % {i + 2} AS c{i}" for i in range(12)])
    RowDiff(rows, rows, "k").pair_counts().explain()
    assert "Expand" not in capsys.readouterr().out


def test_hot_null_key(spark):
    rows = [(None, "same")] * 500 + [(i, "v") for i in range(100)]
    df = spark.createDataFrame(rows, "k int, v string")
    summary = RowDiff(df, df, "k").summary().first()
    assert (summary["only_source"], summary["only_target"], summary["changed"]) == (500, 500, 0)


def test_maps_arrays_and_structs(spark):
    def side(m):
        return spark.createDataFrame(
            [(1, m, [m], (m, 1.0)), (2, None, None, None)],
            "k int, m map<string,int>, a array<map<string,int>>, s struct<m:map<string,int>,x:double>",
        )

    same = RowDiff(side({"a": 1, "b": 2}), side({"b": 2, "a": 1}), "k")
    assert same.count().first()[0] == 0
    other = RowDiff(side({"a": 1, "b": 2}), side({"a": 1, "b": 3}), "k")
    assert found(other.rows(), "k", "mismatched_columns") == Counter([(1, "m, a, s")])


def test_names_with_dots_and_marks(spark):
    source = spark.createDataFrame([(1, "a", "b")], ["the.key", "old__x", "a`b"])
    target = spark.createDataFrame([(1, "a", "c")], ["the.key", "old__x", "a`b"])
    row = RowDiff(source, target, "the.key").rows().first()
    assert row["mismatched_columns"] == "a`b"
    assert row["new__a`b"] == "c"


def test_types_that_differ(spark):
    source = spark.createDataFrame([(1, 10), (2, 20)], "k int, v int")
    target = spark.createDataFrame([(1, "10"), (2, "21")], "k int, v string")
    assert found(RowDiff(source, target, "k").rows(), "k", "old__v", "new__v") == Counter([(2, "20", "21")])
    changes = found(schema_diff(source, target), "column_name", "status")
    assert changes == Counter([("k", "equal"), ("v", "type_changed")])


def test_columns_of_one_side_are_not_compared(spark):
    source = spark.createDataFrame([(1, "a", 1)], "k int, v string, gone int")
    target = spark.createDataFrame([(1, "a", 2)], "k int, v string, extra int")
    assert RowDiff(source, target, "k").count().first()[0] == 0
    statuses = found(schema_diff(source, target), "column_name", "status")
    assert statuses[("gone", "only_source")] == statuses[("extra", "only_target")] == 1


def test_wide_tables(spark):
    source = spark.range(50).select("id", *[(F.col("id") + i).alias(f"c{i}") for i in range(300)])
    target = source.withColumn("c299", F.when(F.col("id") == 7, 0).otherwise(F.col("c299")))
    diff = RowDiff(source, target, "id", unique_keys=True)
    assert found(diff.by_column(), "column_name", "mismatches") == Counter([("c299", 1)])
    assert diff.rows().first()["id"] == 7


def test_key_quality(spark):
    rows = spark.createDataFrame([(1, 1), (1, 1), (1, None), (2, 5), (None, None)], "a int, b int")
    assert key_quality(rows, ["a", "b"]).first().asDict() == {
        "duplicate_keys": 1,
        "rows_affected": 2,
        "null_key_rows": 2,
    }


def test_the_summary_is_one_pass(spark):
    """The sides are scanned once each and compared without a Python worker."""
    folder = "/root/testdata/sf0.001"
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    diff = RowDiff(orders, orders.where("o_custkey > 3"), "o_orderkey", unique_keys=True, null_keys="match")
    plan = diff.summary()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
    assert "FullOuter" in plan and "Python" not in plan
