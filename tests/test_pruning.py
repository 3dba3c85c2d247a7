"""Partition filters that follow from predicates on the columns that partitions were derived from."""

import pytest

from tablesync.functions.partitions import parse_spec
from tablesync.functions.pruning import implied, pruned
from tablesync.operators.copy import copy_table, scan
from tablesync.operators.validate import TablePair, count_parity, validate_pairs
from tablesync.sources.catalog import partition_spec
from tablesync.sources.workspace import scratch_schema

ROWS = """
SELECT id, timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, cast(id * 7 AS int)) AS ts,
       date'2024-01-01' + cast(id % 90 AS int) AS d, id % 1000 AS n, concat('k', id % 37) AS s
FROM range(1000) UNION ALL SELECT -1, NULL, NULL, NULL, NULL
"""
SPEC = "ts:days,d:months,n:truncate[100],s:bucket[8]"


@pytest.fixture(scope="module")
def table(spark):
    schema = scratch_schema(spark, "pruning")
    spark.sql(f"CREATE TABLE {schema}.plain USING parquet AS {ROWS}")
    copy_table(spark, f"{schema}.plain", f"{schema}.t", spec=SPEC, distribute="none")
    return f"{schema}.t"


PREDICATES = [
    ("ts >= '2024-02-01'", ["ts_day"]),
    ("ts BETWEEN '2024-02-01 10:00:00' AND '2024-02-03' AND n < 250", ["ts_day", "n_trunc"]),
    ("ts < '2024-01-05' OR ts = timestamp'2024-03-01 07:00:00'", ["ts_day"]),
    ("'2024-01-05' > ts AND s = 'k7'", ["ts_day", "s_bucket"]),
    ("s IN ('k1', 'k2', 'k36') AND abs(n) > 3", ["s_bucket"]),
    ("d IN (date'2024-02-10', date'2024-03-10')", ["d_month"]),
    ("(d = date'2024-02-10' AND n > 500) OR (d > '2024-03-20' AND id = 3)", ["d_month"]),
    ("ts IS NULL", ["ts_day"]),
    ("s <=> 'k3' AND ts IS NOT NULL", ["s_bucket", "ts_day"]),
    ("n BETWEEN 100 AND 199 OR n IN (7, 999)", ["n_trunc"]),
    ("NOT (ts < '2024-02-01')", []),
    ("n < 250 OR id = 900", []),
    ("id BETWEEN 3 AND 9", []),
    ("to_date(ts) = '2024-02-01'", []),
    ("n IN (1, id)", []),
    ("s > 'k3'", []),
]


@pytest.mark.parametrize("where, columns", PREDICATES)
def test_rows_and_partitions(spark, table, where, columns):
    df = spark.table(table)
    assert partition_spec(spark, table) == SPEC
    found = implied(df, parse_spec(SPEC), where)
    assert (found is not None) == bool(columns)
    cut = scan(spark, table, where)
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, df.where(where).collect()))
    plan = cut._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert all(c in filters for c in columns) and bool(columns) == ("isnotnull" in filters or "=" in filters or "isnull" in filters or ">" in filters)


def test_a_filtered_count_prunes(spark, table):
    pairs = [TablePair("a", table, table, "ts < '2024-01-05'")]
    df = count_parity(spark, pairs)
    assert df.first()["source_count"] == 14
    plan = df._jdf.queryExecution().toString()
    assert plan.count("PartitionFilters: [isnotnull(ts_day") == 2


def test_columns_of_other_names(spark):
    df = spark.createDataFrame([(1, 2)], "`ts` int, `n trunc` int")
    assert implied(df, parse_spec("ts:truncate[10]"), "ts > 3") is None
    assert pruned(df, [], "ts > 0").count() == 1


def test_five_hundred_pairs(spark):
    import time

    schema = scratch_schema(spark, "many")
    for i in range(10):
        spark.sql(f"CREATE TABLE {schema}.t{i} USING parquet AS SELECT id, id % {i + 1} AS k FROM range(25)")
    pairs = [TablePair(f"p{i}", f"{schema}.t{i % 10}", f"{schema}.t{i % 7}", "k > 1") for i in range(500)]
    pairs[17] = TablePair("p17", f"{schema}.none", f"{schema}.t1")
    start = time.time()
    assert validate_pairs(spark, pairs[100:110], at_once=1).count() == 10
    alone = (time.time() - start) / 10
    start = time.time()
    found = {r["pair_key"]: r for r in validate_pairs(spark, pairs).collect()}
    # A minute, or where one pair alone takes long, well below one after the other.
    assert time.time() - start < max(60, 0.6 * 500 * alone)
    assert len(found) == 500 and found["p17"]["validation_status"] == "error" and "none" in found["p17"]["validation_error"]
    for i in range(500):
        a, b = (sum(x % (m + 1) > 1 for x in range(25)) for m in (i % 10, i % 7))
        if i != 17:
            r = found[f"p{i}"]
            assert (r["source_count"], r["target_count"], r["target_count_total"]) == (a, b, 25)
            assert r["validation_status"] == ("ok" if a == b else "mismatch")
