import datetime
import random

import pytest
from pyspark.sql import functions as F

from tablesync.functions.partitions import (
    BadSpec,
    parse_spec,
    spec_parts,
    spec_text,
    with_partition_columns,
)
from tablesync.operators.copy import overwrite_partitions, scan_window
from tablesync.sources.catalog import partition_spec, spec_display
from tablesync.sources.workspace import scratch_schema

GOOD = [
    "", "date", "updated_at_ts:days", "updated_at_ts:days,kg_content_type", "ts:hours", "ts:months",
    "ts:years", "id:bucket[16]", "name:truncate[4]",
]


@pytest.mark.parametrize("spec", GOOD)
def test_specs_round_trip(spec):
    assert spec_text(parse_spec(spec)) == spec


def test_spaces_are_trimmed():
    assert spec_text(parse_spec(" a : days ")) == "a:days"


@pytest.mark.parametrize("spec", ["a:b:c", "a:sometimes", "a:bucket", "a:days[3]", ":days"])
def test_bad_specs(spec):
    with pytest.raises(BadSpec):
        parse_spec(spec)


def test_both_readers_agree_on_any_text(spark):
    rng = random.Random(4)
    pieces = ["a", "ts", " ", ":", ":days", ":bucket[4]", ":truncate[0]", "[7]", ":identity", ",", "hours", "\t", ":bucket[99999999999]", "é", ":Days", "[]", ":bucket[٣]"]
    texts = sorted({"".join(rng.choice(pieces) for _ in range(rng.randint(1, 5))) for _ in range(600)} | {"a:", "a: ", ":"})
    df = spark.createDataFrame([(t,) for t in texts], "spec string")
    for r in df.select("spec", spec_parts(F.col("spec")).alias("parts")).collect():
        try:
            own = [(f.source, f.transform, f.width) for f in parse_spec(r["spec"])]
        except BadSpec:
            own = None
        valid = all(p["valid"] for p in r["parts"])
        assert (own is not None) == valid, r
        if valid:
            assert own == [(p["col"], p["transform"].split("[")[0], p["width"]) for p in r["parts"]]


def test_column_of_specs_reads_alike(spark):
    texts = [*GOOD, " a : days ", "a:b:c", "a:sometimes", "a:bucket", "a:days[3]", ":days"]
    df = spark.createDataFrame([(t,) for t in texts], "spec string")
    for r in df.select("spec", spec_parts(F.col("spec")).alias("parts")).collect():
        try:
            want = [(f.source, f.width) for f in parse_spec(r["spec"])]
            assert all(p["valid"] for p in r["parts"])
            assert [(p["col"], p["width"]) for p in r["parts"]] == want
        except BadSpec:
            assert not all(p["valid"] for p in r["parts"])


def test_display():
    assert spec_display("") == "Not partitioned"
    assert spec_display("ts:days,id:bucket[4]") == "1: ts_day: days(ts); 2: id_bucket: bucket[4](id)"


def test_transforms(spark):
    df = spark.createDataFrame(
        [(datetime.datetime(1969, 12, 31, 23, 30), -7, "abcdef")], "ts timestamp_ntz, n long, s string"
    )
    spec = "ts:days,ts:hours,ts:months,ts:years,n:truncate[10],s:truncate[2],n:bucket[4]"
    row = with_partition_columns(df, parse_spec(spec)).first()
    assert row["ts_day"] == datetime.date(1969, 12, 31)
    assert row["ts_hour"] == -1
    assert row["ts_month"] == datetime.date(1969, 12, 1)
    assert row["ts_year"] == datetime.date(1969, 1, 1)
    assert row["s_trunc"] == "ab"
    assert 0 <= row["n_bucket"] < 4
    only_numbers = with_partition_columns(df, parse_spec("n:truncate[10]")).first()
    assert only_numbers["n_trunc"] == -10


def test_window_prunes_partitions(spark):
    rows = spark.range(240).selectExpr(
        "id", "timestamp_ntz '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, CAST(id AS INT)) AS ts"
    )
    table = f"{scratch_schema(spark, 'target')}.t"
    overwrite_partitions(rows, table, "ts:days")
    assert partition_spec(spark, table) == "ts:days"
    window = scan_window(spark, table, "ts", "2024-01-03 12:00:00", "2024-01-05 00:00:00")
    assert sorted(r["id"] for r in window.select("id").collect()) == list(range(60, 96))
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "ts_day" in plan.split("PartitionFilters: [")[1].split("]")[0]
    # The bound itself lies in a day that is read: never strict on the day.
    assert scan_window(spark, table, "ts", "2024-01-05", "2024-01-05 01:00:00").count() == 1
