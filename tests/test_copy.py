import datetime

import pytest
from pyspark.sql import functions as F

from tablesync.operators.copy import (
    LayoutConflict,
    TypeConflict,
    chunk_coverage,
    copy_chunk,
    copy_merging_schema,
    copy_table,
    overwrite_partitions,
    scan_window,
)
from tablesync.operators.rowdiff import RowDiff
from tablesync.sources.workspace import scratch_schema

SEED = [
    ("xxxxx", "2022-11-12", "direct", "hosting_banners", "2022-12-10"),
    ("xxxxx", "2022-11-12", "indirect", "hosting_banners", "2022-12-10"),
    ("xxxxx", "2022-11-12", "direct", "hosting_banners", "2022-12-11"),
    ("yyyyy", "2022-11-12", "indirect", "hosting_banners", "2022-12-12"),
]


@pytest.fixture
def target(spark):
    return scratch_schema(spark, "target")


def events(spark, days=4, per_day=24):
    return spark.range(days * per_day).selectExpr(
        "id",
        "timestamp_ntz '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, CAST(id AS INT)) AS ts",
        "id * 2 AS v",
    )


def test_copy_then_diff_is_empty(spark, target):
    seed = spark.createDataFrame(SEED, "client string, date string, class string, data_type string, date_new string")
    seed.write.partitionBy("date").saveAsTable(f"{target}.seed")
    copy_table(spark, f"{target}.seed", f"{target}.copy", spec="date")
    copied = spark.table(f"{target}.copy")
    assert copied.count() == 4
    keys = ["client", "class", "date_new"]
    assert RowDiff(seed, copied, keys).verdict().first()["validation_status"] == "ok"


def test_untouched_partitions_stay(spark, target):
    rows = events(spark)
    table = f"{target}.t"
    overwrite_partitions(rows, table, "ts:days")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    overwrite_partitions(rows.where("id >= 72").withColumn("v", F.lit(-1).cast("long")), table, "ts:days")
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    assert spark.table(table).where("v = -1").count() == 24
    assert spark.table(table).count() == 96


def test_column_order_does_not_matter(spark, target):
    table = f"{target}.t"
    overwrite_partitions(events(spark), table, "ts:days")
    overwrite_partitions(events(spark).select("v", "ts", "id"), table, "ts:days")
    assert spark.table(table).where("v <> id * 2").count() == 0


def test_empty_overwrite(spark, target):
    nothing = events(spark).where("id < 0")
    overwrite_partitions(events(spark), f"{target}.p", "ts:days")
    overwrite_partitions(nothing, f"{target}.p", "ts:days")
    assert spark.table(f"{target}.p").count() == 96
    overwrite_partitions(events(spark), f"{target}.u")
    overwrite_partitions(nothing, f"{target}.u")
    assert spark.table(f"{target}.u").count() == 0


def test_a_large_partition_is_split(spark, target):
    """REBALANCE: no task gets a whole hot partition, none gets a file per partition and task."""
    rows = events(spark).withColumn("kind", F.lit("hot"))
    overwrite_partitions(rows, f"{target}.t", "kind")
    plan = rows.hint("rebalance", F.col("kind"))._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan


@pytest.mark.parametrize("spec", ["ts:days", "", "ts:months", "ts:days,odd"])
def test_chunks_equal_the_whole(spark, target, spec):
    rows = events(spark).withColumn("odd", F.when(F.col("id") % 5 > 0, F.col("id") % 2))
    table = f"{target}.t"
    windows = ["ts < timestamp_ntz '2024-01-02 12:00:00'", "ts >= timestamp_ntz '2024-01-02 12:00:00'"]
    for window in [*windows, windows[1], windows[0]]:  # twice: a chunk can be run again
        copy_chunk(rows, table, spec, window)
    assert sorted(r[0] for r in spark.table(table).select("id").collect()) == list(range(96))


def test_many_touched_partitions(spark, target):
    rows = spark.range(2000).selectExpr("id", "id div 40 AS a", "id % 40 AS b", "id AS v")
    table = f"{target}.t"
    for window in ("id < 1990", "id >= 1990", "v >= 10"):
        copy_chunk(rows, table, "a,b", window)
    assert spark.table(table).distinct().count() == spark.table(table).count() == 2000


def test_a_rerun_takes_away_what_the_source_lost(spark, target):
    table = f"{target}.t"
    window = "ts >= timestamp_ntz '2024-01-01 12:00:00'"
    copy_chunk(events(spark), table, "ts:days", "ts < timestamp_ntz '2024-01-01 12:00:00'")
    copy_chunk(events(spark), table, "ts:days", window)
    copy_chunk(events(spark).where("id < 20"), table, "ts:days", window)
    assert sorted(r[0] for r in spark.table(table).select("id").collect()) == list(range(20))
    assert spark.sql(f"SHOW PARTITIONS {table}").count() == 1


def test_an_emptied_null_partition_goes(spark, target):
    table = f"{target}.t"
    rows = spark.range(10).selectExpr("id", "if(id < 3, null, id % 2) AS k", "if(id < 5, 'a b', null) AS s")
    copy_chunk(rows, table, "k,s", "id >= 0")
    copy_chunk(rows.where("id > 4"), table, "k,s", "id >= 0")
    assert sorted(r[0] for r in spark.table(table).select("id").collect()) == list(range(5, 10))


def test_nothing_is_left_aside(spark, target):
    before = spark.sql("SHOW SCHEMAS").count()
    for window in ("id < 30", "id >= 30"):
        copy_chunk(events(spark), f"{target}.u", "", window)
    assert spark.sql("SHOW SCHEMAS").count() == before
    assert spark.table(f"{target}.u").distinct().count() == 96


@pytest.mark.parametrize(
    "rows, spec",
    [
        ("SELECT *, 1 AS more FROM {e}", "ts:days"),
        ("SELECT id, ts FROM {e}", "ts:days"),
        ("SELECT * FROM {e}", ""),
        ("SELECT * FROM {e}", "ts:months"),
    ],
)
def test_other_columns_or_partitions_stop_a_copy(spark, target, rows, spec):
    table = f"{target}.t"
    overwrite_partitions(events(spark), table, "ts:days")
    with pytest.raises(LayoutConflict):
        overwrite_partitions(spark.sql(rows, e=events(spark)), table, spec)
    assert spark.table(table).count() == 96


def test_instants_are_partitioned_in_utc(spark, target):
    zone = spark.conf.get("spark.sql.session.timeZone")
    rows = spark.range(96).selectExpr("id", "timestamp_seconds(1704067200 + id * 3600) AS ts")
    try:
        for spec in ("ts:days", "ts:hours", "ts:months"):
            table = f"{target}.{spec[3:]}"
            spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
            overwrite_partitions(rows, table, spec)
            spark.conf.set("spark.sql.session.timeZone", "America/New_York")
            found = scan_window(spark, table, "ts", "2024-01-02 05:00:00", "2024-01-03 17:00:00")
            plain = spark.table(table).where("ts >= '2024-01-02 05:00:00' AND ts < '2024-01-03 17:00:00'")
            assert found.count() == plain.count() == 36
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_coverage(spark):
    found = chunk_coverage(events(spark), ["id < 10", "id >= 5 AND id < 90"])
    assert {r["hits"]: r["n"] for r in found.collect()} == {0: 6, 1: 85, 2: 5}


def test_schema_merge(spark, target):
    table = f"{target}.t"
    copy_merging_schema(events(spark).select("id", "ts"), table, "ts:days")
    later = events(spark).where("id >= 48").withColumn("extra", F.lit("x"))
    copy_merging_schema(later.select("ts", "extra", "id"), table, "ts:days")
    copied = spark.table(table)
    assert copied.count() == 96
    assert copied.where("extra = 'x'").count() == 48
    with pytest.raises(TypeConflict):
        copy_merging_schema(events(spark).withColumn("id", F.col("id").cast("string")), table, "ts:days")


def test_properties_are_escaped(spark, target):
    events(spark).write.saveAsTable(f"{target}.s")
    spark.sql(f"ALTER TABLE {target}.s SET TBLPROPERTIES ('graph.a' = 'it\\'s \\\\ here', 'b' = '1')")
    copy_table(spark, f"{target}.s", f"{target}.t")
    shown = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {target}.t").collect()}
    assert shown == {"graph.a": "it's \\ here"}


def test_dates_of_other_types(spark, target):
    rows = spark.createDataFrame([(1, datetime.date(2024, 2, 29)), (2, None)], "id int, d date")
    overwrite_partitions(rows, f"{target}.t", "d:months")
    assert spark.table(f"{target}.t").count() == 2


def table_of(spark, schema, name, sql):
    spark.sql(f"CREATE TABLE {schema}.{name} USING parquet AS {sql}")
    return f"{schema}.{name}"


@pytest.mark.parametrize(
    "have, new, fits",
    [
        ("cast(1 AS decimal(10,2))", "cast(1.2345 AS decimal(10,4))", False),
        ("cast(1 AS decimal(10,2))", "cast(1.2300 AS decimal(10,4))", True),
        ("cast(1 AS float)", "cast(0.1 AS double)", False),
        ("cast(1 AS float)", "cast(0.5 AS double)", True),
        ("1", "3000000000L", False),
        ("1L", "7", True),
        ("cast(1 AS string)", "7", True),
        ("7", "'007'", False),
        ("date'2024-01-01'", "timestamp'2024-01-01 10:00:00'", False),
        ("array(1)", "array(3000000000L)", False),
        ("cast(1 AS float)", "cast('NaN' AS double)", True),
        ("1", "cast(NULL AS bigint)", True),
    ],
)
def test_a_narrower_target_keeps_every_value(spark, have, new, fits):
    from tablesync.operators.copy import LayoutConflict, overwrite_partitions

    schema = scratch_schema(spark, "narrow")
    table = table_of(spark, schema, "t", f"SELECT {have} AS v, 1 AS k")
    rows = spark.sql(f"SELECT 2 AS k, {new} AS V")
    if fits:
        overwrite_partitions(rows, table)
        assert spark.table(table).first()["k"] == 2
    else:
        with pytest.raises(LayoutConflict, match="cannot hold a value of V|CAST_OVERFLOW"):
            overwrite_partitions(rows, table)
        assert spark.table(table).first()["k"] == 1
    # Maps cannot be compared, so another type within one is refused before anything runs.
    maps = table_of(spark, schema, "maps", "SELECT map('a', 1) AS v")
    with pytest.raises(LayoutConflict):
        overwrite_partitions(spark.sql("SELECT map('a', 1L) AS v"), maps)
    overwrite_partitions(spark.sql("SELECT map('b', 2) AS v"), maps)


def test_wider_types():
    from pyspark.sql.types import _parse_datatype_string as kind

    from tablesync.operators.copy import wider

    names = ["tinyint", "smallint", "int", "bigint", "float", "double", "decimal(10,2)", "decimal(38,0)", "date", "timestamp_ntz", "string", "binary", "array<int>"]
    join = {(a, b): wider(kind(a), kind(b)).simpleString() for a in names for b in names}
    assert all(join[a, b] == join[b, a] for a in names for b in names) and all(join[a, a] == a for a in names)
    assert join["int", "bigint"] == "bigint" and join["int", "string"] == "string" and join["int", "float"] == "double"
    assert join["smallint", "float"] == "float" and join["bigint", "double"] == "string" and join["bigint", "decimal(10,2)"] == "decimal(21,2)"
    assert join["date", "timestamp_ntz"] == "timestamp_ntz" and join["decimal(38,0)", "decimal(10,2)"] == "string"


def test_conflicts_of_types(spark):
    from tablesync.operators.copy import TypeConflict, copy_merging_schema

    schema = scratch_schema(spark, "conflict")
    old = "SELECT 1 AS day, 5 AS a, 6L AS b, 7 AS c, 'x' AS d UNION ALL SELECT 2, 8, 9L, 10, 'y'"

    def made(name):
        spark.sql(f"CREATE TABLE {schema}.{name} USING parquet PARTITIONED BY (day) TBLPROPERTIES ('graph.k' = 'it''s') AS {old}")
        return f"{schema}.{name}"

    rows = spark.sql("SELECT 2 AS day, 3000000000L AS a, 4 AS b, 'z' AS c, 1.5 AS d")
    table = made("e")
    with pytest.raises(TypeConflict):
        copy_merging_schema(rows, table, "day")
    assert spark.table(table).count() == 2

    copy_merging_schema(rows, made("w"), "day", conflict="widen")
    found = spark.table(f"{schema}.w").select("day", "a", "b", "c", "d").orderBy("day")
    assert [f.dataType.simpleString() for f in found.schema] == ["int", "bigint", "bigint", "string", "string"]
    assert [tuple(r) for r in found.collect()] == [(1, 5, 6, "7", "x"), (2, 3000000000, 4, "z", "1.5")]

    copy_merging_schema(rows, made("k"), "day", conflict="keep_aside")
    found = spark.table(f"{schema}.k").select("day", "a__int", "a", "b", "c__int", "c", "d").orderBy("day")
    assert [tuple(r) for r in found.collect()] == [(1, 5, None, 6, 7, None, "x"), (2, None, 3000000000, 4, None, "z", "1.5")]
    for name in ("w", "k"):
        shown = dict(map(tuple, spark.sql(f"SHOW TBLPROPERTIES {schema}.{name}").collect()))
        assert shown["graph.k"] == "it's" and [r[0] for r in spark.sql(f"SHOW PARTITIONS {schema}.{name}").collect()] == ["day=1", "day=2"]
    # Once more with another type: the next name.
    copy_merging_schema(spark.sql("SELECT 2 AS day, 'q' AS a__int"), f"{schema}.k", "day", conflict="keep_aside")
    assert "a__int__int" in spark.table(f"{schema}.k").columns
    with pytest.raises(TypeConflict):
        copy_merging_schema(spark.sql("SELECT 'x' AS day, 1 AS a"), f"{schema}.w", "day", conflict="widen")
