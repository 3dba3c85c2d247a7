import uuid

import pytest
from pyspark.errors import PySparkException

from tablesync.operators import backup
from tablesync.operators import properties as p
from tablesync.operators.copy import overwrite_partitions
from tablesync.sources import catalog
from tablesync.sources.properties import snapshot_by_metadata, snapshot_by_sql, unreadable
from tablesync.sources.workspace import scratch_schema, shared_folder

CATALOG = "spark_catalog"


@pytest.fixture
def place(spark):
    schema = scratch_schema(spark, "place")
    spark.range(10).selectExpr("id", "id % 2 AS k").createOrReplaceTempView("numbers")
    spark.sql(f"CREATE TABLE {schema}.plain USING parquet AS SELECT * FROM numbers")
    overwrite_partitions(spark.table("numbers"), f"{schema}.parted", "k,id:truncate[5]")
    spark.sql(f"CREATE VIEW {schema}.v AS SELECT * FROM {schema}.plain")
    return schema


def test_inventory(spark, place):
    found = {r["name"]: r["kind"] for r in catalog.inventory(spark, CATALOG, [place]).collect()}
    assert found == {"plain": "table", "parted": "table", "v": "view"}
    assert place in [r["schema"] for r in catalog.list_schemas(spark, CATALOG).collect()]


def test_views_are_found_without_a_listing(spark, place, monkeypatch):
    shown = catalog._show

    def without_views(spark, what, *rest):
        if what == "VIEWS":
            raise PySparkException("no listing")
        return shown(spark, what, *rest)

    monkeypatch.setattr(catalog, "_show", without_views)
    assert [r["name"] for r in catalog.list_views(spark, CATALOG, place).collect()] == ["v"]


def test_summaries(spark, place):
    found = {r["table"]: r for r in catalog.summarize_tables(spark, CATALOG, [place]).collect()}
    assert found["parted"]["partition_columns"] == "k,id:truncate[5]"
    assert found["plain"]["partition_spec_display"] == "Not partitioned"
    missing = catalog.partition_specs(spark, [f"{CATALOG}.{place}.none"]).first()
    assert missing["error"] and missing["partition_columns"] == ""
    text = catalog.summarize_views(spark, CATALOG, [place]).first()["ddl_preview"]
    assert text.startswith("CREATE VIEW")


def test_preview_length(spark):
    df = spark.createDataFrame([("x" * 400,), ("x" * 401,)], "ddl string")
    lengths = [len(r[0]) for r in df.select(catalog.ddl_preview(df["ddl"])).collect()]
    assert lengths == [400, 404]


def test_counts(spark, place):
    found = {r["name"]: r["row_count"] for r in catalog.counted_inventory(spark, CATALOG, [place], "id < 4").collect()}
    assert found == {"plain": 4, "parted": 4, "v": None}
    bad = catalog.counted_inventory(spark, CATALOG, [place], "nope = 1").where("kind = 'table'").collect()
    assert all(r["row_count"] is None and len(r["count_error"]) <= 120 for r in bad)


def test_hidden_transforms():
    assert catalog._hidden_transform("days(ts)") == "ts:days"
    assert catalog._hidden_transform("bucket(16, id)") == "id:bucket[16]"
    assert catalog._hidden_transform("kind") == "kind"


def test_property_round_trip(spark, place):
    other = scratch_schema(spark, "other")
    spark.sql(f"CREATE TABLE {other}.plain USING parquet AS SELECT * FROM numbers")
    s, t = f"{CATALOG}.{place}.plain", f"{CATALOG}.{other}.plain"
    spark.sql(f"ALTER TABLE {s} SET TBLPROPERTIES ('a' = 'it\\'s', 'b' = '1', 'format-version' = '2', 'c' = 'x\\\\y')")
    spark.sql(f"ALTER TABLE {t} SET TBLPROPERTIES ('b' = '2', 'extra' = 'e')")
    pairs = spark.createDataFrame([(s, t)], "source_fqn string, target_fqn string")

    def sides():
        return snapshot_by_sql(spark, [s]), snapshot_by_sql(spark, [t])

    dry = p.sync(spark, pairs, *sides()).first()
    assert (dry["key_count"], dry["keys"], dry["applied"]) == (3, "a,b,c", False)
    done = p.sync(spark, pairs, *sides(), dry_run=False).first()
    assert (done["key_count"], done["applied"], done["error"]) == (3, True, "")
    status = {r["key"]: r["status"] for r in p.diff(pairs, *sides()).collect()}
    assert status == {
        "a": "equal", "b": "equal", "c": "equal", "extra": "extra_on_target", "format-version": "missing_on_target",
    }
    again = p.sync(spark, pairs, *sides(), dry_run=False).first()
    assert (again["key_count"], again["applied"]) == (0, False)
    spark.sql(f"ALTER TABLE {s} SET TBLPROPERTIES ('b' = '3')")
    assert p.apply_plan(spark, p.plan_of(p.key_plan(pairs, *sides(), "b"), "b")).first()["applied"]
    assert p.key_plan(pairs, *sides(), "b").first()["action"] == "noop"
    assert p.verify(pairs, sides()[1], "a").first()["value"] == "it's"
    assert p.key_plan(pairs, *sides(), "format-version").first()["action"] == "skip (reserved)"
    readings = p.compare_readings(sides()[0], snapshot_by_metadata(spark, [s]))
    assert {r["only_in"] for r in readings.collect()} == {"both"}


def test_failed_apply_is_reported(spark, place):
    s, t = f"{CATALOG}.{place}.plain", f"{CATALOG}.{place}.none"
    pairs = spark.createDataFrame([(s, t)], "source_fqn string, target_fqn string")
    source = spark.createDataFrame([(s, "a", "1")], "table_fqn string, key string, value string")
    row = p.sync(spark, pairs, source, source.where("false"), dry_run=False).first()
    assert row["applied"] is False and row["error"]


def test_backup(spark, place):
    files = f"{shared_folder(spark)}/outside/{uuid.uuid4().hex}"
    spark.table("numbers").write.partitionBy("k").parquet(files)
    spark.sql(f"CREATE TABLE {place}.outside (id LONG, k LONG) USING parquet PARTITIONED BY (k) LOCATION '{files}'")
    spark.sql(f"MSCK REPAIR TABLE {place}.outside")
    names = {"plain", "parted", "outside"}
    plan = backup.plan(catalog.inventory(spark, CATALOG, [place]), "_v2")
    assert {r["action"] for r in plan.collect()} == {"move", "drop view"}
    assert backup.move_aside(spark, CATALOG, [place], "_v2") == []
    where = {f"{place}_v2": f"{shared_folder(spark)}/schemas/{uuid.uuid4().hex}.db"}
    made = backup.move_aside(spark, CATALOG, [place, "no_such_schema"], "_v2", confirm=True, locations=where)
    assert made == [f"{place}_v2"]
    assert not spark.catalog.databaseExists(place)
    assert {n: spark.table(f"{place}_v2.{n}").count() for n in names} == dict.fromkeys(names, 10)
    assert catalog.partition_spec(spark, f"{CATALOG}.{place}_v2.parted") == "k,id:truncate[5]"
    found = {r["schema"]: r["tables"] for r in backup.verify(spark, CATALOG, [f"{place}_v2", "none_v2"]).collect()}
    assert found == {f"{place}_v2": 3, "none_v2": None}


@pytest.mark.parametrize("other", [(9, 5), (10, 6)])
def test_backup_keeps_the_original_when_rows_differ(spark, place, monkeypatch, other):
    contents = iter([(10, 5), other])
    monkeypatch.setattr(backup, "_content", lambda spark, fqn: next(contents))
    with pytest.raises(backup.ContentMismatch):
        backup.move_aside(spark, CATALOG, [place], "_v3", confirm=True)
    assert spark.table(f"{place}.parted").count() == 10


def test_the_shared_folder_is_the_clusters(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_snapshot_goes_on_without_unreadable_tables(spark):
    place = scratch_schema(spark, "source")
    spark.sql(f"CREATE TABLE {place}.t (a INT) USING parquet TBLPROPERTIES ('k' = 'v')")
    for snapshot in (snapshot_by_sql, snapshot_by_metadata):
        errors: list = []
        rows = snapshot(spark, [f"{place}.gone", f"{place}.t"], errors)
        assert rows.where("key = 'k'").count() == 1
        assert [r["table_fqn"] for r in unreadable(spark, errors).collect()] == [f"{place}.gone"]


def test_unknown_kinds_stop_a_backup(spark, monkeypatch):
    place = scratch_schema(spark, "source")
    spark.sql(f"CREATE TABLE {place}.t (a INT) USING parquet")
    monkeypatch.setattr(catalog, "_views", lambda *_: ([], ["t"]))
    assert catalog.inventory(spark, "spark_catalog", [place]).first()["kind"] == "unknown"
    with pytest.raises(backup.UnknownKind):
        backup.move_aside(spark, "spark_catalog", [place], "_old", confirm=True)
    assert spark.catalog.tableExists(f"{place}.t")
