from collections import Counter

import pytest

from tablesync.operators import state as s
from tablesync.schemas import MANIFEST, TABLE_STATE, VIEW_STATE
from tablesync.sources.state import StateTable, read_csv, write_csv
from tablesync.sources.workspace import scratch_schema


def rows(df, *columns):
    return {tuple(r[c] for c in columns) for r in df.collect()}


def state_of(spark, *rows_):
    df = spark.createDataFrame(rows_, "table_key string, apply_status string")
    return s.conform(df, TABLE_STATE)


def test_missing_file_is_empty(spark, tmp_path):
    found = read_csv(spark, str(tmp_path / "none.csv"), TABLE_STATE)
    assert found.columns == TABLE_STATE.fieldNames() and found.count() == 0


def test_files_of_people(spark, tmp_path):
    path = tmp_path / "table_state.csv"
    path.write_text(
        "table_suffix,apply_status,source_count,note,partition_match\n"
        "kg__t,SUCCESS,12,mine,true\nkg__u,,many,,\n"
    )
    found = read_csv(spark, str(path), TABLE_STATE)
    assert found.columns == [*TABLE_STATE.fieldNames(), "note"]
    assert rows(found, "table_key", "apply_status", "source_count", "note", "partition_match") == {
        ("kg__t", "SUCCESS", 12, "mine", True),
        ("kg__u", None, None, None, None),
    }
    write_csv(found, str(tmp_path / "out"))
    again = read_csv(spark, str(tmp_path / "out"), TABLE_STATE)
    assert rows(again, *again.columns) == rows(found, *found.columns)


def test_upsert_changes_only_what_is_given_and_can_be_repeated(spark):
    state = state_of(spark, ("a", "failed"), ("b", "success"))
    updates = spark.createDataFrame(
        [("a", "success", 5), ("c", None, 7)], "table_key string, apply_status string, source_count long"
    )
    once = s.upsert(state, updates, "table_key")
    want = {("a", "success", 5), ("b", "success", None), ("c", None, 7)}
    assert rows(once, "table_key", "apply_status", "source_count") == want
    assert rows(s.upsert(once, updates, "table_key"), "table_key", "apply_status", "source_count") == want
    assert once.columns == state.columns


def test_pending_and_skipped(spark):
    work = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "table_key string")
    state = state_of(spark, ("a", " SUCCESS "), ("b", None), ("c", "failed"))
    assert rows(s.pending(work, state, "table_key", "apply_status"), "table_key") == {("b",), ("c",), ("d",)}
    assert rows(s.skipped(work, state, "table_key", "apply_status"), "table_key") == {("a",)}


def test_reset(spark):
    state = state_of(spark, ("a", "success")).withColumn("validation_status", s.F.lit("ok"))
    assert rows(s.reset(state), "table_key", "apply_status", "validation_status") == {("a", "success", None)}


def test_older_keys(spark):
    manifest = spark.createDataFrame(
        [("kg.t",) + (None,) * 6, ("kg.u", None, None, None, None, "u-1", None)], MANIFEST
    )
    state = state_of(spark, ("kg__t", "Success"), ("kg__u", "failed"), ("kg__u__u-1", "success"), ("x", "failed"))
    status = {r["table"]: r["status"] for r in s.status_of(manifest, state).collect()}
    assert status == {"kg.t": "success", "kg.u": "success"}
    upgraded = s.upgrade(state, manifest)
    want = {("kg__t__t", "Success"), ("kg__u__u-1", "success"), ("x", "failed")}
    assert rows(upgraded, "table_key", "apply_status") == want
    assert rows(s.upgrade(upgraded, manifest), "table_key", "apply_status") == want


def test_seed_and_summary(spark):
    manifest = spark.createDataFrame([("kg.t", None, None, "o", None, None, None)], MANIFEST)
    seeded = s.seed(manifest)
    assert rows(seeded, "table_key", "target_table", "k8s_name", "apply_status") == {("kg__t__t", "o.t", "t", None)}
    state = state_of(spark, ("a", "failed"), ("b", "Success"), ("c", ""), ("d", None))
    assert rows(s.summary(state, "apply_status"), "status", "n") == {("failed", 1), ("success", 1)}


def test_labels(spark):
    found = spark.createDataFrame(
        [("ok", 1, 1, 0, None), ("Mismatch", 1, 2, 3, None), ("error", None, None, None, "e" * 200), (None,) * 5],
        "validation_status string, source_count long, target_count long, mismatched_rows long, validation_error string",
    )
    labels = [r[0] for r in found.select(s.status_label(found)).collect()]
    assert labels == ["OK", "DIFF (source=1, target=2, mismatched_rows=3)", "ERROR: " + "e" * 120, "PENDING"]


@pytest.mark.parametrize("schema", [TABLE_STATE, VIEW_STATE])
def test_state_table(spark, schema):
    place = scratch_schema(spark, "state")
    state = StateTable(spark, place, "run", schema)
    assert state.load().count() == 0
    key = schema.fieldNames()[0]
    state.record(**{key: "a", "validation_status": "ok"})
    state.record(**{key: "b", "source_count": 3})
    state.record(**{key: "a", "source_count": 1})
    assert rows(state.load(), key, "validation_status", "source_count") == {("a", "ok", 1), ("b", None, 3)}
    tables = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {place}").where("NOT isTemporary").collect()]
    assert sorted(tables) == ["run", "run__log1", "run__v1"]  # records cost no rewrite
    state.record(**{key: "a", "validation_status": None})
    for _ in range(3):
        state.compact()
    assert rows(state.load(), key, "validation_status", "source_count") == {("a", None, 1), ("b", None, 3)}
    tables = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {place}").where("NOT isTemporary").collect()]
    assert sorted(tables) == ["run", "run__log3", "run__log4", "run__v3", "run__v4"]


def test_cells_with_breaks_and_quotes(spark, tmp_path):
    path = tmp_path / "table_state.csv"
    path.write_text('table_key,apply_status,apply_error\na,failed,"line 1\nsaid ""no"", twice"\nb,success,\n')
    found = read_csv(spark, str(path), TABLE_STATE)
    want = {("a", "failed", 'line 1\nsaid "no", twice'), ("b", "success", None)}
    assert rows(found, "table_key", "apply_status", "apply_error") == want
    write_csv(found, str(tmp_path / "out"))
    assert rows(read_csv(spark, str(tmp_path / "out"), TABLE_STATE), "table_key", "apply_status", "apply_error") == want


def test_states_of_the_workload_are_under_both_kinds_of_key(spark, tmp_path):
    import __spark_entry__ as entry

    columns = ["id AS o_orderkey", "id * 100 AS o_custkey", "substr('FPO', CAST(id % 3 AS INT) + 1, 1) AS o_orderstatus"]
    rows = spark.range(9).selectExpr(*columns, "'5-LOW' AS o_orderpriority")
    rows.write.parquet(f"{tmp_path}/orders.parquet")
    status = Counter(r["status"] for r in entry.queries()["state_status"](spark, str(tmp_path)).collect())
    # P has the older key; of F (0, 3, 6) those with a small count have their own.
    assert status == {"success": 3, "failed": 2, "": 4}
    kept = {r["table_key"] for r in entry.queries()["state_upgrade"](spark, str(tmp_path)).collect()}
    assert {"codes__orders_0_x-y__orders0xy", "codes__orders_3_x-y__orders3xy"} <= kept and len(kept) == 5
