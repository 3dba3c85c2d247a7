import gzip
import json

import pytest
from pyspark.sql import Row

from tablesync.operators import manifest as m
from tablesync.schemas import MANIFEST, SELECTIONS
from tablesync.sources import manifest as sources
from tablesync.sources.manifest import EmptyManifest, read_manifest, write_manifest

# Two windows of one table with keys of their own, one row whose key comes from its name, one whose key
# is a prefix of another's name, and one without a schema.
ROWS = [
    {"table": "sales.big-table", "k8sName": "old", "filterExpression": "day < DATE '2024-07-01'"},
    {"table": "sales.big-table", "k8sName": "new", "filterExpression": "day >= DATE '2024-07-01'"},
    {"table": "ref.unit_codes", "filterExpression": "active"},
    {"table": "ref.unit", "k8sName": "unit-ref"},
    {"table": "a-b_c", "outputSchema": "x", "source_count": 5},
]


@pytest.fixture(scope="module")
def manifest(spark):
    names = MANIFEST.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in ROWS], MANIFEST)


def test_keys(manifest):
    rows = m.with_keys(manifest).collect()
    assert [r["job_key"] for r in rows] == [
        "old", "new", "unitcodes", "unit-ref", "abc",
    ]
    assert rows[2]["state_key"] == "ref__unit_codes__unitcodes"
    assert rows[2]["legacy_key"] == "ref__unit_codes"
    assert rows[4]["state_key"] == "a-b_c__abc"


def test_targets(spark, manifest):
    rows = m.with_targets(manifest).collect()
    assert rows[2]["target_table"] == "ref.unit_codes"
    assert rows[4]["target_table"] == "x.a-b_c"
    bare = m.with_targets(spark.createDataFrame([("t",) + (None,) * 6], MANIFEST)).first()
    assert bare["target_table"] is None and bare["target_error"]


def test_key_problems(spark):
    rows = [("a.t",), ("b.t",), ("c.u",), ("c.u",), ("d." + "x" * 60,)]
    df = spark.createDataFrame([r + (None,) * 5 + (None,) for r in rows], MANIFEST)
    found = {(r["job_key"], r["problem"]) for r in m.key_problems(df).collect()}
    assert found == {("t", "same key for different tables"), ("u", "same key for several rows")}
    long = spark.createDataFrame([("a.b", None, None, None, None, "y" * 53, None)], MANIFEST)
    assert m.key_problems(long).count() == 0
    assert m.key_problems(long, name_limit=52).first()["problem"] == "key too long"


def test_long_names_keep_apart(spark):
    rows = [("a." + "x" * 60 + end,) + (None,) * 6 for end in "pq"]
    assert m.key_problems(spark.createDataFrame(rows, MANIFEST)).count() == 0


@pytest.mark.parametrize(
    "selector, rows",
    [("sales.big-table", 2), ("unit", 1), ("ref__unit_codes", 1), ("unitcodes", 1),
     ("ref__unit_codes__unitcodes", 1), ("new", 1), ("none", 0)],
)
def test_select(manifest, selector, rows):
    assert m.select_rows(manifest, selector).count() == rows


def test_selections(spark):
    rows = [
        (" graph_next ", "t1", "graph_live", None, None, None, "t1-olap", "7"),
        ("kg", "t2", " ", "t2", "ts:days", " ", None, "12x"),
        ("kg", None, None, None, None, None, None, None),
        ("kg", "gone", None, None, None, None, None, None),
    ]
    selections = spark.createDataFrame(rows, SELECTIONS)
    specs = spark.createDataFrame(
        [("graph_next.t1", "a:days", None), ("kg.gone", "", "no such table")],
        "table string, partition_columns string, error string",
    )
    made = {r["table"]: r.asDict() for r in m.normalize(selections, specs).collect()}
    assert made["graph_next.t1"] == {
        "table": "graph_next.t1", "partitionColumns": "a:days", "filterExpression": None,
        "outputSchema": "graph_live", "outputTable": None, "k8sName": "t1-olap", "source_count": 7,
    }
    assert made["kg.t2"]["partitionColumns"] == "ts:days"
    assert made["kg.t2"]["outputSchema"] is None and made["kg.t2"]["source_count"] is None
    assert made["kg.gone"]["partitionColumns"] == ""
    assert set(made) == {"graph_next.t1", "kg.t2", "kg.gone"}
    errors = sorted(r["error"] for r in m.errors(selections, specs).collect())
    assert errors == [
        "missing src_schema or src_table",
        "partition derivation failed: no such table",
        "source_count is not an integer: 12x",
    ]


def test_files(spark, manifest, tmp_path):
    path = tmp_path / "manifest.json"
    path.write_text(json.dumps(ROWS))
    want = sorted(map(tuple, manifest.collect()), key=str)
    assert sorted(map(tuple, read_manifest(spark, str(path)).collect()), key=str) == want
    write_manifest(manifest, str(tmp_path / "written"))
    again = read_manifest(spark, str(tmp_path / "written"), lines=True)
    assert sorted(map(tuple, again.collect()), key=str) == want
    for text in ("[]", "{}"):
        path.write_text(text)
        with pytest.raises(EmptyManifest):
            read_manifest(spark, str(path))


def test_plan_names_bad_rows(spark):
    specs = {"a.t": "ts:days", "a.u": "x:y:z", "a.v": "x:bucket[0]", "a.w": "x:bucket[99999999999]"}
    rows = [(t, spec) + (None,) * 5 for t, spec in specs.items()]
    plan = {r["source_table"]: r["plan_error"] for r in m.plan(spark.createDataFrame(rows, MANIFEST)).collect()}
    assert plan == {t: None if t == "a.t" else f"cannot read partition spec: {spec}" for t, spec in specs.items()}


def test_partitions_are_derived_where_a_selection_leaves_them_blank(spark):
    from tablesync.operators.copy import copy_table
    from tablesync.sources.workspace import scratch_schema

    schema = scratch_schema(spark, "derive")
    spark.sql(f"CREATE TABLE {schema}.plain USING parquet AS SELECT id, timestamp'2024-01-01 10:00:00' AS ts FROM range(3)")
    copy_table(spark, f"{schema}.plain", f"{schema}.daily", spec="ts:days")
    rows = [(schema, t, None, None, None, None, p, None) for t, p in (("daily", " "), ("plain", None), ("gone", ""), ("daily", "id"))]
    selections = spark.createDataFrame(
        rows,
        "src_schema string, src_table string, tgt_schema string, tgt_table string, filter_expression string, k8s_name string, partition_columns string, source_count string",
    )
    found = m.normalize(selections, auto_derive=True).select("table", "partitionColumns").collect()
    assert sorted((r[0].split(".")[1], r[1]) for r in found) == [("daily", "id"), ("daily", "ts:days"), ("gone", ""), ("plain", "")]


def test_a_large_array_is_read_in_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sources, "WHOLE_FILE", 2000, raising=False)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    texts = ["a = '}'", 'b = "{"', "c = '\\'", "},{", "é = '\n'", None]
    rows = [
        {"table": f"s.t{i}", "filterExpression": texts[i % 6], "source_count": i, "other": {"x": [{"}": i}, {}], "y": "["}}
        for i in range(200)
    ]
    few = [{"table": "s.few", "source_count": "x"}]
    try:
        for i, indent in enumerate((None, 2)):
            (tmp_path / f"{i}.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=bool(i)))
        (tmp_path / "2.json.gz").write_bytes(gzip.compress(json.dumps(rows).encode()))
        (tmp_path / "few.json").write_text(json.dumps(few))
        found = read_manifest(spark, str(tmp_path))
        assert found.schema == MANIFEST
        want = [(r["table"], r["filterExpression"], r["source_count"]) for r in rows] * 3 + [("s.few", None, None)]
        assert sorted(map(str, found.select("table", "filterExpression", "source_count").toLocalIterator())) == sorted(
            str(Row(table=t, filterExpression=f, source_count=n)) for t, f, n in want
        )
        # What is read element by element is not read by Spark's own reader too.
        own = spark.read.schema(MANIFEST).option("multiLine", True).json(str(tmp_path))
        assert own.where("_metadata.file_size <= 2000 AND NOT endswith(_metadata.file_path, '.gz')").rdd.getNumPartitions() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("end", ["]", ', {"table": "s.x", "source_count": "x", "table": null}, {"table": {"a":\n 1.50}, "source_count": 3}, {"table": 1.50}, {"table": "\\u00e9", "table": ["}"]}, {"source_count": 9e99}]', "", "]]", "\n[{}]", ", {'table': 's.quoted }'}]", ", 1]", ',{"table": x}]', ',{"table": "s.open}]'])
def test_a_large_file_has_the_rows_that_spark_reads(spark, tmp_path, monkeypatch, end):
    text = "[" + ",".join(json.dumps({"table": f"s.t{i}", "source_count": i}) for i in range(100)) + end
    (tmp_path / "odd.json").write_text(text)
    (tmp_path / "good.json").write_text(json.dumps([{"table": f"s.g{i}"} for i in range(100)]))
    want = sorted(map(str, read_manifest(spark, str(tmp_path)).collect()))
    monkeypatch.setattr(sources, "WHOLE_FILE", 1000, raising=False)
    assert sorted(map(str, read_manifest(spark, str(tmp_path)).collect())) == want


def test_an_array_is_read_as_a_stream():
    def pieces():
        yield b'[{"table": "a"'
        yield b', {"table": {"b": "'
        yield b'"'
        yield b""
        yield b', {"table": "c"'
        pytest.fail("more is read than the element needs")

    found = sources._objects(pieces())
    assert [next(found) for _ in range(2)] == ['{"table": "a"}', '{"table": {"b": "}"}}']


def test_each_array_has_a_file_of_its_own(spark, tmp_path):
    from workloads import QUERIES

    orders = spark.range(2000).selectExpr(
        "id AS o_orderkey", "id % 90 AS o_custkey", "element_at(array('P', 'F', 'O'), int(id % 3) + 1) AS o_orderstatus",
        "element_at(array('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW'), int(id % 4) + 1) AS o_orderpriority",
    )
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = QUERIES["manifest_array_file"](spark, str(tmp_path))
        assert found.count() == 2000 and found.select("source_count").distinct().count() == 90
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
