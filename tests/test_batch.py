import pytest

from tablesync.operators import views
from tablesync.operators.validate import TablePair, count_parity, filter_lookup, validate_pairs
from tablesync.operators.state import conform
from tablesync.plans.batch import BadManifest, copy_batch, publish_batch, validate_batch, validate_views
from tablesync.schemas import MANIFEST, TABLE_STATE, VIEW_SPECS, VIEW_STATE
from tablesync.sources.state import StateTable
from tablesync.sources.workspace import scratch_schema


class Run:
    def __init__(self, spark):
        self.spark = spark
        self.source, self.target = scratch_schema(spark, "source"), scratch_schema(spark, "target")
        place = scratch_schema(spark, "state")
        self.state = StateTable(spark, place, "tables", TABLE_STATE)
        self.views = StateTable(spark, place, "views", VIEW_STATE)

    def table(self, name, rows=20):
        self.spark.range(rows).selectExpr("id", "id % 4 AS k").write.saveAsTable(f"{self.source}.{name}")

    def manifest(self, *rows):
        full = [
            (f"{self.source}.{name}", spec, where, self.target, new, job, None)
            for name, spec, where, new, job in rows
        ]
        return self.spark.createDataFrame(full, MANIFEST).coalesce(1)

    def statuses(self, column="apply_status"):
        return {
            r["source_table"].split(".")[-1]: r[column] for r in self.state.load().collect()
        }


@pytest.fixture
def run(spark):
    return Run(spark)


def test_a_failed_batch_goes_on_where_it_stopped(spark, run):
    for name in ("a", "b", "c"):
        run.table(name)
    bad = run.manifest(("a", "k", None, None, None), ("b", "k", "nope = 1", None, None), ("c", "", None, None, None))
    copy_batch(spark, bad, run.state)
    assert run.statuses() == {"a": "success", "b": "failed"}
    # Only the failed and the later rows are done: the copy of a keeps what is put in its place.
    spark.sql(f"INSERT OVERWRITE {run.target}.a PARTITION (k = 0) SELECT 99")
    good = run.manifest(("a", "k", None, None, None), ("b", "k", "k = 1", None, None), ("c", "", None, None, None))
    copy_batch(spark, good, run.state)
    assert run.statuses() == {"a": "success", "b": "success", "c": "success"}
    assert spark.table(f"{run.target}.a").where("id = 99").count() == 1
    assert spark.table(f"{run.target}.b").count() == 5
    copy_batch(spark, good, run.state, rerun_all=True)
    assert spark.table(f"{run.target}.a").where("id = 99").count() == 0


def test_continue_on_failure(spark, run):
    run.table("b")
    manifest = run.manifest(("gone", "", None, None, None), ("b", "x:y:z", None, None, "b1"), ("b", "", None, "n", "b2"))
    copy_batch(spark, manifest, run.state, continue_on_failure=True)
    found = {r["k8s_name"]: r["apply_status"] for r in run.state.load().collect()}
    assert found == {"gone": "failed", "b1": "failed", "b2": "success"}
    assert spark.table(f"{run.target}.n").count() == 20


def test_windows_of_one_table_are_merged(spark, run):
    run.table("a")
    manifest = run.manifest(("a", "k", "id < 11", None, "a-1"), ("a", "k", "id >= 11", None, "a-2"))
    copy_batch(spark, manifest, run.state)
    assert sorted(r["id"] for r in spark.table(f"{run.target}.a").collect()) == list(range(20))


def test_two_sources_of_one_target_are_refused(spark, run):
    run.table("a")
    run.table("b", rows=5)
    rows = run.manifest(("a", "", None, "t", "a1"), ("b", "", None, "t", "b1"), ("a", "", None, None, "a2"))
    found = {r["k8s_name"]: r for r in copy_batch(spark, rows, run.state, continue_on_failure=True).collect()}
    assert [found[k]["apply_status"] for k in ("a1", "b1", "a2")] == ["failed", "failed", "success"]
    assert "several sources" in found["a1"]["apply_error"]
    assert not spark.catalog.tableExists(f"{run.target}.t")


@pytest.mark.parametrize("second", ["id > 11", "id >= 10"])
def test_windows_with_gaps_or_overlaps_are_refused(spark, run, second):
    run.table("a")
    rows = run.manifest(("a", "k", "id < 11", None, "a-1"), ("a", "k", second, None, "a-2"))
    done = copy_batch(spark, rows, run.state, continue_on_failure=True).collect()
    assert {r["apply_status"] for r in done} == {"failed"}
    assert not spark.catalog.tableExists(f"{run.target}.a")


def test_a_new_column_is_merged_and_a_lost_one_is_an_error(spark, run):
    run.table("a")
    rows = run.manifest(("a", "k", None, None, None))
    copy_batch(spark, rows, run.state)
    spark.sql(f"ALTER TABLE {run.source}.a ADD COLUMNS (more STRING)")
    spark.sql(f"INSERT INTO {run.source}.a VALUES (100, 1, 'x')")
    validate_batch(spark, rows, run.state)
    assert run.statuses("validation_status") == {"a": "error"}
    copy_batch(spark, rows, run.state, rerun_all=True)
    assert spark.table(f"{run.target}.a").where("more = 'x'").count() == 1
    validate_batch(spark, rows, run.state)
    assert run.state.load().first()["source_count"] == 21


def test_selected_rows_only(spark, run):
    run.table("a")
    run.table("b")
    rows = run.manifest(("a", "", None, None, None), ("b", "", None, None, None))
    copy_batch(spark, rows, run.state, selectors=("b",))
    assert run.statuses() == {"b": "success"}


def test_job_keys_of_several_rows_stop_the_lookup(spark):
    manifest = spark.createDataFrame([("a.t", None, "x = 1") + (None,) * 4, ("b.t", None, "x = 2") + (None,) * 4], MANIFEST)
    state = conform(spark.createDataFrame([("t",)], "k8s_name string"), TABLE_STATE)
    with pytest.raises(Exception, match="several manifest rows"):
        filter_lookup(state, manifest, "").collect()


def test_keys_must_be_unique(spark, run):
    run.table("a")
    with pytest.raises(BadManifest):
        copy_batch(spark, run.manifest(*[("a", "", None, None, None)] * 2), run.state)


def test_batch_validation(spark, run):
    for name in ("a", "b"):
        run.table(name)
    manifest = run.manifest(("a", "k", "k = 1", None, None), ("b", "k", None, None, None))
    copy_batch(spark, manifest, run.state)
    spark.sql(f"INSERT INTO {run.target}.a SELECT 500, 3")  # beyond the filter
    spark.sql(f"DROP TABLE {run.target}.b")
    validate_batch(spark, manifest, run.state)
    found = {r["source_table"].split(".")[-1]: r for r in run.state.load().collect()}
    # The source has no partitions, so its spec is not that of the copy.
    assert found["a"]["validation_status"] == "mismatch" and found["a"]["partition_match"] is False
    assert (found["a"]["source_count"], found["a"]["target_count"], found["a"]["target_count_total"]) == (5, 5, 6)
    assert found["b"]["validation_status"] == "error" and found["b"]["validation_error"]


def test_filter_lookup_cases(spark):
    """No manifest row: the fallback. A manifest row without a filter: unfiltered."""
    manifest = spark.createDataFrame(
        [
            ("shop.unit_prices", None, "changed_on < '2031-03-01'", None, None, None, None),
            ("shop.unit_names", None, None, None, None, "names-2", None),
        ],
        MANIFEST,
    )
    state = conform(
        spark.createDataFrame([("unitprices",), ("names-2",), ("absent",)], "k8s_name string"),
        TABLE_STATE,
    )
    found = {r["k8s_name"]: r["where_sql"] for r in filter_lookup(state, manifest, "x = 1").collect()}
    assert found == {
        "unitprices": "changed_on < '2031-03-01'", "names-2": "", "absent": "x = 1",
    }


def test_all_pairs_are_one_action(spark, run):
    run.table("a")
    pairs = [TablePair(str(i), f"{run.source}.a", f"{run.source}.a", "k = 1" if i % 2 else "") for i in range(5)]
    group = "one action"
    spark.sparkContext.setJobGroup(group, group)
    counts = count_parity(spark, pairs).collect()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {(r["source_count"], r["target_count_total"]) for r in counts} == {(5, 20), (20, 20)}


def test_an_unreadable_table_costs_the_others_nothing(spark, run):
    run.table("a")
    pairs = [
        TablePair("good", f"{run.source}.a", f"{run.source}.a"),
        TablePair("bad", f"{run.source}.a", f"{run.source}.a", "CAST(CONCAT('x', id) AS INT) = 1"),
        TablePair("none", f"{run.source}.none", f"{run.source}.a"),
    ]
    found = {r["pair_key"]: r["validation_status"] for r in validate_pairs(spark, pairs).collect()}
    assert found == {"good": "ok", "bad": "error", "none": "error"}


def test_views(spark, run):
    run.table("base")
    spark.sql(f"CREATE VIEW {run.source}.v AS SELECT id AS row_key, k FROM {run.source}.base")
    specs = spark.createDataFrame(
        [(f"{run.source}.v", "w", run.target, None, None, "k < 3", None, None)], VIEW_SPECS
    )
    dry = publish_batch(spark, specs, run.views, dry_run=True)
    assert dry.first()["target_ddl"].startswith("CREATE OR REPLACE VIEW spark_catalog.")
    assert run.views.load().count() == 0
    publish_batch(spark, specs, run.views)
    assert run.views.load().first()["migrate_status"] == "success"
    assert publish_batch(spark, specs, run.views, dry_run=True).count() == 0
    done = validate_views(spark, specs, run.views, default_key="row_key").first()
    assert (done["validation_status"], done["source_count"], done["mismatched_rows"]) == ("ok", 15, 0)
    bad = spark.createDataFrame(
        [(f"{run.source}.v", "w", run.target, None, None, "k < 3", "no_key", None),
         (f"{run.source}.none", None, None, None, None, "k < 3", None, None)],
        VIEW_SPECS,
    )
    place = StateTable(spark, scratch_schema(spark, "state"), "views", VIEW_STATE)
    found = {r["view_key"].split(" ")[0].split(".")[-1]: r for r in validate_views(spark, bad, place).collect()}
    assert found["v"]["validation_status"] == found["none"]["validation_status"] == "error"
    assert "no_key" in found["v"]["validation_error"]


def test_a_bad_spec_is_recorded_and_the_others_go_on(spark, run):
    run.table("base")
    spark.sql(f"CREATE VIEW {run.source}.v AS SELECT id, k FROM {run.source}.base")
    rows = [("no_dot",) + (None,) * 7, (f"{run.source}.v", "w", run.target) + (None,) * 5]
    done = publish_batch(spark, spark.createDataFrame(rows, VIEW_SPECS), run.views)
    found = {r["view_key"].split(".")[-1]: r for r in done.collect()}
    assert found["no_dot"]["migrate_status"] == "failed" and "no_dot" in found["no_dot"]["migrate_error"]
    assert found["w"]["migrate_status"] == "success"
    checked = validate_views(spark, spark.createDataFrame(rows, VIEW_SPECS), run.views, default_key="id")
    found = {r["view_key"].split(".")[-1]: r for r in checked.collect()}
    assert (found["w"]["validation_status"], found["w"]["source_count"]) == ("ok", 20)
    assert found["no_dot"]["validation_status"] == "error"


def test_view_defaults(spark):
    specs = spark.createDataFrame([("sales.orders_open",) + (None,) * 7], VIEW_SPECS)
    row = views.resolve(
        specs, source_catalog="a", target_catalog="b", location_root="s3://x", base_suffix="__base",
        default_key="id", default_casts=("tags",),
    ).first()
    assert row["base_table"] == "sales.orders_open__base"
    assert row["join_key"] == "id" and row["cast_to_string"] == ["tags"]
    assert row["filter_expression"] == ""
    assert row["target_location"] == "s3://x/sales.db/orders_open"
    assert row["target_view_fqn"] == "b.sales.orders_open"


def rewritten(spark, ddl, location):
    return views.rewrite_ddl(
        spark, ddl, source_view="db.v", target_view="t.w", base_table="db.base", location=location, source_catalog="c1", target_catalog="c2"
    )


def test_no_location_takes_the_sources_out(spark):
    old = ["CREATE VIEW db.v TBLPROPERTIES ('location' = 'a') AS SELECT 1", "CREATE VIEW db.v TBLPROPERTIES ('x' = '1', 'location' = 'a') AS SELECT 1"]
    assert [rewritten(spark, ddl, None) for ddl in old] == [
        "CREATE OR REPLACE VIEW t.w AS SELECT 1", "CREATE OR REPLACE VIEW t.w TBLPROPERTIES ('x' = '1') AS SELECT 1",
    ]


@pytest.mark.parametrize(
    "ddl, want",
    [
        ("CREATE VIEW db.v AS SELECT * FROM db.v", "CREATE OR REPLACE VIEW t.w AS SELECT * FROM c2.db.base"),
        ("create view `db`.`v` as select * from `c1`.`db`.`v`", "CREATE OR REPLACE VIEW t.w as select * from c2.db.base"),
        ("CREATE OR REPLACE VIEW db.v AS SELECT * FROM db.v2 JOIN db.v x", "CREATE OR REPLACE VIEW t.w AS SELECT * FROM db.v2 JOIN c2.db.base x"),
        ("CREATE VIEW db.v AS SELECT * FROM c1.x.y JOIN c2.x.z", "CREATE OR REPLACE VIEW t.w AS SELECT * FROM c2.x.y JOIN c2.x.z"),
        ("CREATE VIEW db.v TBLPROPERTIES ('location' = 'a') AS SELECT 1", "CREATE OR REPLACE VIEW t.w TBLPROPERTIES ('location' = 's3://$1') AS SELECT 1"),
        ("CREATE VIEW db.v LOCATION 'a' AS SELECT 1", "CREATE OR REPLACE VIEW t.w LOCATION 's3://$1' AS SELECT 1"),
        ("CREATE VIEW db.v AS SELECT 1", "CREATE OR REPLACE VIEW t.w AS SELECT 1"),
        # an alias, a column and literals that look like the catalog or the view
        (
            "CREATE VIEW db.v AS SELECT c1.id, 'c1.x from db.v' AS c, \"c1.y\" FROM c1.db.t c1 WHERE c1.db > 'it''s FROM c1.a.b'",
            "CREATE OR REPLACE VIEW t.w AS SELECT c1.id, 'c1.x from db.v' AS c, \"c1.y\" FROM c2.db.t c1 WHERE c1.db > 'it''s FROM c1.a.b'",
        ),
        # comments, comma joins, subqueries, names of a WITH, blanks within names
        (
            "/* c1.a.b */ CREATE VIEW db.v (id COMMENT 'AS c1.a.b') AS WITH v AS (SELECT * FROM DB.V), u AS (SELECT 1 AS x) "
            "SELECT (SELECT MAX(x) FROM c1.a.b) FROM v, u, c1 . `a`.b z, c1.a.`c.d` -- FROM c1.a.b\n WHERE EXISTS (TABLE db.v)",
            "/* c1.a.b */ CREATE OR REPLACE VIEW t.w (id COMMENT 'AS c1.a.b') AS WITH v AS (SELECT * FROM c2.db.base), u AS (SELECT 1 AS x) "
            "SELECT (SELECT MAX(x) FROM c2.a.b) FROM v, u, c2 . `a`.b z, c2.a.`c.d` -- FROM c1.a.b\n WHERE EXISTS (TABLE c2.db.base)",
        ),
        # a schema that is called like the catalog, another view's name, characters beyond 16 bits before a name
        (
            "CREATE VIEW db.other AS SELECT '\U0001f600' AS s FROM c1.v JOIN c1.c1.v ON true",
            "CREATE VIEW db.other AS SELECT '\U0001f600' AS s FROM c1.v JOIN c2.c1.v ON true",
        ),
    ],
)
def test_ddl_rewrite(spark, ddl, want):
    assert rewritten(spark, ddl, "s3://$1") == want


def test_a_text_spark_cannot_read_is_an_error(spark):
    specs = spark.createDataFrame([("db.v",) + (None,) * 7, ("db.u",) + (None,) * 7], VIEW_SPECS)
    texts = spark.createDataFrame([("c1.db.v", "CREATE VIEW db.v AS SELEC 1"), ("c1.db.u", "CREATE VIEW db.u AS SELECT 1")], "fqn string, ddl string")
    found = views.rewrite(texts, views.resolve(specs, source_catalog="c1", target_catalog="c2"), source_catalog="c1", target_catalog="c2")
    rows = {r["view_full"]: r for r in found.collect()}
    assert rows["db.v"]["target_ddl"] is None and "SELEC" in rows["db.v"]["ddl_error"]
    assert rows["db.u"]["target_ddl"] == "CREATE OR REPLACE VIEW c2.db.u AS SELECT 1" and rows["db.u"]["ddl_error"] is None


def test_one_reading_of_a_parsed_text_finds_its_relations(spark, monkeypatch):
    monkeypatch.setattr("tablesync.functions.sqltext._nodes", lambda *_, **__: pytest.fail("the plan is walked"))
    ddl = "CREATE VIEW db.v AS WITH v AS (SELECT r'\\', 'c1.a.b' FROM db.v) SELECT c1.a.b.x FROM v, c1.a.b VERSION AS OF 1 WHERE k IN (TABLE c1.`d``e`.f)"
    assert rewritten(spark, ddl, None) == (
        "CREATE OR REPLACE VIEW t.w AS WITH v AS (SELECT r'\\', 'c1.a.b' FROM c2.db.base) "
        "SELECT c1.a.b.x FROM v, c2.a.b VERSION AS OF 1 WHERE k IN (TABLE c2.`d``e`.f)"
    )


def test_relations_that_only_the_parser_sees_move_too(spark):
    spark.conf.set("spark.sql.ansi.doubleQuotedIdentifiers", "true")
    try:
        assert rewritten(spark, 'CREATE VIEW db.v AS SELECT "a" FROM "db"."v"', None) == 'CREATE OR REPLACE VIEW t.w AS SELECT "a" FROM c2.db.base'
    finally:
        spark.conf.unset("spark.sql.ansi.doubleQuotedIdentifiers")


def test_the_driver_holds_few_texts(spark, monkeypatch):
    monkeypatch.setattr(views, "TEXTS_HELD", 3, raising=False)
    made, create = [], type(spark).createDataFrame

    def counted(self, rows, *args, **options):
        made.append(len(rows))
        return create(self, rows, *args, **options)

    specs = create(spark, [(f"db.v{i}",) + (None,) * 7 for i in range(10)], VIEW_SPECS)
    texts = create(spark, [(f"c1.db.v{i}", f"CREATE VIEW db.v{i} AS SELECT {i}") for i in range(10)], "fqn string, ddl string")
    monkeypatch.setattr(type(spark), "createDataFrame", counted)
    found = views.rewrite(texts, views.resolve(specs, source_catalog="c1", target_catalog="c2"), source_catalog="c1", target_catalog="c2")
    assert {r["target_ddl"] for r in found.collect()} == {f"CREATE OR REPLACE VIEW c2.db.v{i} AS SELECT {i}" for i in range(10)}
    assert max(made) <= 3


def test_texts_are_parsed_where_their_rows_are(spark, monkeypatch):
    monkeypatch.setattr(views, "rewrite_ddl", lambda *_, **__: pytest.fail("a text is read by the driver"))
    ddls = {
        "plain": ("SELECT c1.id, 'c1.a.b' FROM c1.a.b c1 JOIN `c1`.`db`.`v0` USING (id)", "SELECT c1.id, 'c1.a.b' FROM c2.a.b c1 JOIN c2.`db`.`v0` USING (id)"),
        "nested": ("WITH v AS (SELECT * FROM c1.a.b) SELECT (SELECT 1 FROM v) FROM v -- c1.a.b", "WITH v AS (SELECT * FROM c2.a.b) SELECT (SELECT 1 FROM v) FROM v -- c1.a.b"),
        "own": ("SELECT * FROM db.own WHERE k IN (TABLE c1.x.y)", "SELECT * FROM c2.db.own WHERE k IN (TABLE c2.x.y)"),
    }
    specs = spark.createDataFrame([(f"db.{v}",) + (None,) * 7 for v in (*ddls, "none")], VIEW_SPECS)
    texts = spark.createDataFrame([(f"c1.db.{v}", f"CREATE VIEW db.{v} AS {old}") for v, (old, _) in ddls.items()], "fqn string, ddl string")
    found = views.rewrite(texts, views.resolve(specs, source_catalog="c1", target_catalog="c2"), source_catalog="c1", target_catalog="c2")
    rows = {r["view_full"]: (r["target_ddl"], r["ddl_error"]) for r in found.collect()}
    assert rows == {f"db.{v}": (f"CREATE OR REPLACE VIEW c2.db.{v} AS {new}", None) for v, (_, new) in ddls.items()} | {"db.none": (None, None)}


def test_the_driver_reads_what_tasks_cannot(spark):
    spark.conf.set("spark.sql.ansi.doubleQuotedIdentifiers", "true")
    spark.conf.set("moved.view", "c1.x.y")
    ddls = {"quoted": 'SELECT "a" FROM "c1"."a"."b"', "variable": "SELECT 1 FROM ${moved.view} JOIN c1.x.z", "bad": "SELEC 1 FROM c1.x.y"}
    try:
        specs = spark.createDataFrame([(f"db.{v}",) + (None,) * 7 for v in ddls] * 2, VIEW_SPECS)
        texts = spark.createDataFrame([(f"c1.db.{v}", f"CREATE VIEW db.{v} AS {ddl}") for v, ddl in ddls.items()], "fqn string, ddl string")
        resolved = views.resolve(specs, source_catalog="c1", target_catalog="c2")
        found = views.rewrite(texts, resolved, source_catalog="c1", target_catalog="c2").collect()
        for name, ddl in ddls.items():
            both = [(r["target_ddl"], r["ddl_error"]) for r in found if r["view_full"] == f"db.{name}"]
            options = dict(source_view=f"db.{name}", target_view=f"c2.db.{name}", base_table=f"db.{name}", location=None, source_catalog="c1", target_catalog="c2")
            if name == "bad":
                assert len(both) == 2 and both[0][0] is None and "SELEC" in both[0][1]
            else:
                assert both == [(views.rewrite_ddl(spark, f"CREATE VIEW db.{name} AS {ddl}", **options), None)] * 2
    finally:
        spark.conf.unset("spark.sql.ansi.doubleQuotedIdentifiers")
        spark.conf.unset("moved.view")
