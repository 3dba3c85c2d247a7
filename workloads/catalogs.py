"""Inventories, views and backups of schemas that hold the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tablesync.operators import backup, views
from tablesync.operators.copy import copy_table
from tablesync.plans.batch import publish_batch, validate_views
from tablesync.schemas import VIEW_SPECS, VIEW_STATE
from tablesync.sources import catalog
from tablesync.sources.properties import snapshot_by_metadata, snapshot_by_sql
from tablesync.sources.state import StateTable
from tablesync.sources.workspace import scratch_schema, shared_folder
from workloads.base import TABLES, ORDERS_COPY, attach, counts_of, derived, query, table

CATALOG = "spark_catalog"
ALL_COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {{{t}}}" for t in TABLES
)


@query("inventory_counts", ALL_COUNTS)
def inventory_counts(spark, folder):
    counts = catalog.count_tables(spark, {t: table(spark, folder, t) for t in TABLES})
    return counts.select("table_name", "row_count")


@query(
    "inventory_counts_filtered",
    f"""WITH t AS ({ORDERS_COPY})
    SELECT 'orders' AS table_name, COUNT(*) AS row_count, false AS failed FROM {{orders}} WHERE o_totalprice > 100000
    UNION ALL SELECT 'orders_copy', COUNT(*), false FROM t WHERE o_totalprice > 100000
    UNION ALL SELECT 'lineitem', NULL, true""",
)
def inventory_counts_filtered(spark, folder):
    """A table without the filter's column has an error and no count."""
    tables = {
        "orders": table(spark, folder, "orders"),
        "orders_copy": derived(spark, folder, ORDERS_COPY),
        "lineitem": table(spark, folder, "lineitem"),
    }
    counts = catalog.count_tables(spark, tables, "o_totalprice > 100000")
    return counts.select("table_name", "row_count", F.col("count_error").isNotNull().alias("failed"))


@query(
    "relation_inventory",
    "SELECT table_name AS name, 'table' AS kind, row_count FROM ("
    + ALL_COUNTS
    + ") c UNION ALL SELECT 'open_orders', 'view', NULL",
)
def relation_inventory(spark, folder):
    schema = scratch_schema(spark, "source")
    attach(spark, schema, folder)
    spark.sql(f"CREATE VIEW {schema}.open_orders AS SELECT * FROM {schema}.orders WHERE o_orderstatus = 'O'")
    return catalog.counted_inventory(spark, CATALOG, [schema]).select("name", "kind", "row_count")


SPECS = {
    "orders": ("o_orderdate:years", "1: o_orderdate_year: years(o_orderdate)"),
    "events": ("ts:days,event_type", "1: ts_day: days(ts); 2: event_type: identity(event_type)"),
    "part": ("p_partkey:bucket[4]", "1: p_partkey_bucket: bucket[4](p_partkey)"),
    "customer": ("", "Not partitioned"),
}


@query(
    "table_summary",
    " UNION ALL ".join(
        f"SELECT '{t}' AS name, '{spec}' AS partition_columns, '{shown}' AS partition_spec_display, "
        f"COUNT(*) AS row_count FROM {{{t}}}"
        for t, (spec, shown) in SPECS.items()
    ),
)
def table_summary(spark, folder):
    """Specs of copied tables, read back from the catalog, next to their counts."""
    source, target = scratch_schema(spark, "source"), scratch_schema(spark, "target")
    attach(spark, source, folder, list(SPECS))
    for name, (spec, _) in SPECS.items():
        copy_table(spark, f"{source}.{name}", f"{target}.{name}", spec=spec)
    found = catalog.summarize_tables(spark, CATALOG, [target])
    counts = counts_of(spark, {t: f"{target}.{t}" for t in SPECS})
    return found.join(counts, found["table"] == counts["name"]).select(
        "name", "partition_columns", "partition_spec_display", F.col("rows").alias("row_count")
    )


AUDITED = {
    "orders": ("o_orderdate:months", "DATE_TRUNC('month', o_orderdate)"),
    "lineitem": ("l_returnflag,l_linestatus", "CONCAT(l_returnflag, l_linestatus)"),
    "part": ("p_partkey:truncate[100]", "p_partkey - p_partkey % 100"),
}


@query(
    "partition_spec_audit",
    " UNION ALL ".join(
        f"SELECT '{t}' AS name, '{spec}' AS partition_columns, COUNT(DISTINCT {value}) AS partitions FROM {{{t}}}"
        for t, (spec, value) in AUDITED.items()
    ),
)
def partition_spec_audit(spark, folder):
    """The spec of each copy and the partitions it really has."""
    source, target = scratch_schema(spark, "source"), scratch_schema(spark, "target")
    attach(spark, source, folder, list(AUDITED))
    frames = []
    for name, (spec, _) in AUDITED.items():
        copy_table(spark, f"{source}.{name}", f"{target}.{name}", spec=spec)
        shown = spark.sql(f"SHOW PARTITIONS {target}.{name}").agg(F.count(F.lit(1)).alias("partitions"))
        frames.append(shown.select(F.lit(f"{CATALOG}.{target}.{name}").alias("fqn"), "partitions"))
    made = frames[0].unionByName(frames[1]).unionByName(frames[2])
    specs = catalog.partition_specs(spark, [f"{CATALOG}.{target}.{name}" for name in AUDITED])
    return specs.join(made, "fqn").select(
        F.substring_index("fqn", ".", -1).alias("name"), "partition_columns", "partitions"
    )


@query(
    "view_summary",
    """SELECT 'open_orders' AS view, 'CREATE VIEW' AS starts, false AS cut, COUNT(*) AS row_count FROM {orders} WHERE o_orderstatus = 'O'
    UNION ALL SELECT 'wide', 'CREATE VIEW', true, COUNT(*) FROM {lineitem}""",
)
def view_summary(spark, folder):
    schema = scratch_schema(spark, "source")
    attach(spark, schema, folder, ["orders", "lineitem"])
    spark.sql(f"CREATE VIEW {schema}.open_orders AS SELECT * FROM {schema}.orders WHERE o_orderstatus = 'O'")
    wide = ", ".join(f"l_extendedprice * {i} AS a_rather_long_column_name_{i}" for i in range(10))
    spark.sql(f"CREATE VIEW {schema}.wide AS SELECT {wide} FROM {schema}.lineitem")
    found = catalog.summarize_views(spark, CATALOG, [schema])
    counts = counts_of(spark, {v: f"{schema}.{v}" for v in ("open_orders", "wide")})
    return found.join(counts, found["view"] == counts["name"]).select(
        "view",
        F.substring("ddl_preview", 1, 11).alias("starts"),
        F.col("ddl_preview").endswith(" ...").alias("cut"),
        F.col("rows").alias("row_count"),
    )


TARGET_TABLES = "SELECT LOWER(c_mktsegment) AS schema, CONCAT('c_', c_custkey) AS name FROM {customer}"
SCHEMA_MAP = """SELECT DISTINCT LOWER(c_mktsegment) AS target_schema, CONCAT(LOWER(c_mktsegment), '_v3') AS source_schema
FROM {customer} WHERE c_mktsegment <> 'BUILDING'"""


@query(
    "target_pairs",
    f"""SELECT CONCAT('a.', source_schema, '.', name) AS source_fqn, CONCAT('b.', target_schema, '.', name) AS target_fqn
    FROM ({TARGET_TABLES}) t JOIN ({SCHEMA_MAP}) m ON t.schema = m.target_schema""",
)
def target_pairs(spark, folder):
    return catalog.target_pairs(
        derived(spark, folder, TARGET_TABLES), derived(spark, folder, SCHEMA_MAP), "a", "b"
    )


@query(
    "property_snapshot",
    """SELECT 'graph.owner' AS key, 'it''s ours' AS sql_value, 'it''s ours' AS metadata_value, 'both' AS only_in,
    COUNT(*) AS row_count FROM {nation}""",
)
def property_snapshot(spark, folder):
    """Both readings of a copied table's properties."""
    from tablesync.operators.properties import compare_readings

    target = scratch_schema(spark, "target")
    table(spark, folder, "nation").write.saveAsTable(f"{target}.nation")
    spark.sql(f"ALTER TABLE {target}.nation SET TBLPROPERTIES ('graph.owner' = 'it\\'s ours')")
    names = [f"{target}.nation"]
    readings = compare_readings(snapshot_by_sql(spark, names), snapshot_by_metadata(spark, names))
    counts = counts_of(spark, {names[0]: names[0]})
    return readings.join(counts, readings["table_fqn"] == counts["name"]).select(
        "key", "sql_value", "metadata_value", "only_in", F.col("rows").alias("row_count")
    )


# ---- views

VIEW_ROWS = """
SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN CONCAT('v', c_custkey) ELSE CONCAT(' kg.v', c_custkey, ' ') END AS view,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN CONCAT('w', c_custkey) END AS target_view,
       CASE WHEN c_nationkey < 5 THEN 'kg2' WHEN c_nationkey < 10 THEN ' ' END AS target_db,
       CASE WHEN c_mktsegment = 'FURNITURE' THEN 'kg.base' END AS base_table,
       CASE WHEN c_nationkey > 20 THEN '/moved' END AS target_location,
       CASE WHEN c_acctbal > 0 THEN CONCAT('c_custkey = ', c_custkey) END AS filter_expression,
       CASE WHEN c_acctbal < 0 THEN 'c_custkey' END AS join_key
FROM {customer}
"""
RESOLVED = f"""
SELECT view_full, src_db, src_view, tgt_db, tgt_view,
       CASE WHEN src_db IS NULL THEN base_table ELSE COALESCE(base_table, CONCAT(src_db, '.', src_view, '__base')) END AS base_table,
       CASE WHEN src_db IS NULL THEN target_location
            ELSE COALESCE(target_location, CONCAT('/root/', tgt_db, '.db/', tgt_view)) END AS target_location,
       CASE WHEN src_db IS NOT NULL THEN CONCAT('a.', view_full) END AS source_view_fqn,
       CASE WHEN src_db IS NOT NULL THEN CONCAT('b.', tgt_db, '.', tgt_view) END AS target_view_fqn,
       COALESCE(filter_expression, 'c_acctbal <= 0') AS filter_expression, COALESCE(join_key, 'row_key') AS join_key,
       CASE WHEN src_db IS NULL THEN CONCAT('view must be <schema>.<name>: ', view) END AS spec_error
FROM (SELECT *, TRIM(view) AS view_full, CASE WHEN view LIKE '%.%' THEN 'kg' END AS src_db,
             CASE WHEN view LIKE '%.%' THEN SUBSTRING(TRIM(view), 4) END AS src_view,
             COALESCE(NULLIF(TRIM(target_db), ''), CASE WHEN view LIKE '%.%' THEN 'kg' END) AS tgt_db,
             COALESCE(target_view, CASE WHEN view LIKE '%.%' THEN SUBSTRING(TRIM(view), 4) END) AS tgt_view
      FROM ({VIEW_ROWS}) x) y
"""


def resolved(spark, folder):
    specs = derived(spark, folder, VIEW_ROWS).withColumn("cast_to_string", F.lit(None).cast("array<string>"))
    return views.resolve(
        specs,
        source_catalog="a",
        target_catalog="b",
        location_root="/root",
        default_filter="c_acctbal <= 0",
        base_suffix="__base",
        default_key="row_key",
    )


@query("view_specs", RESOLVED)
def view_specs(spark, folder):
    return resolved(spark, folder).drop("cast_to_string")


# One view text per customer: plain and backticked names, a join to itself, a location or none.
VIEW_TEXTS = """
SELECT CONCAT('a.kg.v', c_custkey) AS fqn,
       CASE WHEN c_nationkey < 8
         THEN CONCAT('CREATE VIEW kg.v', c_custkey, ' TBLPROPERTIES (''location'' = ''/old/', c_custkey, ''') AS SELECT * FROM a.kg.v',
                     c_custkey, ' WHERE kg.v', c_custkey, '.x = 1')
         WHEN c_nationkey < 16
         THEN CONCAT('CREATE VIEW `kg`.`v', c_custkey, '` AS SELECT * FROM `a`.`kg`.`v', c_custkey, '` JOIN kg.v', c_custkey, ' t USING (id)')
         ELSE CONCAT('create view kg.v', c_custkey, ' as select * from b.kg.v', c_custkey, '0 join b.kg.v', c_custkey, ' u') END AS ddl
FROM {customer}
"""
REWRITTEN = f"""
SELECT target_view_fqn,
       CASE WHEN c_nationkey < 8
         THEN CONCAT('CREATE OR REPLACE VIEW ', target_view_fqn, ' TBLPROPERTIES (''location'' = ''', target_location,
                     ''') AS SELECT * FROM b.', base_table, ' WHERE kg.v', c_custkey, '.x = 1')
         WHEN c_nationkey < 16
         THEN CONCAT('CREATE OR REPLACE VIEW ', target_view_fqn, ' AS SELECT * FROM b.', base_table, ' JOIN b.', base_table, ' t USING (id)')
         ELSE CONCAT('CREATE OR REPLACE VIEW ', target_view_fqn, ' as select * from b.kg.v', c_custkey, '0 join b.', base_table, ' u') END AS target_ddl
FROM ({RESOLVED}) r JOIN {{customer}} c ON r.source_view_fqn = CONCAT('a.kg.v', c.c_custkey)
"""


@query("view_ddl_rewrite", REWRITTEN)
def view_ddl_rewrite(spark, folder):
    texts = derived(spark, folder, VIEW_TEXTS)
    found = views.rewrite(texts, resolved(spark, folder), source_catalog="a", target_catalog="b")
    return found.select("target_view_fqn", "target_ddl")


# Texts in which only the parser can tell a relation: an alias, literals, comments and a WITH that look like one.
LITERAL_TEXTS = """
SELECT CONCAT('a.kg.v', c_custkey) AS fqn,
       CASE WHEN c_nationkey < 8
         THEN CONCAT('CREATE VIEW kg.v', c_custkey, ' AS SELECT a.id, ''a.kg.x'' AS c, ''from kg.v', c_custkey, ''' AS d FROM a.kg.t', c_custkey, ' a')
         WHEN c_nationkey < 16
         THEN CONCAT('CREATE VIEW kg.v', c_custkey, ' COMMENT ''as a.kg.x'' AS WITH v', c_custkey, ' AS (SELECT * FROM kg.v', c_custkey,
                     ') SELECT * FROM v', c_custkey, ', a.kg.u /* join kg.v', c_custkey, ' */ WHERE k IN (SELECT k FROM `a`.kg.w)')
         ELSE CONCAT('CREATE VIEW kg.v', c_custkey, ' AS SELECT ''', REPLACE(c_name, '#', ' from a.kg.'), ''' AS n -- from a.kg.x') END AS ddl
FROM {customer}
"""


@query(
    "view_ddl_literals",
    f"""SELECT target_view_fqn,
       CASE WHEN c_nationkey < 8
         THEN CONCAT('CREATE OR REPLACE VIEW ', target_view_fqn, ' AS SELECT a.id, ''a.kg.x'' AS c, ''from kg.v', c_custkey, ''' AS d FROM b.kg.t', c_custkey, ' a')
         WHEN c_nationkey < 16
         THEN CONCAT('CREATE OR REPLACE VIEW ', target_view_fqn, ' COMMENT ''as a.kg.x'' AS WITH v', c_custkey, ' AS (SELECT * FROM b.', base_table,
                     ') SELECT * FROM v', c_custkey, ', b.kg.u /* join kg.v', c_custkey, ' */ WHERE k IN (SELECT k FROM b.kg.w)')
         ELSE CONCAT('CREATE OR REPLACE VIEW ', target_view_fqn, ' AS SELECT ''', REPLACE(c_name, '#', ' from a.kg.'), ''' AS n -- from a.kg.x') END AS target_ddl
    FROM ({RESOLVED}) r JOIN {{customer}} c ON r.source_view_fqn = CONCAT('a.kg.v', c.c_custkey)""",
)
def view_ddl_literals(spark, folder):
    texts = derived(spark, folder, LITERAL_TEXTS)
    found = views.rewrite(texts, resolved(spark, folder), source_catalog="a", target_catalog="b")
    return found.select("target_view_fqn", "target_ddl")


def prepared(spark, folder, base_sql: str):
    """A view over orders on the source, the base table of its copy on the target, and the spec."""
    source, target, state = (scratch_schema(spark, n) for n in ("source", "target", "state"))
    attach(spark, source, folder, ["orders"])
    spark.sql(f"CREATE VIEW {source}.latest AS SELECT * FROM {source}.orders WHERE o_orderstatus <> 'P'")
    base = f"{target}.latest__base"
    derived(spark, folder, base_sql).write.saveAsTable(base)
    row = (f"{source}.latest", None, target, base, None, "o_totalprice > 5000", "o_orderkey", ["o_custkey"])
    specs = spark.createDataFrame([row], VIEW_SPECS)
    return specs, StateTable(spark, state, "view_state", VIEW_STATE), source, target


def publish_on_base(spark, specs, source: str) -> None:
    """Publish from a text that reads the view's own source name, which becomes the base table."""
    found = views.resolve(specs, source_catalog=CATALOG, target_catalog=CATALOG)
    ddl = (
        f"CREATE VIEW {source}.latest AS SELECT * FROM {CATALOG}.{source}.latest WHERE o_orderstatus <> 'P'"
    )
    texts = spark.createDataFrame([(f"{CATALOG}.{source}.latest", ddl)], "fqn string, ddl string")
    for r in views.rewrite(texts, found, source_catalog=CATALOG, target_catalog=CATALOG).collect():
        ok, error = views.publish(spark, r["target_ddl"])
        if not ok:
            raise RuntimeError(error)


OPEN_COPY = f"SELECT * FROM ({ORDERS_COPY}) x WHERE o_orderstatus <> 'P'"


@query("view_publish", OPEN_COPY)
def view_publish(spark, folder):
    """The view on the target reads the base table there."""
    specs, _, source, target = prepared(spark, folder, ORDERS_COPY)
    publish_on_base(spark, specs, source)
    return spark.table(f"{target}.latest")


@query(
    "view_batch_publish",
    "SELECT 'latest' AS view, 'success' AS migrate_status, COUNT(*) AS row_count FROM {orders} WHERE o_orderstatus <> 'P'",
)
def view_batch_publish(spark, folder):
    specs, state, _, target = prepared(spark, folder, "SELECT * FROM {orders}")
    publish_batch(spark, specs, state, dry_run=True)
    done = publish_batch(spark, specs, state)
    counts = counts_of(spark, {"latest": f"{target}.latest"})
    name = F.substring_index("target_view_fqn", ".", -1).alias("view")
    states = done.select(name, "migrate_status")
    return states.join(counts, states["view"] == counts["name"]).select(
        "view", "migrate_status", F.col("rows").alias("row_count")
    )


@query(
    "view_batch_validate",
    f"""WITH s AS (SELECT * FROM {{orders}} WHERE o_orderstatus <> 'P' AND o_totalprice > 5000),
    t AS (SELECT * FROM ({OPEN_COPY}) y WHERE o_totalprice > 5000)
    SELECT 'latest' AS view, 'mismatch' AS validation_status, (SELECT COUNT(*) FROM s) AS source_count,
           (SELECT COUNT(*) FROM t) AS target_count,
           (SELECT COUNT(*) FROM s FULL JOIN t ON s.o_orderkey = t.o_orderkey
            WHERE s.o_orderkey IS NULL OR t.o_orderkey IS NULL OR s.o_custkey <> t.o_custkey
               OR s.o_orderstatus IS DISTINCT FROM t.o_orderstatus OR s.o_totalprice <> t.o_totalprice
               OR s.o_orderdate <> t.o_orderdate OR s.o_orderpriority <> t.o_orderpriority) AS mismatched_rows""",
)
def view_batch_validate(spark, folder):
    specs, state, source, _ = prepared(spark, folder, ORDERS_COPY)
    publish_on_base(spark, specs, source)
    done = validate_views(spark, specs, state)
    return done.select(
        F.substring_index("target_view_fqn", ".", -1).alias("view"),
        "validation_status", "source_count", "target_count", "mismatched_rows",
    )


# ---- backup

INVENTORY = """
SELECT CONCAT('c.', LOWER(c_mktsegment), '.t', c_custkey) AS fqn, 'c' AS catalog, LOWER(c_mktsegment) AS schema,
       CONCAT('t', c_custkey) AS name, CASE WHEN c_acctbal < 0 THEN 'view' ELSE 'table' END AS kind
FROM {customer}
"""


@query(
    "backup_plan",
    f"""SELECT fqn, kind, CASE WHEN kind = 'table' THEN CONCAT('c.', schema, '_v2.', name) END AS backup_fqn,
    CASE WHEN kind = 'table' THEN 'move' ELSE 'drop view' END AS action FROM ({INVENTORY}) x""",
)
def backup_plan(spark, folder):
    return backup.plan(derived(spark, folder, INVENTORY), "_v2")


def backed_up(spark, folder):
    schema = scratch_schema(spark, "target")
    names = ("orders", "events", "nation")
    copy_sources = scratch_schema(spark, "source")
    attach(spark, copy_sources, folder, names)
    copy_table(spark, f"{copy_sources}.orders", f"{schema}.orders", spec="o_orderdate:years")
    copy_table(spark, f"{copy_sources}.events", f"{schema}.events")
    attach(spark, schema, folder, ["nation"])  # external: registered again, not copied
    spark.sql(f"CREATE VIEW {schema}.v AS SELECT * FROM {schema}.orders")
    where = f"{shared_folder(spark)}/schemas/{uuid.uuid4().hex}.db"
    made = backup.move_aside(
        spark, CATALOG, [schema], "_v2", confirm=True, locations={f"{schema}_v2": where}
    )
    return made, names


@query(
    "backup_tables",
    "SELECT 'orders' AS name, COUNT(*) AS \"rows\" FROM {orders} UNION ALL SELECT 'events', COUNT(*) FROM {events} "
    "UNION ALL SELECT 'nation', COUNT(*) FROM {nation}",
)
def backup_tables(spark, folder):
    made, names = backed_up(spark, folder)
    return counts_of(spark, {n: f"{made[0]}.{n}" for n in names})


@query(
    "backup_verify",
    """SELECT CAST(3 AS BIGINT) AS tables,
    (SELECT COUNT(*) FROM {orders}) + (SELECT COUNT(*) FROM {events}) + (SELECT COUNT(*) FROM {nation}) AS row_count""",
)
def backup_verify(spark, folder):
    made, names = backed_up(spark, folder)
    rows = counts_of(spark, {n: f"{made[0]}.{n}" for n in names})
    total = rows.groupBy(F.lit(made[0]).alias("schema")).agg(F.sum("rows").alias("row_count"))
    return backup.verify(spark, CATALOG, made).join(total, "schema").select("tables", "row_count")
