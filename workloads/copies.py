"""Filtered, partitioned and windowed copies of whole tables, read back from the target."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesync.operators import copy
from tablesync.operators.copy import chunk_coverage, copy_chunk, copy_merging_schema, copy_table
from tablesync.operators.rowdiff import RowDiff
from tablesync.operators.state import conform
from tablesync.plans.batch import copy_batch
from tablesync.schemas import MANIFEST, TABLE_STATE
from tablesync.sources.state import StateTable
from tablesync.sources.workspace import scratch_schema
from workloads.base import attach, counts_of, query, table


def copied(spark, folder, name, spec, where=None):
    source, target = scratch_schema(spark, "source"), scratch_schema(spark, "target")
    attach(spark, source, folder, [name])
    copy_table(spark, f"{source}.{name}", f"{target}.{name}", spec=spec, where=where)
    return spark.table(f"{target}.{name}")


@query(
    "copy_days",
    "SELECT *, CAST(ts AS DATE) AS ts_day FROM {events} WHERE ts <= TIMESTAMP '2024-01-15 23:59:59.999'",
)
def copy_days(spark, folder):
    return copied(spark, folder, "events", "ts:days", "ts <= '2024-01-15 23:59:59.999'")


@query("copy_hours", "SELECT *, CAST(FLOOR(EPOCH(ts) / 3600) AS BIGINT) AS ts_hour FROM {events}")
def copy_hours(spark, folder):
    return copied(spark, folder, "events", "ts:hours")


@query(
    "copy_months",
    "SELECT *, CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS o_orderdate_month FROM {orders}",
)
def copy_months(spark, folder):
    return copied(spark, folder, "orders", "o_orderdate:months")


@query(
    "copy_years",
    "SELECT *, CAST(DATE_TRUNC('year', o_orderdate) AS DATE) AS o_orderdate_year FROM {orders}",
)
def copy_years(spark, folder):
    return copied(spark, folder, "orders", "o_orderdate:years")


@query("copy_bucket", "SELECT * FROM {part}")
def copy_bucket(spark, folder):
    return copied(spark, folder, "part", "p_partkey:bucket[16]").drop("p_partkey_bucket")


@query("copy_truncate", "SELECT *, p_partkey - p_partkey % 100 AS p_partkey_trunc FROM {part}")
def copy_truncate(spark, folder):
    return copied(spark, folder, "part", "p_partkey:truncate[100]")


@query("copy_identity", "SELECT *, CAST(l_shipdate AS DATE) AS d FROM {lineitem}")
def copy_identity(spark, folder):
    rows = copied(spark, folder, "lineitem", "l_returnflag,l_linestatus")
    return rows.withColumn("d", F.to_date("l_shipdate"))


@query("copy_filtered", "SELECT * FROM {lineitem} WHERE l_returnflag = 'R' AND l_quantity > 25")
def copy_filtered(spark, folder):
    return copied(spark, folder, "lineitem", "", "l_returnflag = 'R' AND l_quantity > 25")


@query("copy_texts", "SELECT * FROM {documents}")
def copy_texts(spark, folder):
    return copied(spark, folder, "documents", "lang,source")


@query("copy_redirect", "SELECT * FROM {customer}")
def copy_redirect(spark, folder):
    """A row that names another schema and another table lands there."""
    source, target, state = (scratch_schema(spark, n) for n in ("source", "target", "state"))
    attach(spark, source, folder, ["customer"])
    rows = [(f"{source}.customer", "", None, target, "clients", None, None)]
    states = StateTable(spark, state, "table_state", TABLE_STATE)
    copy_batch(spark, spark.createDataFrame(rows, MANIFEST), states)
    return spark.table(f"{target}.clients")


@query(
    "copy_overwrite_partitions",
    """SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-16 00:00:00' THEN value ELSE value + 1000 END AS value,
              CAST(ts AS DATE) AS ts_day FROM {events}""",
)
def copy_overwrite_partitions(spark, folder):
    """Later days are overwritten; the earlier ones keep what an older copy wrote."""
    target = f"{scratch_schema(spark, 'target')}.events"
    events = table(spark, folder, "events")
    copy.overwrite_partitions(events.withColumn("value", F.col("value") + 1000), target, "ts:days")
    copy.overwrite_partitions(events.where("ts >= '2024-01-16'"), target, "ts:days")
    return spark.table(target).select("event_id", "value", "ts_day")


@query("copy_overwrite_unpartitioned", "SELECT * FROM {orders} WHERE o_orderstatus = 'F'")
def copy_overwrite_unpartitioned(spark, folder):
    target = f"{scratch_schema(spark, 'target')}.orders"
    orders = table(spark, folder, "orders")
    copy.overwrite_partitions(orders, target)
    copy.overwrite_partitions(orders.where("o_orderstatus = 'F'"), target)
    return spark.table(target)


@query(
    "copy_verified",
    """SELECT COUNT(*) AS source_count, COUNT(*) AS target_count, CAST(0 AS BIGINT) AS mismatched_rows,
              'ok' AS validation_status FROM {orders}""",
)
def copy_verified(spark, folder):
    """A copy has no difference from its source."""
    target = copied(spark, folder, "orders", "o_orderdate:years")
    return RowDiff(table(spark, folder, "orders"), target, "o_orderkey").verdict()


WINDOWS = (
    "ts < timestamp_ntz '2024-01-10 12:00:00'",
    "ts >= timestamp_ntz '2024-01-10 12:00:00'",
)


@query("copy_chunked", "SELECT *, CAST(ts AS DATE) AS ts_day FROM {events}")
def copy_chunked(spark, folder):
    """Two windows that cut a day; the second keeps the rows the first wrote in it."""
    target = f"{scratch_schema(spark, 'target')}.events"
    for window in WINDOWS:
        copy_chunk(table(spark, folder, "events"), target, "ts:days", window)
    return spark.table(target)


@query(
    "chunk_coverage",
    """SELECT CAST(CASE WHEN ts < TIMESTAMP '2024-01-10 12:00:00' THEN 1 ELSE 0 END
              + CASE WHEN ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00' THEN 1 ELSE 0 END
              AS BIGINT) AS hits, COUNT(*) AS n FROM {events} GROUP BY 1""",
)
def coverage(spark, folder):
    windows = [
        WINDOWS[0],
        "ts >= timestamp_ntz '2024-01-05 00:00:00' AND ts < timestamp_ntz '2024-01-20 00:00:00'",
    ]
    return chunk_coverage(table(spark, folder, "events"), windows)


@query(
    "scan_window",
    """SELECT event_id, CAST(ts AS DATE) AS ts_day FROM {events}
       WHERE ts >= TIMESTAMP '2024-01-10 12:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'""",
)
def scan_window(spark, folder):
    """A window of a copy by day; the plan lists the days it reads."""
    target = f"{scratch_schema(spark, 'target')}.events"
    copy.overwrite_partitions(table(spark, folder, "events"), target, "ts:days")
    rows = copy.scan_window(spark, target, "ts", "2024-01-10 12:00:00", "2024-01-20 00:00:00")
    return rows.select("event_id", "ts_day")


@query(
    "copy_schema_merge",
    """SELECT event_id, ts, CASE WHEN ts >= TIMESTAMP '2024-01-16 00:00:00' THEN props END AS props,
              CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN value END AS value,
              CAST(ts AS DATE) AS ts_day FROM {events}""",
)
def copy_schema_merge(spark, folder):
    """The first copy has no props, the second no value."""
    target = f"{scratch_schema(spark, 'target')}.events"
    events = table(spark, folder, "events")
    copy_merging_schema(events.select("event_id", "ts", "value"), target, "ts:days")
    later = events.where("ts >= '2024-01-16'").select("event_id", "ts", "props")
    copy_merging_schema(later, target, "ts:days")
    return spark.table(target).select("event_id", "ts", "props", "value", "ts_day")


# Types of a target column, and whether all prices of two digits fit in each, in SQL.
NARROWER = {
    "decimal(14,3)": "true",
    "decimal(12,1)": "price = ROUND(price, 1)",
    "int": "price = ROUND(price, 0)",
    "string": "true",
}


@query(
    "copy_narrowed",
    "WITH price AS (SELECT o_orderstatus, CAST(o_totalprice AS DECIMAL(12,2)) AS price FROM {orders}) "
    + " UNION ALL ".join(
        f"""SELECT '{kind}' AS target_type, CASE WHEN BOOL_AND({fits}) THEN 'copied' ELSE 'conflict' END AS outcome,
        CASE WHEN BOOL_AND({fits}) THEN COUNT(*) ELSE COUNT(*) FILTER (WHERE o_orderstatus = 'F') END AS row_count FROM price"""
        for kind, fits in NARROWER.items()
    ),
)
def copy_narrowed(spark, folder):
    """All orders into targets of other types: where a price would change, the target stays as it was."""
    target = scratch_schema(spark, "target")
    prices = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(12,2)").alias("price"))
    outcomes = []
    for i, kind in enumerate(NARROWER):
        place = f"{target}.t{i}"
        old = prices.where("o_orderstatus = 'F'").withColumn("price", F.floor("price").cast(kind))
        old.write.saveAsTable(place)
        try:
            copy.overwrite_partitions(prices, place)
            outcomes.append((kind, "copied", place))
        except copy.LayoutConflict:
            outcomes.append((kind, "conflict", place))
    counts = counts_of(spark, {place: place for *_, place in outcomes})
    return spark.createDataFrame(outcomes, "target_type string, outcome string, name string").join(counts, "name").select(
        "target_type", "outcome", F.col("rows").alias("row_count")
    )


def conflicting(spark, folder, conflict):
    """Orders before 1995 with narrow columns, then the others with wider and other ones."""
    target = f"{scratch_schema(spark, 'target')}.orders"
    orders = table(spark, folder, "orders")
    narrow = orders.where("o_orderdate < '1995-01-01'").selectExpr(
        "cast(o_orderkey AS int) AS k", "cast(o_custkey AS bigint) AS c", "cast(o_custkey AS int) AS s", "o_orderdate"
    )
    copy_merging_schema(narrow, target, "o_orderdate:years")
    wide = orders.where("o_orderdate >= '1995-01-01'").selectExpr(
        "o_orderkey + 3000000000 AS k", "cast(o_custkey AS int) AS c", "concat('c', o_custkey) AS s", "o_orderdate"
    )
    copy_merging_schema(wide, target, "o_orderdate:years", conflict=conflict)
    return spark.table(target)


EARLY, LATE = "o_orderdate < DATE '1995-01-01'", "CAST(o_orderkey AS BIGINT) + 3000000000"


@query(
    "copy_types_widened",
    f"""SELECT CASE WHEN {EARLY} THEN CAST(o_orderkey AS BIGINT) ELSE {LATE} END AS k, CAST(o_custkey AS BIGINT) AS c,
        CASE WHEN {EARLY} THEN CAST(o_custkey AS VARCHAR) ELSE 'c' || o_custkey END AS s, o_orderdate FROM {{orders}}""",
)
def copy_types_widened(spark, folder):
    return conflicting(spark, folder, "widen").select("k", "c", "s", "o_orderdate")


@query(
    "copy_types_kept_aside",
    f"""SELECT CASE WHEN {EARLY} THEN CAST(o_orderkey AS INTEGER) END AS k__int, CASE WHEN NOT ({EARLY}) THEN {LATE} END AS k,
        CAST(o_custkey AS BIGINT) AS c, CASE WHEN {EARLY} THEN CAST(o_custkey AS INTEGER) END AS s__int,
        CASE WHEN NOT ({EARLY}) THEN 'c' || o_custkey END AS s, o_orderdate FROM {{orders}}""",
)
def copy_types_kept_aside(spark, folder):
    return conflicting(spark, folder, "keep_aside").select("k__int", "k", "c", "s__int", "s", "o_orderdate")


@query(
    "copy_properties",
    """SELECT 'graph.owner' AS key, 'it''s ours' AS value, (SELECT COUNT(*) FROM {supplier}) AS row_count
       UNION ALL SELECT 'graph.tier', '1', (SELECT COUNT(*) FROM {supplier})""",
)
def copy_properties(spark, folder):
    source, target = scratch_schema(spark, "source"), scratch_schema(spark, "target")
    attach(spark, source, folder, ["supplier"])
    spark.sql(
        f"ALTER TABLE {source}.supplier SET TBLPROPERTIES "
        "('graph.owner' = 'it\\'s ours', 'graph.tier' = '1', 'other' = 'x')"
    )
    copy_table(spark, f"{source}.supplier", f"{target}.supplier")
    shown = spark.sql(f"SHOW TBLPROPERTIES {target}.supplier").where("key IN ('graph.owner', 'graph.tier', 'other')")
    counts = counts_of(spark, {"supplier": f"{target}.supplier"})
    return shown.withColumn("name", F.lit("supplier")).join(counts, "name").select(
        "key", "value", F.col("rows").alias("row_count")
    )


BATCH = {"orders": "o_orderdate:years", "lineitem": "l_returnflag", "part": "", "labels": ""}


@query(
    "batch_copy",
    " UNION ALL ".join(
        f"SELECT '{t}' AS name, {f'CAST(NULL AS STRING)' if t == 'labels' else repr('success')} AS apply_status, "
        + ("CAST(NULL AS BIGINT)" if t == "labels" else f"(SELECT COUNT(*) FROM {{{t}}})")
        + " AS row_count"
        for t in BATCH
    ).replace("CAST(NULL AS STRING)", "'failed'"),
)
def batch_copy(spark, folder):
    """Three tables copied, and one whose filter cannot be resolved; it is the last and stops the batch."""
    source, target, state = (scratch_schema(spark, n) for n in ("source", "target", "state"))
    attach(spark, source, folder, list(BATCH))
    rows = [
        (f"{source}.{t}", spec, "no_such_column = 1" if t == "labels" else None, target, None, None, None)
        for t, spec in BATCH.items()
    ]
    states = StateTable(spark, state, "table_state", TABLE_STATE)
    done = copy_batch(spark, spark.createDataFrame(rows, MANIFEST).coalesce(1), states)
    counts = counts_of(spark, {t: f"{target}.{t}" for t in BATCH if t != "labels"})
    names = conform(done, TABLE_STATE).select(
        F.substring_index("source_table", ".", -1).alias("name"), "apply_status"
    )
    return names.join(counts, "name", "left").select("name", "apply_status", F.col("rows").alias("row_count"))
