"""Counts, specs and verdicts of whole copied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesync.operators import validate as v
from tablesync.operators.copy import copy_table, overwrite_partitions
from tablesync.operators.validate import TablePair
from tablesync.plans.batch import copy_batch, validate_batch
from tablesync.schemas import MANIFEST, TABLE_STATE
from tablesync.sources.state import StateTable
from tablesync.sources.workspace import scratch_schema
from workloads.base import LINEITEM_COPY, ORDERS_COPY, attach, derived, query, table

CUTOFF = "TIMESTAMP '2000-12-31 23:59:59.999'"
FILTER = f"o_orderdate <= {CUTOFF.replace('TIMESTAMP', 'timestamp_ntz')}"


def order_pairs(spark, folder):
    return [
        TablePair("orders", table(spark, folder, "orders"), derived(spark, folder, ORDERS_COPY), FILTER),
        TablePair("lineitem", table(spark, folder, "lineitem"), derived(spark, folder, LINEITEM_COPY)),
        TablePair("part", table(spark, folder, "part"), table(spark, folder, "part"), "p_size > 10"),
    ]


COUNTS = f"""
WITH o AS ({ORDERS_COPY}), l AS ({LINEITEM_COPY}), c AS (
SELECT 'orders' AS pair_key, (SELECT COUNT(*) FROM {{orders}} WHERE o_orderdate <= {CUTOFF}) AS source_count,
       (SELECT COUNT(*) FROM o WHERE o_orderdate <= {CUTOFF}) AS target_count,
       (SELECT COUNT(*) FROM o) AS target_count_total
UNION ALL SELECT 'lineitem', (SELECT COUNT(*) FROM {{lineitem}}), (SELECT COUNT(*) FROM l), (SELECT COUNT(*) FROM l)
UNION ALL SELECT 'part', (SELECT COUNT(*) FROM {{part}} WHERE p_size > 10),
       (SELECT COUNT(*) FROM {{part}} WHERE p_size > 10), (SELECT COUNT(*) FROM {{part}}))
"""


@query("table_count_parity", f"{COUNTS} SELECT pair_key, source_count, target_count, source_count = target_count AS count_match FROM c")
def table_count_parity(spark, folder):
    counts = v.count_parity(spark, order_pairs(spark, folder))
    return counts.select("pair_key", "source_count", "target_count", "count_match")


@query(
    "table_beyond_filter",
    f"{COUNTS} SELECT pair_key, target_count, target_count_total, target_count_total - target_count AS beyond_filter FROM c",
)
def table_beyond_filter(spark, folder):
    counts = v.count_parity(spark, order_pairs(spark, folder))
    return counts.select("pair_key", "target_count", "target_count_total", "beyond_filter")


SPECS = """
SELECT CONCAT('t', o_orderkey) AS pair_key,
       CASE WHEN o_orderstatus = 'P' THEN 'ts:days' WHEN o_orderstatus = 'F' THEN 'ts:days,kind' ELSE '' END AS partition_columns
FROM {orders}
"""
SPECS_COPY = """
SELECT CONCAT('t', o_orderkey) AS pair_key,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'kind,ts:days' WHEN o_orderstatus = 'P' THEN 'ts:days'
            WHEN o_orderstatus = 'F' THEN 'ts:days,kind' ELSE '' END AS partition_columns
FROM {orders} WHERE NOT (o_totalprice BETWEEN 300000 AND 305000)
"""
MATCHED = f"""
SELECT COALESCE(a.pair_key, b.pair_key) AS pair_key, a.partition_columns AS partition_source,
       b.partition_columns AS partition_target,
       a.partition_columns IS NOT DISTINCT FROM b.partition_columns AS partition_match
FROM ({SPECS}) a FULL JOIN ({SPECS_COPY}) b ON a.pair_key = b.pair_key
"""


@query("partition_spec_match", MATCHED)
def partition_spec_match(spark, folder):
    return v.compare_specs(derived(spark, folder, SPECS), derived(spark, folder, SPECS_COPY))


TALLIES = "SELECT CONCAT('t', o_orderkey) AS pair_key, o_custkey <> 7 AS count_match FROM {orders}"


@query(
    "table_verdict",
    f"""SELECT c.*, m.partition_source, m.partition_target, m.partition_match,
    CASE WHEN count_match AND partition_match THEN 'ok' ELSE 'mismatch' END AS validation_status
    FROM ({TALLIES}) c JOIN ({MATCHED}) m ON c.pair_key = m.pair_key""",
)
def table_verdict(spark, folder):
    specs = v.compare_specs(derived(spark, folder, SPECS), derived(spark, folder, SPECS_COPY))
    return v.verdict(derived(spark, folder, TALLIES), specs)


@query(
    "adhoc_validate",
    f"""WITH o AS ({ORDERS_COPY})
    SELECT 'events' AS pair_key, COUNT(*) AS source_count, COUNT(*) AS target_count, COUNT(*) AS target_count_total,
           true AS count_match, 'ts:days' AS partition_source, 'ts:days' AS partition_target, true AS partition_match,
           'ok' AS validation_status, false AS failed FROM {{events}}
    UNION ALL SELECT 'orders', (SELECT COUNT(*) FROM {{orders}}), (SELECT COUNT(*) FROM o), (SELECT COUNT(*) FROM o),
           (SELECT COUNT(*) FROM {{orders}}) = (SELECT COUNT(*) FROM o), 'o_orderdate:years', 'o_orderdate:months', false,
           'mismatch', false
    UNION ALL SELECT 'missing', NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'error', true""",
)
def adhoc_validate(spark, folder):
    """A faithful copy, one that lost rows and has another spec, and one that is not there."""
    source, target = scratch_schema(spark, "source"), scratch_schema(spark, "target")
    overwrite_partitions(table(spark, folder, "events"), f"{source}.events", "ts:days")
    copy_table(spark, f"{source}.events", f"{target}.events", spec="ts:days")
    overwrite_partitions(table(spark, folder, "orders"), f"{source}.orders", "o_orderdate:years")
    overwrite_partitions(derived(spark, folder, ORDERS_COPY), f"{target}.orders", "o_orderdate:months")
    pairs = [TablePair(n, f"{source}.{n}", f"{target}.{n}") for n in ("events", "orders", "missing")]
    found = v.validate_pairs(spark, pairs)
    return found.withColumn("failed", F.col("validation_error").isNotNull()).drop("validation_error")


@query(
    "batch_validate",
    """SELECT 'customer' AS name, 'success' AS apply_status, 'ok' AS validation_status,
        (SELECT COUNT(*) FROM {customer} WHERE c_acctbal > 0) AS source_count,
        (SELECT COUNT(*) FROM {customer} WHERE c_acctbal > 0) AS target_count,
        (SELECT COUNT(*) FROM {customer}) AS target_count_total, '' AS partition_target
    UNION ALL SELECT 'orders', 'success', 'mismatch', (SELECT COUNT(*) FROM {orders}), (SELECT COUNT(*) FROM {orders}),
        (SELECT COUNT(*) FROM {orders}), 'o_orderdate:years'""",
)
def batch_validate(spark, folder):
    """Copied by manifest, then validated with each row's own filter; a target with rows beyond
    the filter is still ok, one with another spec is not."""
    source, target, state = (scratch_schema(spark, n) for n in ("source", "target", "state"))
    attach(spark, source, folder, ["customer", "orders"])
    rows = [
        (f"{source}.customer", "", None, target, None, None, None),
        (f"{source}.orders", "o_orderdate:years", None, target, None, None, None),
    ]
    manifest = spark.createDataFrame(rows, MANIFEST)
    states = StateTable(spark, state, "table_state", TABLE_STATE)
    copy_batch(spark, manifest, states)
    filtered = manifest.withColumn(
        "filterExpression", F.when(F.col("table").endswith("customer"), "c_acctbal > 0")
    )
    validate_batch(spark, filtered, states)
    done = validate_batch(spark, filtered, states)  # the row that is ok is not counted again
    return done.select(
        F.substring_index("source_table", ".", -1).alias("name"), "apply_status", "validation_status",
        "source_count", "target_count", "target_count_total", "partition_target",
    )
