"""Manifest operators over one selection or manifest row per order."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesync.functions.partitions import spec_parts
from tablesync.operators import manifest as m
from tablesync.sources.manifest import read_manifest, write_manifest
from tablesync.sources.workspace import shared_folder
from workloads.base import derived, query

# One selection per order, with blanks, defaults, bad counts and bad specs among them.
SELECTIONS = """
SELECT CASE WHEN o_orderstatus = 'P' THEN ' kg ' WHEN o_orderstatus = 'F' THEN 'codes'
            WHEN o_orderpriority = '5-LOW' THEN ' ' ELSE 'graph_live' END AS src_schema,
       CONCAT('orders_', o_custkey, '-', o_orderkey) AS src_table,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'graph_live' WHEN o_orderpriority = '2-HIGH' THEN ' ' END AS tgt_schema,
       CASE WHEN o_orderpriority = '3-MEDIUM' THEN CONCAT('t_', o_orderkey) END AS tgt_table,
       CASE WHEN o_orderstatus = 'P' THEN ' o_orderdate:days '
            WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'a:b:c' END AS partition_columns,
       CASE WHEN o_orderstatus = 'O' THEN CONCAT('o_custkey = ', o_custkey) END AS filter_expression,
       CASE WHEN o_orderpriority = '1-URGENT' THEN CONCAT('job-', o_orderkey)
            WHEN o_orderpriority = '2-HIGH' THEN '  ' END AS k8s_name,
       CASE WHEN o_orderpriority = '5-LOW' THEN '12x' ELSE CAST(o_custkey AS STRING) END AS source_count
FROM {orders}
"""

# Specs as the catalog would report them; those of cheap orders cannot be read.
SPECS = """
SELECT CONCAT('codes.orders_', o_custkey, '-', o_orderkey) AS "table",
       CASE WHEN o_totalprice >= 50000 THEN 'o_orderdate:months' ELSE '' END AS partition_columns,
       CASE WHEN o_totalprice < 50000 THEN 'unreadable' END AS error
FROM {orders} WHERE o_orderstatus = 'F'
"""

MANIFEST = """
SELECT CASE WHEN o_orderstatus = 'P' THEN CONCAT('kg.orders_', o_custkey)
            WHEN o_orderstatus = 'F' THEN CONCAT('codes.orders_', o_orderkey, '_x-y')
            ELSE CONCAT('orders_', o_orderkey) END AS "table",
       CASE WHEN o_orderstatus = 'P' THEN 'o_orderdate:days' WHEN o_orderpriority = '5-LOW' THEN 'a:b:c' ELSE '' END
         AS "partitionColumns",
       CASE WHEN o_orderstatus = 'P' THEN CONCAT('o_orderkey = ', o_orderkey) END AS "filterExpression",
       CASE WHEN o_orderpriority = '2-HIGH' THEN 'graph_live' END AS "outputSchema",
       CASE WHEN o_orderpriority = '2-HIGH' THEN CONCAT('t_', o_orderkey) END AS "outputTable",
       CASE WHEN o_orderpriority = '1-URGENT' THEN CONCAT('job-', o_orderkey)
            WHEN o_orderpriority = '2-HIGH' THEN ' '
            WHEN o_orderpriority = '3-MEDIUM'
              THEN CONCAT('a-job-name-that-is-longer-than-any-cluster-would-take-', o_orderkey) END AS "k8sName",
       o_custkey AS source_count
FROM {orders}
"""


def spark_text(sql: str) -> str:
    """Double quotes keep the case of names in the checking engine; Spark takes backticks."""
    return sql.replace('"', "`")


def manifest(spark, folder):
    return derived(spark, folder, spark_text(MANIFEST))


def selections(spark, folder):
    return derived(spark, folder, SELECTIONS)


def specs(spark, folder):
    return derived(spark, folder, spark_text(SPECS))


CHECKED = f"""
WITH s AS (SELECT NULLIF(TRIM(src_schema), '') AS src_schema, NULLIF(TRIM(src_table), '') AS src_table,
                  NULLIF(TRIM(tgt_schema), '') AS tgt_schema, NULLIF(TRIM(tgt_table), '') AS tgt_table,
                  NULLIF(TRIM(partition_columns), '') AS partition_columns,
                  NULLIF(TRIM(filter_expression), '') AS filter_expression,
                  NULLIF(TRIM(k8s_name), '') AS k8s_name, source_count FROM ({SELECTIONS}) x),
n AS (SELECT *, CONCAT_WS('.', src_schema, src_table) AS tbl FROM s),
j AS (SELECT n.*, p.partition_columns AS derived_spec, p.error AS spec_error
      FROM n LEFT JOIN ({SPECS}) p ON n.tbl = p."table")
"""


@query(
    "manifest_normalize",
    f"""{CHECKED} SELECT tbl AS "table", COALESCE(partition_columns, derived_spec, '') AS "partitionColumns",
    filter_expression AS "filterExpression",
    CASE WHEN tgt_schema <> src_schema THEN tgt_schema END AS "outputSchema",
    CASE WHEN tgt_table <> src_table THEN tgt_table END AS "outputTable", k8s_name AS "k8sName",
    TRY_CAST(source_count AS BIGINT) AS source_count
    FROM j WHERE src_schema IS NOT NULL AND src_table IS NOT NULL""",
)
def manifest_normalize(spark, folder):
    return m.normalize(selections(spark, folder), specs(spark, folder))


@query(
    "manifest_errors",
    f"""{CHECKED} SELECT tbl AS "table", 'missing src_schema or src_table' AS error FROM j WHERE src_schema IS NULL
    UNION ALL SELECT tbl, CONCAT('source_count is not an integer: ', source_count) FROM j
      WHERE src_schema IS NOT NULL AND source_count = '12x'
    UNION ALL SELECT tbl, CONCAT('partition derivation failed: ', spec_error) FROM j
      WHERE src_schema IS NOT NULL AND partition_columns IS NULL AND spec_error IS NOT NULL
    UNION ALL SELECT tbl, CONCAT('cannot read partition spec: ', partition_columns) FROM j
      WHERE src_schema IS NOT NULL AND partition_columns = 'a:b:c'""",
)
def manifest_errors(spark, folder):
    return m.errors(selections(spark, folder), specs(spark, folder))


KEYED = f"""
WITH r AS ({MANIFEST}),
b AS (SELECT *, STRING_SPLIT("table", '.') AS parts FROM r),
k AS (SELECT *, COALESCE(NULLIF(TRIM("k8sName"), ''),
             REPLACE(REPLACE(parts[-1], '_', ''), '-', '')) AS job_key,
             REPLACE("table", '.', '__') AS legacy_key FROM b),
keyed AS (SELECT *, CONCAT(legacy_key, '__', job_key) AS state_key FROM k),
targets AS (SELECT *, COALESCE("outputSchema", CASE WHEN LEN(parts) > 1 THEN parts[1] END) AS target_schema,
             COALESCE("outputTable", parts[-1]) AS target_name FROM keyed),
named AS (SELECT *, CASE WHEN target_schema IS NOT NULL THEN CONCAT(target_schema, '.', target_name) END AS target_table,
             CASE WHEN target_schema IS NULL THEN CONCAT('no target schema for table ', "table") END AS target_error
          FROM targets)
"""


@query("manifest_keys", f'{KEYED} SELECT "table", job_key, state_key, legacy_key FROM keyed')
def manifest_keys(spark, folder):
    return m.with_keys(manifest(spark, folder)).select("table", "job_key", "state_key", "legacy_key")


@query("manifest_targets", f'{KEYED} SELECT "table", target_schema, target_name, target_table, target_error FROM named')
def manifest_targets(spark, folder):
    return m.with_targets(manifest(spark, folder)).select(
        "table", "target_schema", "target_name", "target_table", "target_error"
    )


@query(
    "manifest_key_check",
    f"""{KEYED}, g AS (SELECT job_key, COUNT(*) AS "rows", COUNT(DISTINCT "table") AS tables FROM keyed GROUP BY job_key)
    SELECT job_key, "rows", tables, 'same key for different tables' AS problem FROM g WHERE tables > 1
    UNION ALL SELECT job_key, "rows", tables, 'same key for several rows' FROM g WHERE tables = 1 AND "rows" > 1
    UNION ALL SELECT job_key, "rows", tables, 'key too long' FROM g WHERE LENGTH(job_key) > 52""",
)
def manifest_key_check(spark, folder):
    return m.key_problems(manifest(spark, folder), name_limit=52)


SELECTORS = ("kg.orders_7", "orders_11", "codes__orders_20_x-y", "orders30", "job-33")


@query(
    "manifest_select",
    f"""{KEYED} SELECT "table", job_key FROM keyed WHERE "table" IN {SELECTORS} OR parts[-1] IN {SELECTORS}
    OR legacy_key IN {SELECTORS} OR state_key IN {SELECTORS} OR job_key IN {SELECTORS}""",
)
def manifest_select(spark, folder):
    return m.select_rows(manifest(spark, folder), *SELECTORS).select("table", "job_key")


@query("manifest_read", MANIFEST)
def manifest_read(spark, folder):
    """Written as JSON and read back."""
    import uuid

    path = f"{shared_folder(spark)}/manifests/{uuid.uuid4().hex}"
    write_manifest(manifest(spark, folder), path)
    return read_manifest(spark, path, lines=True)


@query(
    "batch_plan",
    f"""{KEYED} SELECT state_key, job_key, "table" AS source_table, target_table,
    "partitionColumns" AS partition_columns, COALESCE("filterExpression", '') AS filter_expression, source_count,
    COALESCE(target_error, CASE WHEN "partitionColumns" = 'a:b:c' THEN 'cannot read partition spec: a:b:c' END)
      AS plan_error FROM named""",
)
def batch_plan(spark, folder):
    return m.plan(manifest(spark, folder))


# One spec per line item, of every transform, with blanks to trim and malformed ones.
SPEC_TEXTS = """
SELECT l_orderkey, l_linenumber, l_shipdate,
       CASE WHEN l_returnflag = 'A' THEN 'l_shipdate:days,l_returnflag'
            WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN ' l_shipdate : hours , l_tax:sometimes'
            WHEN l_returnflag = 'N' THEN 'a:b:c'
            ELSE CONCAT('l_orderkey:bucket[', l_linenumber, '],l_partkey:truncate') END AS spec
FROM {lineitem}
"""


@query(
    "partition_spec_parse",
    f"""WITH s AS ({SPEC_TEXTS}),
    p AS (SELECT l_orderkey, l_linenumber, spec, UNNEST(STRING_SPLIT(spec, ',')) AS part FROM s),
    q AS (SELECT l_orderkey, l_linenumber, spec, LIST_TRANSFORM(STRING_SPLIT(part, ':'), lambda x: TRIM(x)) AS x FROM p),
    r AS (SELECT l_orderkey, l_linenumber, spec, x[1] AS col, COALESCE(x[2], 'identity') AS transform, LEN(x) AS n FROM q)
    SELECT l_orderkey, l_linenumber, col, transform,
           TRY_CAST(NULLIF(REGEXP_EXTRACT(transform, '\\[([0-9]+)\\]', 1), '') AS INTEGER) AS width,
           n <= 2 AND (transform IN ('identity', 'days', 'hours') OR transform LIKE 'bucket[%]') AS valid FROM r""",
)
def partition_spec_parse(spark, folder):
    rows = derived(spark, folder, SPEC_TEXTS)
    return rows.select(
        "l_orderkey", "l_linenumber", F.inline(spec_parts(F.col("spec")))
    )
