"""State operators over one state row per order."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tablesync.operators import state as s
from tablesync.operators.validate import filter_lookup
from tablesync.schemas import TABLE_STATE
from tablesync.sources.state import StateTable, read_csv, write_csv
from tablesync.sources.workspace import scratch_schema, shared_folder
from workloads.base import derived, query
from workloads.manifests import KEYED, manifest

STATE = """
SELECT CONCAT('k', o_orderkey) AS table_key, CONCAT('kg.orders_', o_orderkey) AS source_table,
       CASE WHEN o_orderstatus = 'F' THEN ' SUCCESS ' WHEN o_orderstatus = 'P' THEN 'failed' END AS apply_status,
       CASE WHEN o_orderpriority = '1-URGENT' THEN 'ok' WHEN o_orderpriority = '2-HIGH' THEN 'Mismatch'
            WHEN o_orderpriority = '5-LOW' THEN 'error' END AS validation_status,
       o_custkey AS source_count, o_orderkey AS target_count,
       CASE WHEN o_orderpriority = '5-LOW' THEN CONCAT('table "', o_orderkey, '"', CHR(10), 'is gone, "so"') END AS validation_error,
       o_orderpriority AS note
FROM {orders}
"""
WORK = "SELECT CONCAT('k', l_orderkey) AS table_key, l_linenumber, l_partkey FROM {lineitem}"
UPDATES = """
SELECT CONCAT('k', o_orderkey) AS table_key, 'ok' AS validation_status, CAST(NULL AS STRING) AS validation_error,
       o_custkey + 1 AS target_count FROM {orders} WHERE o_totalprice > 250000
UNION ALL SELECT CONCAT('new', c_custkey), 'mismatch', c_name, c_custkey FROM {customer}
"""


def state(spark, folder):
    return derived(spark, folder, STATE)


@query(
    "state_load",
    f"""SELECT table_key, source_table, TRIM(apply_status) AS apply_status, validation_status, source_count, target_count,
    CAST(NULL AS BIGINT) AS target_count_total, validation_error, note FROM ({STATE}) x""",
)
def state_load(spark, folder):
    """Saved as CSV with some columns missing and one more, and loaded again."""
    path = f"{shared_folder(spark)}/states/{uuid.uuid4().hex}"
    write_csv(state(spark, folder), path)
    return read_csv(spark, path, TABLE_STATE).select(
        "table_key", "source_table", F.trim("apply_status").alias("apply_status"), "validation_status",
        "source_count", "target_count", "target_count_total", "validation_error", "note",
    )


UPSERTED = f"""
SELECT COALESCE(s.table_key, u.table_key) AS table_key, s.source_table, s.apply_status,
       CASE WHEN u.table_key IS NOT NULL THEN u.validation_status ELSE s.validation_status END AS validation_status,
       s.source_count,
       CASE WHEN u.table_key IS NOT NULL THEN u.target_count ELSE s.target_count END AS target_count,
       CASE WHEN u.table_key IS NOT NULL THEN u.validation_error ELSE s.validation_error END AS validation_error,
       s.note
FROM ({STATE}) s FULL JOIN ({UPDATES}) u ON s.table_key = u.table_key
"""


@query("state_upsert", UPSERTED)
def state_upsert(spark, folder):
    return s.upsert(state(spark, folder), derived(spark, folder, UPDATES), "table_key")


@query("state_save", UPSERTED)
def state_save(spark, folder):
    """The same through a saved state: the second save reads what the first wrote."""
    saved = StateTable(spark, scratch_schema(spark, "state"), "table_state", TABLE_STATE)
    saved.save(state(spark, folder))
    saved.save(s.upsert(saved.load(), derived(spark, folder, UPDATES), "table_key"))
    return saved.load()


DONE = f"SELECT table_key FROM ({STATE}) s WHERE LOWER(TRIM(apply_status)) IN ('success', 'ok')"


@query("state_pending", f"SELECT * FROM ({WORK}) w WHERE table_key NOT IN ({DONE})")
def state_pending(spark, folder):
    return s.pending(derived(spark, folder, WORK), state(spark, folder), "table_key", "apply_status")


@query("state_skipped", f"SELECT * FROM ({WORK}) w WHERE table_key IN ({DONE})")
def state_skipped(spark, folder):
    return s.skipped(derived(spark, folder, WORK), state(spark, folder), "table_key", "apply_status")


@query(
    "state_reset",
    f"""SELECT table_key, source_table, apply_status, CAST(NULL AS STRING) AS validation_status,
    CAST(NULL AS BIGINT) AS source_count, CAST(NULL AS BIGINT) AS target_count,
    CAST(NULL AS STRING) AS validation_error, note FROM ({STATE}) x""",
)
def state_reset(spark, folder):
    return s.reset(state(spark, folder))


@query(
    "state_summary",
    f"SELECT LOWER(validation_status) AS status, COUNT(*) AS n FROM ({STATE}) x WHERE validation_status IS NOT NULL GROUP BY 1",
)
def state_summary(spark, folder):
    return s.summary(state(spark, folder), "validation_status")


@query(
    "state_seed",
    f"""{KEYED} SELECT state_key AS table_key, "table" AS source_table, target_table, job_key AS k8s_name,
    CAST(NULL AS STRING) AS apply_status FROM named""",
)
def state_seed(spark, folder):
    return s.seed(manifest(spark, folder)).select(
        "table_key", "source_table", "target_table", "k8s_name", "apply_status"
    )


# States under both kinds of key: the older key for orders that are P, the own key for cheap F.
MIXED = f"""{KEYED},
mixed AS (
  SELECT DISTINCT legacy_key AS table_key, 'Success' AS apply_status, 'old' AS k8s_name
  FROM keyed WHERE legacy_key LIKE 'kg%'
  UNION ALL
  SELECT state_key, 'failed', job_key FROM keyed WHERE legacy_key LIKE 'codes%' AND source_count < 500)
"""


def mixed(spark, folder):
    keyed = s.with_keys(manifest(spark, folder))
    old = keyed.where("legacy_key LIKE 'kg%'").selectExpr(
        "legacy_key AS table_key", "'Success' AS apply_status", "'old' AS k8s_name"
    )
    own = keyed.where("legacy_key LIKE 'codes%' AND source_count < 500").selectExpr(
        "state_key AS table_key", "'failed' AS apply_status", "job_key AS k8s_name"
    )
    return old.distinct().unionByName(own)


@query(
    "state_status",
    f"""{MIXED} SELECT k."table", k.state_key, COALESCE(LOWER(CASE WHEN a.table_key IS NOT NULL THEN a.apply_status
    ELSE b.apply_status END), '') AS status FROM keyed k
    LEFT JOIN mixed a ON k.state_key = a.table_key LEFT JOIN mixed b ON k.legacy_key = b.table_key""",
)
def state_status(spark, folder):
    return s.status_of(manifest(spark, folder), mixed(spark, folder)).select("table", "state_key", "status")


@query(
    "state_upgrade",
    f"""{MIXED}, work AS (SELECT DISTINCT state_key, legacy_key, job_key FROM keyed)
    SELECT * FROM mixed WHERE table_key NOT IN (SELECT legacy_key FROM work)
    UNION ALL SELECT w.state_key, m.apply_status, w.job_key FROM work w JOIN mixed m ON w.legacy_key = m.table_key
    WHERE w.state_key NOT IN (SELECT table_key FROM mixed)""",
)
def state_upgrade(spark, folder):
    return s.upgrade(mixed(spark, folder), manifest(spark, folder))


@query(
    "status_labels",
    f"""SELECT table_key, CASE LOWER(validation_status) WHEN 'ok' THEN 'OK'
    WHEN 'mismatch' THEN CONCAT('DIFF (source=', source_count, ', target=', target_count, ')')
    WHEN 'error' THEN CONCAT('ERROR: ', SUBSTRING(validation_error, 1, 120)) ELSE 'PENDING' END AS label
    FROM ({STATE}) x""",
)
def status_labels(spark, folder):
    rows = state(spark, folder)
    return rows.select("table_key", s.status_label(rows).alias("label"))


@query(
    "filter_lookup",
    f"""WITH s AS (SELECT table_key, CONCAT('job-', SUBSTRING(table_key, 2)) AS k8s_name FROM ({STATE}) x),
    m AS (SELECT CONCAT('job-', o_orderkey) AS job_key,
                 CASE WHEN o_orderstatus = 'P' THEN CONCAT('o_orderkey = ', o_orderkey) END AS f
          FROM {{orders}} WHERE o_orderpriority = '1-URGENT')
    SELECT s.table_key, s.k8s_name, CASE WHEN m.job_key IS NULL THEN 'ts <= 1' ELSE COALESCE(m.f, '') END AS where_sql
    FROM s LEFT JOIN m ON s.k8s_name = m.job_key""",
)
def lookup(spark, folder):
    rows = state(spark, folder).selectExpr("table_key", "CONCAT('job-', SUBSTRING(table_key, 2)) AS k8s_name")
    jobs = manifest(spark, folder).where("k8sName LIKE 'job-%'")
    return filter_lookup(rows, jobs, "ts <= 1")
