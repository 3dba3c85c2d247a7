"""Property operators over four properties of one table per customer."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesync.operators import properties as p
from workloads.base import derived, query

PAIRS = """
SELECT CONCAT('src.n', c_nationkey, '.', c_name) AS source_fqn, CONCAT('tgt.n', c_nationkey, '.', c_name) AS target_fqn
FROM {customer}
"""
SOURCE = """
SELECT CONCAT('src.n', c_nationkey, '.', c_name) AS table_fqn, 'market.segment' AS key, c_mktsegment AS value FROM {customer}
UNION ALL SELECT CONCAT('src.n', c_nationkey, '.', c_name), 'format-version', '2' FROM {customer}
UNION ALL SELECT CONCAT('src.n', c_nationkey, '.', c_name), 'graph.nation', CAST(c_nationkey AS STRING) FROM {customer}
  WHERE c_acctbal < 8000
UNION ALL SELECT CONCAT('src.n', c_nationkey, '.', c_name), 'note', CONCAT('it''s ', c_name) FROM {customer}
"""
# The same tables on the other side: some values changed, some keys lost, some added.
TARGET = """
SELECT CONCAT('tgt.n', c_nationkey, '.', c_name) AS table_fqn, 'market.segment' AS key,
       CASE WHEN c_acctbal < 0 THEN 'OTHER' ELSE c_mktsegment END AS value FROM {customer}
UNION ALL SELECT CONCAT('tgt.n', c_nationkey, '.', c_name), 'format-version', '1' FROM {customer}
UNION ALL SELECT CONCAT('tgt.n', c_nationkey, '.', c_name), 'graph.nation', CAST(c_nationkey AS STRING) FROM {customer}
  WHERE c_mktsegment <> 'BUILDING'
UNION ALL SELECT CONCAT('tgt.n', c_nationkey, '.', c_name), 'note', CONCAT('it''s ', c_name) FROM {customer}
  WHERE c_acctbal > 1000
UNION ALL SELECT CONCAT('tgt.n', c_nationkey, '.', c_name), 'owner', c_name FROM {customer} WHERE c_nationkey > 12
"""
SIDES = f"""WITH pairs AS ({PAIRS}),
s AS (SELECT source_fqn, target_fqn, key, value FROM pairs JOIN ({SOURCE}) x ON source_fqn = table_fqn),
t AS (SELECT source_fqn, target_fqn, key, value FROM pairs JOIN ({TARGET}) x ON target_fqn = table_fqn),
d AS (SELECT COALESCE(s.source_fqn, t.source_fqn) AS source_fqn, COALESCE(s.target_fqn, t.target_fqn) AS target_fqn,
             COALESCE(s.key, t.key) AS key, s.key IS NOT NULL AS in_s, t.key IS NOT NULL AS in_t,
             s.value AS sv, t.value AS tv
      FROM s FULL JOIN t ON s.target_fqn = t.target_fqn AND s.key = t.key),
e AS (SELECT *, CASE WHEN NOT in_t THEN 'missing_on_target' WHEN NOT in_s THEN 'extra_on_target'
                     WHEN sv = tv THEN 'equal' ELSE 'value_changed' END AS status FROM d),
plan AS (SELECT source_fqn, target_fqn, key, sv AS value FROM e
         WHERE status IN ('missing_on_target', 'value_changed') AND key <> 'format-version')
"""


def inputs(spark, folder):
    return tuple(derived(spark, folder, sql) for sql in (PAIRS, SOURCE, TARGET))


@query(
    "property_compare",
    f"""WITH a AS ({SOURCE}), b AS (SELECT * FROM ({SOURCE}) x WHERE key <> 'note'
      UNION ALL SELECT CONCAT('src.n', c_nationkey, '.', c_name), 'comment', c_mktsegment FROM {{customer}})
    SELECT COALESCE(a.table_fqn, b.table_fqn) AS table_fqn, COALESCE(a.key, b.key) AS key,
           COALESCE(a.value, '') AS sql_value, COALESCE(b.value, '') AS metadata_value,
           CASE WHEN b.key IS NULL THEN 'sql' WHEN a.key IS NULL THEN 'metadata' ELSE 'both' END AS only_in
    FROM a FULL JOIN b ON a.table_fqn = b.table_fqn AND a.key = b.key""",
)
def property_compare(spark, folder):
    first = derived(spark, folder, SOURCE)
    more = derived(
        spark,
        folder,
        "SELECT CONCAT('src.n', c_nationkey, '.', c_name) AS table_fqn, 'comment' AS key, c_mktsegment AS value FROM {customer}",
    )
    return p.compare_readings(first, first.where("key <> 'note'").unionByName(more))


@query(
    "property_diff",
    f"""{SIDES} SELECT source_fqn, target_fqn, key, COALESCE(sv, '') AS source_value, COALESCE(tv, '') AS target_value,
    status FROM e""",
)
def property_diff(spark, folder):
    return p.diff(*inputs(spark, folder))


@query("property_status_counts", f"{SIDES} SELECT status, COUNT(*) AS n FROM e GROUP BY status")
def property_status_counts(spark, folder):
    return p.counts(p.diff(*inputs(spark, folder)), "status")


@query("property_plan", f"{SIDES} SELECT * FROM plan")
def property_plan(spark, folder):
    return p.sync_plan(*inputs(spark, folder))


@query(
    "property_key_plan",
    f"""{SIDES} SELECT pairs.source_fqn, pairs.target_fqn, s.value AS source_value, t.value AS target_value,
    CASE WHEN s.value IS NULL THEN 'skip (source missing)' WHEN s.value = t.value THEN 'noop' ELSE 'set' END AS action
    FROM pairs LEFT JOIN s ON pairs.source_fqn = s.source_fqn AND s.key = 'graph.nation'
    LEFT JOIN t ON pairs.target_fqn = t.target_fqn AND t.key = 'graph.nation'""",
)
def property_key_plan(spark, folder):
    return p.key_plan(*inputs(spark, folder), "graph.nation")


@query(
    "property_apply",
    f"""{SIDES} SELECT target_fqn, CONCAT('ALTER TABLE `', REPLACE(target_fqn, '.', '`.`'), '` SET TBLPROPERTIES (',
    STRING_AGG(CONCAT('''', key, ''' = ''', REPLACE(value, '''', CONCAT(CHR(92), '''')), ''''), ', ' ORDER BY key), ')') AS statement
    FROM plan GROUP BY target_fqn""",
)
def property_apply(spark, folder):
    """The statements that would be run."""
    return p.statements(p.sync_plan(*inputs(spark, folder)))


@query(
    "property_sync_report",
    f"""{SIDES} SELECT pairs.source_fqn, pairs.target_fqn, COUNT(key) AS key_count,
    COALESCE(STRING_AGG(key, ',' ORDER BY key), '') AS "keys", false AS applied, '' AS error
    FROM pairs LEFT JOIN plan ON pairs.target_fqn = plan.target_fqn GROUP BY 1, 2""",
)
def property_sync_report(spark, folder):
    return p.sync(spark, *inputs(spark, folder)).drop("at")


@query(
    "property_verify",
    f"""{SIDES} SELECT pairs.target_fqn, t.value FROM pairs LEFT JOIN t ON pairs.target_fqn = t.target_fqn AND t.key = 'note'""",
)
def property_verify(spark, folder):
    pairs, _, target = inputs(spark, folder)
    return p.verify(pairs, target, "note")


@query(
    "property_action_counts",
    f"""{SIDES} SELECT CASE WHEN s.value IS NULL THEN 'skip (source missing)' WHEN s.value = t.value THEN 'noop'
    ELSE 'set' END AS action, COUNT(*) AS n
    FROM pairs LEFT JOIN s ON pairs.source_fqn = s.source_fqn AND s.key = 'market.segment'
    LEFT JOIN t ON pairs.target_fqn = t.target_fqn AND t.key = 'market.segment' GROUP BY 1""",
)
def property_action_counts(spark, folder):
    return p.counts(p.key_plan(*inputs(spark, folder), "market.segment"), "action")


@query(
    "property_after_sync",
    f"""{SIDES} SELECT CASE WHEN key = 'format-version' OR status = 'extra_on_target' THEN status ELSE 'equal' END AS status,
    COUNT(*) AS n FROM e GROUP BY 1""",
)
def property_after_sync(spark, folder):
    """What the diff would show with the plan applied: nothing left but reserved and extra keys."""
    pairs, source, target = inputs(spark, folder)
    plan = p.sync_plan(pairs, source, target)
    planned = plan.select(F.col("target_fqn").alias("table_fqn"), "key", "value")
    after = target.join(planned, ["table_fqn", "key"], "left_anti").unionByName(planned)
    return p.counts(p.diff(pairs, source, after), "status")
