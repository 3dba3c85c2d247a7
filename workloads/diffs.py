"""Row-level diffs of whole tables against perturbed copies."""

from __future__ import annotations

from tablesync.operators.rowdiff import RowDiff, key_quality
from workloads.base import LINEITEM_COPY, ORDERS_COPY, derived, query, table

KEY = "o_orderkey"
COLUMNS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]

JOINED = f"""
WITH t AS ({ORDERS_COPY}), j AS (
  SELECT COALESCE(s.{KEY}, t.{KEY}) AS {KEY},
         s.{KEY} IS NOT NULL AS old__present, t.{KEY} IS NOT NULL AS new__present,
         {", ".join(f"s.{c} AS old__{c}, t.{c} AS new__{c}" for c in COLUMNS)}
  FROM {{orders}} s FULL JOIN t ON s.{KEY} = t.{KEY})
"""
ANY = "(" + " OR ".join(f"old__{c} IS DISTINCT FROM new__{c}" for c in COLUMNS) + ")"
STRICT = f"(NOT old__present OR NOT new__present OR {ANY})"
STATUS = (
    "CASE WHEN NOT new__present THEN 'only_source' WHEN NOT old__present THEN 'only_target' "
    "ELSE 'changed' END"
)


def mismatched(columns: list[str]) -> str:
    names = ", ".join(f"CASE WHEN old__{c} IS DISTINCT FROM new__{c} THEN '{c}' END" for c in columns)
    return f"CONCAT_WS(', ', {names})"


def orders_diff(spark, folder, **options) -> RowDiff:
    return RowDiff(
        table(spark, folder, "orders"), derived(spark, folder, ORDERS_COPY), KEY, **options
    )


@query("row_diff_joined", f"{JOINED} SELECT *, CAST(1 AS BIGINT) AS row_copies FROM j")
def row_diff_joined(spark, folder):
    return orders_diff(spark, folder).aligned()


VALUES = ", ".join(f"old__{c}, new__{c}" for c in COLUMNS)
LISTING = f"""{JOINED}
SELECT {KEY}, {STATUS} AS row_status, CAST(1 AS BIGINT) AS row_copies,
       {mismatched(COLUMNS)} AS mismatched_columns, {VALUES}
FROM j WHERE """


@query("row_diff", LISTING + STRICT)
def row_diff(spark, folder):
    return orders_diff(spark, folder).rows()


@query("row_diff_lenient", LISTING + ANY)
def row_diff_lenient(spark, folder):
    return orders_diff(spark, folder, strict=False).rows()


@query("row_diff_unique", LISTING + STRICT)
def row_diff_unique(spark, folder):
    return orders_diff(spark, folder, unique_keys=True).rows()


@query("row_diff_count", f"{JOINED} SELECT COUNT(*) AS mismatched_rows FROM j WHERE {STRICT}")
def row_diff_count(spark, folder):
    return orders_diff(spark, folder).count()


BY_COLUMN = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) AS mismatches FROM j "
    f"WHERE old__{c} IS DISTINCT FROM new__{c} HAVING COUNT(*) > 0"
    for c in COLUMNS
)


@query("row_diff_by_column", f"{JOINED} {BY_COLUMN}")
def row_diff_by_column(spark, folder):
    return orders_diff(spark, folder).by_column()


@query(
    "row_diff_by_status",
    f"{JOINED} SELECT {STATUS} AS row_status, COUNT(*) AS n FROM j WHERE {STRICT} GROUP BY 1",
)
def row_diff_by_status(spark, folder):
    return orders_diff(spark, folder).by_status()


SIDE_COUNTS = "(SELECT COUNT(*) FROM {orders}) AS source_count, (SELECT COUNT(*) FROM t) AS target_count"


@query(
    "row_diff_counts",
    f"WITH t AS ({ORDERS_COPY}), c AS (SELECT {SIDE_COUNTS}) "
    "SELECT *, source_count = target_count AS count_match FROM c",
)
def row_diff_counts(spark, folder):
    return orders_diff(spark, folder).counts()


@query(
    "row_diff_verdict",
    f"""{JOINED}, v AS (SELECT {SIDE_COUNTS}, COUNT(*) AS mismatched_rows FROM j WHERE {STRICT})
    SELECT *, CASE WHEN source_count = target_count AND mismatched_rows = 0 THEN 'ok' ELSE 'mismatch' END
      AS validation_status FROM v""",
)
def row_diff_verdict(spark, folder):
    return orders_diff(spark, folder).verdict()


@query(
    "row_diff_cast",
    f"""WITH t AS ({ORDERS_COPY})
    SELECT COALESCE(s.{KEY}, t.{KEY}) AS {KEY},
           CASE WHEN t.{KEY} IS NULL THEN 'only_source' WHEN s.{KEY} IS NULL THEN 'only_target'
                ELSE 'changed' END AS row_status,
           CAST(1 AS BIGINT) AS row_copies, 'o_custkey' AS mismatched_columns,
           CAST(s.o_custkey AS STRING) AS old__o_custkey, CAST(t.o_custkey AS STRING) AS new__o_custkey
    FROM {{orders}} s FULL JOIN t ON s.{KEY} = t.{KEY}
    WHERE CAST(s.o_custkey AS STRING) IS DISTINCT FROM CAST(t.o_custkey AS STRING)""",
)
def row_diff_cast(spark, folder):
    options = {"columns": ["o_custkey"], "cast_to_string": ["o_custkey"]}
    return orders_diff(spark, folder, **options).rows()


@query(
    "row_diff_filtered",
    f"""WITH s AS (SELECT * FROM {{orders}} WHERE o_orderdate <= TIMESTAMP '2000-12-31 23:59:59.999'),
    t AS (SELECT * FROM ({ORDERS_COPY}) x WHERE o_orderdate <= TIMESTAMP '2000-12-31 23:59:59.999'),
    j AS (SELECT s.{KEY} AS a, t.{KEY} AS b, {", ".join(f"s.{c} AS old__{c}, t.{c} AS new__{c}" for c in COLUMNS)}
          FROM s FULL JOIN t ON s.{KEY} = t.{KEY})
    SELECT COUNT(*) AS mismatched_rows FROM j WHERE a IS NULL OR b IS NULL OR {ANY}""",
)
def row_diff_filtered(spark, folder):
    return orders_diff(spark, folder, where="o_orderdate <= '2000-12-31 23:59:59.999'").count()


# ---- a key that repeats: compared as bags of rows

L_KEYS = ["l_orderkey", "l_linenumber"]
L_COLUMNS = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]
K, C = ", ".join(L_KEYS), ", ".join(L_COLUMNS)
BAGS = f"""
WITH t AS ({LINEITEM_COPY}),
u AS (SELECT {K}, {C}, 1 AS o, 0 AS n FROM {{lineitem}} UNION ALL SELECT {K}, {C}, 0, 1 FROM t),
v AS (SELECT {K}, {C}, CAST(SUM(o) AS BIGINT) AS o, CAST(SUM(n) AS BIGINT) AS n FROM u GROUP BY {K}, {C}),
s AS (SELECT *, GREATEST(o - n, 0) AS so, GREATEST(n - o, 0) AS sn FROM v WHERE o <> n),
k AS (SELECT {K}, SUM(so) = 1 AND SUM(sn) = 1 AS changed FROM s GROUP BY {K}),
old AS (SELECT s.*, k.changed FROM s JOIN k USING ({K}) WHERE so > 0),
new AS (SELECT s.*, k.changed FROM s JOIN k USING ({K}) WHERE sn > 0),
d AS (
  SELECT {K}, 'changed' AS row_status, CAST(1 AS BIGINT) AS row_copies,
         {", ".join(f"old.{c} AS old__{c}, new.{c} AS new__{c}" for c in L_COLUMNS)}
  FROM old JOIN new USING ({K}) WHERE old.changed
  UNION ALL
  SELECT {K}, 'only_source', so, {", ".join(f"{c}, NULL" for c in L_COLUMNS)} FROM old WHERE NOT changed
  UNION ALL
  SELECT {K}, 'only_target', sn, {", ".join(f"NULL, {c}" for c in L_COLUMNS)} FROM new WHERE NOT changed)
"""


def lineitem_diff(spark, folder, **options) -> RowDiff:
    return RowDiff(
        table(spark, folder, "lineitem"), derived(spark, folder, LINEITEM_COPY), L_KEYS, **options
    )


@query(
    "row_diff_duplicates",
    f"{BAGS} SELECT {K}, row_status, row_copies, {mismatched(L_COLUMNS)} AS mismatched_columns, "
    + ", ".join(f"old__{c}, new__{c}" for c in L_COLUMNS)
    + " FROM d",
)
def row_diff_duplicates(spark, folder):
    return lineitem_diff(spark, folder).rows()


@query(
    "row_diff_duplicates_by_column",
    f"{BAGS} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(SUM(row_copies) AS BIGINT) AS mismatches FROM d "
        f"WHERE old__{c} IS DISTINCT FROM new__{c} HAVING COUNT(*) > 0"
        for c in L_COLUMNS
    ),
)
def row_diff_duplicates_by_column(spark, folder):
    return lineitem_diff(spark, folder).by_column()


L_ANY = " OR ".join(f"s.{c} IS DISTINCT FROM t.{c}" for c in L_COLUMNS)
L_JOIN = "FROM {lineitem} s FULL JOIN t ON s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber"


@query(
    "row_diff_pair_counts",
    f"WITH t AS ({LINEITEM_COPY}) SELECT '*' AS column_name, COUNT(*) AS mismatches {L_JOIN} WHERE {L_ANY} UNION ALL "
    + " UNION ALL ".join(
        f"SELECT '{c}', COUNT(*) {L_JOIN} WHERE s.{c} IS DISTINCT FROM t.{c}" for c in L_COLUMNS
    ),
)
def row_diff_pair_counts(spark, folder):
    """The numbers of the join that pairs up duplicates; keys with many rows do not make their pairs."""
    counts = lineitem_diff(spark, folder).pair_counts()
    return counts.withColumn("mismatches", counts["mismatches"].cast("long"))


@query(
    "key_quality",
    """SELECT COUNT(*) AS duplicate_keys, CAST(SUM(n) AS BIGINT) AS rows_affected,
              (SELECT COUNT(*) FROM {lineitem} WHERE l_orderkey IS NULL OR l_linenumber IS NULL) AS null_key_rows
       FROM (SELECT COUNT(*) AS n FROM {lineitem} GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1) x""",
)
def lineitem_key_quality(spark, folder):
    return key_quality(table(spark, folder, "lineitem"), L_KEYS)


# ---- null keys, arrays, whole texts

NULL_KEYS = """SELECT CASE WHEN event_type = 'error' THEN NULL ELSE event_id END AS event_id, user_id, value
FROM {events}"""


@query(
    "row_diff_null_keys",
    f"""WITH e AS ({NULL_KEYS}) SELECT 'only_source' AS row_status, COUNT(*) AS n FROM e WHERE event_id IS NULL
        UNION ALL SELECT 'only_target', COUNT(*) FROM e WHERE event_id IS NULL""",
)
def row_diff_null_keys(spark, folder):
    rows = derived(spark, folder, NULL_KEYS)
    return RowDiff(rows, rows, "event_id").by_status()


@query(
    "row_diff_arrays",
    """SELECT 'embedding' AS column_name, COUNT(*) AS mismatches FROM {embeddings}
       WHERE label = 0 AND list_reverse(embedding) IS DISTINCT FROM embedding HAVING COUNT(*) > 0""",
)
def row_diff_arrays(spark, folder):
    source = table(spark, folder, "embeddings")
    target = source.selectExpr(
        "vec_id", "CASE WHEN label = 0 THEN reverse(embedding) ELSE embedding END AS embedding", "label"
    )
    return RowDiff(source, target, "vec_id").by_column()


@query(
    "row_diff_texts",
    """SELECT doc_id, 'changed' AS row_status, CAST(1 AS BIGINT) AS row_copies, 'text' AS mismatched_columns,
              text AS old__text, CONCAT(text, '.') AS new__text, lang AS old__lang, lang AS new__lang,
              source AS old__source, source AS new__source, n_chars AS old__n_chars, n_chars AS new__n_chars
       FROM {documents} WHERE lang = 'fr'""",
)
def row_diff_texts(spark, folder):
    source = table(spark, folder, "documents")
    target = source.selectExpr(
        "doc_id", "CASE WHEN lang = 'fr' THEN CONCAT(text, '.') ELSE text END AS text",
        "lang", "source", "n_chars",
    )
    return RowDiff(source, target, "doc_id").rows()
