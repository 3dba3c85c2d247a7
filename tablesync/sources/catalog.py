"""What a catalog holds: schemas, tables, views, partition specs and counts.

Listings come from the catalog one statement per schema or relation and are small; everything
after that is a DataFrame over all relations at once.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.errors import SPARK_ERRORS, message
from tablesync.functions.partitions import SPEC_PROPERTY, parse_spec
from tablesync.functions.quoting import quote_name, quote_part

RELATIONS = "catalog string, schema string, name string, fqn string"
PREVIEW_LENGTH = 400
COUNT_ERROR_LENGTH = 120
COUNTS_PER_PLAN = 200
# Catalog statements that run side by side.
READERS = 8


def full_name(catalog: str, schema: str, name: str) -> str:
    return ".".join((catalog, schema, name))


def list_schemas(spark: SparkSession, catalog: str = "spark_catalog") -> DataFrame:
    found = spark.sql(f"SHOW NAMESPACES IN {quote_part(catalog)}")
    return found.select(F.lit(catalog).alias("catalog"), F.col("namespace").alias("schema"))


def _relations(spark: SparkSession, catalog: str, schema: str, names: Iterable[str]) -> DataFrame:
    rows = [(catalog, schema, n, full_name(catalog, schema, n)) for n in names]
    return spark.createDataFrame(rows, RELATIONS)


def _show(spark: SparkSession, what: str, catalog: str, schema: str, column: str) -> list[str]:
    place = f"{quote_part(catalog)}.{quote_part(schema)}"
    rows = spark.sql(f"SHOW {what} IN {place}").where(~F.col("isTemporary"))
    return [r[0] for r in rows.select(column).collect()]


def list_tables(spark: SparkSession, catalog: str, schema: str) -> DataFrame:
    """Tables and views of a schema; Spark lists both under tables."""
    return _relations(spark, catalog, schema, _show(spark, "TABLES", catalog, schema, "tableName"))


def _is_view(spark: SparkSession, fqn: str) -> bool:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quote_name(fqn)}")
    kind = rows.where((F.col("col_name") == "Type") & F.lower("data_type").contains("view"))
    return not kind.isEmpty()


def _views(spark: SparkSession, catalog: str, schema: str) -> tuple[list[str], list[str]]:
    """Names of the views of a schema, and of relations of which nobody can tell.

    Where the catalog cannot list views, each relation is described.
    """
    try:
        return _show(spark, "VIEWS", catalog, schema, "viewName"), []
    except SPARK_ERRORS:
        names, unknown = [], []
        for name in _show(spark, "TABLES", catalog, schema, "tableName"):
            try:
                if _is_view(spark, full_name(catalog, schema, name)):
                    names.append(name)
            except SPARK_ERRORS:
                unknown.append(name)
        return names, unknown


def list_views(spark: SparkSession, catalog: str, schema: str) -> DataFrame:
    """Views of a schema."""
    return _relations(spark, catalog, schema, _views(spark, catalog, schema)[0])


def inventory(spark: SparkSession, catalog: str, schemas: Iterable[str]) -> DataFrame:
    """Every relation with its kind: ``table``, ``view``, or ``unknown`` where it cannot be described."""
    schemas = list(schemas)
    relations = _union(spark, [list_tables(spark, catalog, s) for s in schemas], RELATIONS)
    kinds = [
        (full_name(catalog, schema, name), kind)
        for schema in schemas
        for kind, names in zip(("view", "unknown"), _views(spark, catalog, schema))
        for name in names
    ]
    flagged = spark.createDataFrame(kinds, "fqn string, kind string")
    return relations.join(flagged, "fqn", "left").select(
        "catalog", "schema", "name", "fqn", F.coalesce("kind", F.lit("table")).alias("kind")
    )


def _union(spark: SparkSession, frames: list[DataFrame], schema: str) -> DataFrame:
    if not frames:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, frames)


# ---- partition specs


def partition_spec(spark: SparkSession, fqn: str) -> str:
    """``"a:days,b"`` of one table; blank when it is not partitioned.

    A column that the copy derived is reported as the transform it was derived with, which the
    copy leaves in a table property. Iceberg lists its own transforms under ``Part N``.
    """
    told = _described(spark, fqn)
    if told is not None:
        stored = told.get("table_properties", {}).get(SPEC_PROPERTY, "")
        derived = {f.column: f.text for f in parse_spec(stored)}
        return ",".join(derived.get(c, c) for c in told.get("partition_columns", ()))
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {quote_name(fqn)}").collect()
    hidden = [r["data_type"] for r in described if r["col_name"].startswith("Part ")]
    if hidden:
        return ",".join(_hidden_transform(text) for text in hidden)
    columns = [c.name for c in spark.catalog.listColumns(quote_name(fqn)) if c.isPartition]
    if not columns:
        return ""
    shown = spark.sql(f"SHOW TBLPROPERTIES {quote_name(fqn)}").where(F.col("key") == SPEC_PROPERTY)
    stored = [r["value"] for r in shown.collect()]
    derived = {f.column: f.text for f in parse_spec(stored[0])} if stored else {}
    return ",".join(derived.get(c, c) for c in columns)


def _described(spark: SparkSession, fqn: str) -> dict | None:
    """All that the session catalog knows of a table, in one statement; None for a table of another catalog."""
    try:
        return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {quote_name(fqn)} AS JSON").first()[0])
    except SPARK_ERRORS:
        return None


def _hidden_transform(text: str) -> str:
    """``days(ts)`` or ``bucket(16, id)`` as ``ts:days`` or ``id:bucket[16]``."""
    name, _, inside = text.strip().rstrip(")").partition("(")
    if not inside:
        return name
    *width, column = [p.strip() for p in inside.split(",")]
    return f"{column}:{name}" + (f"[{width[0]}]" if width else "")


def spec_display(spec: str) -> str:
    """The spec for reading: position, column, transform and source of each field."""
    fields = parse_spec(spec)
    if not fields:
        return "Not partitioned"
    return "; ".join(
        f"{i}: {f.column}: {f.transform}{'' if f.width is None else f'[{f.width}]'}({f.source})"
        for i, f in enumerate(fields, start=1)
    )


SPECS = "fqn string, partition_columns string, partition_spec_display string, error string"


def partition_specs(spark: SparkSession, fqns: Iterable[str]) -> DataFrame:
    """The spec of every relation, several read at a time; one that cannot be read gives a row with its error."""

    def read(fqn: str) -> tuple:
        try:
            spec = partition_spec(spark, fqn)
            return fqn, spec, spec_display(spec), None
        except (*SPARK_ERRORS, ValueError) as problem:
            return fqn, "", "", message(problem)

    with ThreadPoolExecutor(READERS) as pool:
        return spark.createDataFrame(list(pool.map(read, fqns)), SPECS)


def summarize_tables(spark: SparkSession, catalog: str, schemas: Iterable[str]) -> DataFrame:
    relations = inventory(spark, catalog, schemas)
    specs = partition_specs(spark, [r["fqn"] for r in relations.select("fqn").collect()])
    return relations.join(specs, "fqn").select(
        "catalog",
        "schema",
        F.col("name").alias("table"),
        "partition_columns",
        "partition_spec_display",
        F.current_timestamp().alias("checked_at"),
        "error",
    )


# ---- counts


def count_tables(
    spark: SparkSession, tables: Mapping[str, str | DataFrame], where: str | None = None
) -> DataFrame:
    """``table_name, row_count, count_error`` of all tables, as one plan.

    ``tables`` maps the name to report to a table name or a DataFrame. Every branch is its own
    partial count, so nothing but one number per task is shuffled. A table that cannot be
    resolved, or has no column the filter names, has a null count and the error's first part.
    """
    frames = []
    for name, table in tables.items():
        try:
            df = spark.table(quote_name(table)) if isinstance(table, str) else table
            df = df.where(where) if where else df
            counted = df.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
                "count_error", F.lit(None).cast("string")
            )
            counted.schema  # resolves now, so that the error belongs to this table
        except SPARK_ERRORS as problem:
            counted = spark.range(1).select(
                F.lit(None).cast("long").alias("row_count"),
                F.lit(message(problem)[:COUNT_ERROR_LENGTH]).alias("count_error"),
            )
        frames.append(counted.select(F.lit(name).alias("table_name"), "row_count", "count_error"))
    return _union(spark, frames, "table_name string, row_count bigint, count_error string")


def counted_inventory(
    spark: SparkSession, catalog: str, schemas: Iterable[str], where: str | None = None
) -> DataFrame:
    """The inventory with a count per table. Views are listed without one.

    Should a file of one table turn out unreadable, the counts are taken again table by table,
    so that the others keep theirs.
    """
    relations = inventory(spark, catalog, schemas)
    tables = [r["fqn"] for r in relations.where("kind = 'table'").select("fqn").collect()]
    rows = []
    for i in range(0, len(tables), COUNTS_PER_PLAN):
        batch = tables[i : i + COUNTS_PER_PLAN]
        try:
            rows += count_tables(spark, {t: t for t in batch}, where).collect()
        except SPARK_ERRORS:
            for table in batch:
                try:
                    rows += count_tables(spark, {table: table}, where).collect()
                except SPARK_ERRORS as problem:
                    rows.append((table, None, message(problem)[:COUNT_ERROR_LENGTH]))
    counts = spark.createDataFrame(
        [tuple(r) for r in rows], "fqn string, row_count bigint, count_error string"
    )
    return relations.join(counts, "fqn", "left")


# ---- views


def view_texts(spark: SparkSession, catalog: str, schemas: Iterable[str]) -> DataFrame:
    """The DDL of every view; ``error`` where it cannot be read."""
    rows = []
    for schema in schemas:
        for r in list_views(spark, catalog, schema).collect():
            try:
                text = spark.sql(f"SHOW CREATE TABLE {quote_name(r['fqn'])}").first()[0]
                rows.append((catalog, schema, r["name"], r["fqn"], text, None))
            except SPARK_ERRORS as problem:
                rows.append((catalog, schema, r["name"], r["fqn"], None, message(problem)))
    return spark.createDataFrame(rows, RELATIONS + ", ddl string, error string")


def summarize_views(spark: SparkSession, catalog: str, schemas: Iterable[str]) -> DataFrame:
    return view_texts(spark, catalog, schemas).select(
        "catalog", "schema", F.col("name").alias("view"), ddl_preview(F.col("ddl")).alias("ddl_preview"), "error"
    )


def ddl_preview(ddl):
    cut = F.concat(F.substring(ddl, 1, PREVIEW_LENGTH), F.lit(" ..."))
    return F.when(F.length(ddl) > PREVIEW_LENGTH, cut).otherwise(ddl)


# ---- pairs


def target_pairs(
    target_tables: DataFrame, schema_map: DataFrame, source_catalog: str, target_catalog: str
) -> DataFrame:
    """One ``(source_fqn, target_fqn)`` for each table the target has.

    ``target_tables`` has ``schema, name``; ``schema_map`` has ``target_schema, source_schema``.
    """
    return target_tables.join(
        schema_map, target_tables["schema"] == schema_map["target_schema"]
    ).select(
        F.concat_ws(".", F.lit(source_catalog), "source_schema", "name").alias("source_fqn"),
        F.concat_ws(".", F.lit(target_catalog), "target_schema", "name").alias("target_fqn"),
    )
