"""Move the tables of a schema aside, under a suffix."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.functions.compare import comparable
from tablesync.functions.quoting import quote_name, quote_part, quote_text
from tablesync.operators.copy import _setting
from tablesync.sources.catalog import full_name, inventory

SESSION_CATALOG = "spark_catalog."


def plan(inventory_rows: DataFrame, suffix: str) -> DataFrame:
    """Where every relation would go; views are dropped."""
    is_table = F.col("kind") == "table"
    return inventory_rows.select(
        "fqn",
        "kind",
        F.when(
            is_table, F.concat_ws(".", "catalog", F.concat("schema", F.lit(suffix)), "name")
        ).alias("backup_fqn"),
        F.when(is_table, "move").when(F.col("kind") == "view", "drop view").otherwise("stop").alias("action"),
    )


class ContentMismatch(RuntimeError):
    """The backup does not have the rows of the original; the original was kept."""


class UnknownKind(RuntimeError):
    """A relation that cannot be described; nothing was dropped or moved."""


def _content(spark: SparkSession, fqn: str) -> tuple:
    """The number of rows and the sum of their hashes, whatever their order."""
    df = spark.table(quote_name(fqn))
    values = [comparable(df[quote_part(f.name)], f.dataType) for f in df.schema.fields]
    hashed = F.xxhash64(*values).cast("decimal(38,0)") if values else F.lit(0).cast("decimal(38,0)")
    return tuple(df.agg(F.count(F.lit(1)), F.sum(hashed)).first())


def _detail(spark: SparkSession, fqn: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quote_name(fqn)}").collect()
    return {r["col_name"]: r["data_type"] for r in rows}


def _move(spark: SparkSession, old: str, new: str) -> None:
    """Rename where the catalog can; otherwise register or copy under the new name, then drop.

    The session catalog cannot rename across schemas. An external table is registered again on
    the same files and no row is moved; a managed one is copied, and dropped only when the
    rows of both have the same hashes.
    """
    source, target = quote_name(old), quote_name(new)
    try:
        spark.sql(f"ALTER TABLE {source} RENAME TO {target}")
        return
    except PySparkException:
        if not old.startswith(SESSION_CATALOG):
            raise
    # CREATE TABLE LIKE takes names of two parts.
    source, target = (quote_name(n.removeprefix(SESSION_CATALOG)) for n in (old, new))
    detail = _detail(spark, old)
    partitioned = any(c.isPartition for c in spark.catalog.listColumns(source))
    if detail.get("Type") == "EXTERNAL":
        spark.sql(f"CREATE TABLE {target} LIKE {source} LOCATION {quote_text(detail['Location'])}")
        if partitioned:
            spark.sql(f"MSCK REPAIR TABLE {target}")
    else:
        spark.sql(f"CREATE TABLE {target} LIKE {source}")
        with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            spark.table(source).write.insertInto(target, overwrite=True)
    shown = spark.sql(f"SHOW TBLPROPERTIES {source}").collect()
    if shown:
        pairs = ", ".join(f"{quote_text(r['key'])} = {quote_text(r['value'])}" for r in shown)
        spark.sql(f"ALTER TABLE {target} SET TBLPROPERTIES ({pairs})")
    before, after = _content(spark, old), _content(spark, new)
    if before != after:
        raise ContentMismatch(f"{old} has {before[0]} rows, {new} has {after[0]}, or others")
    spark.sql(f"DROP TABLE {source}")


def move_aside(
    spark: SparkSession,
    catalog: str,
    schemas: Iterable[str],
    suffix: str,
    *,
    confirm: bool = False,
    locations: dict[str, str] | None = None,
) -> list[str]:
    """Drop the views of each schema, move its tables to ``<schema><suffix>``, drop the schema.

    Does nothing without ``confirm``; a schema that does not exist is skipped; the first error
    stops. ``locations`` may name the folder of a backup schema. Returns the backup schemas made.
    """
    if not confirm:
        return []
    made = []
    for schema in schemas:
        place = f"{quote_part(catalog)}.{quote_part(schema)}"
        if not spark.catalog.databaseExists(f"{catalog}.{schema}"):
            continue
        # Decides the kind of every relation before anything is dropped.
        relations = inventory(spark, catalog, [schema]).collect()
        unknown = [r["fqn"] for r in relations if r["kind"] == "unknown"]
        if unknown:
            raise UnknownKind(f"neither tables nor views: {unknown}")
        backup = schema + suffix
        where = (locations or {}).get(backup)
        spark.sql(
            f"CREATE SCHEMA IF NOT EXISTS {quote_part(catalog)}.{quote_part(backup)}"
            + (f" LOCATION {quote_text(where)}" if where else "")
        )
        for r in relations:
            if r["kind"] == "view":
                spark.sql(f"DROP VIEW {quote_name(r['fqn'])}")
        for r in relations:
            if r["kind"] == "table":
                _move(spark, r["fqn"], full_name(catalog, backup, r["name"]))
        spark.sql(f"DROP SCHEMA {place}")
        made.append(backup)
    return made


def verify(spark: SparkSession, catalog: str, backups: Iterable[str]) -> DataFrame:
    """Tables per backup schema; 0 where there are none, null where there is no such schema."""
    backups = list(backups)
    known = [b for b in backups if spark.catalog.databaseExists(f"{catalog}.{b}")]
    wanted = spark.createDataFrame([(b, b in known) for b in backups], "schema string, known boolean")
    found = inventory(spark, catalog, known).where("kind = 'table'")
    tables = found.groupBy("schema").agg(F.count(F.lit(1)).alias("tables"))
    return wanted.join(tables, "schema", "left").select(
        "schema", F.when(F.col("known"), F.coalesce("tables", F.lit(0))).alias("tables")
    )
