"""What to copy: selections made by a person, and the manifest made of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.functions import naming
from tablesync.functions.naming import filled
from tablesync.functions.partitions import spec_parts
from tablesync.sources.catalog import partition_specs


def _checked(selections: DataFrame, specs: DataFrame | None) -> DataFrame:
    named = selections.select(
        *[filled(F.col(c)).alias(c) for c in selections.columns],
        F.col("source_count").isNotNull().alias("has_count"),
        F.col("source_count").alias("count_text"),
    ).withColumns(
        {
            "table": F.concat_ws(".", "src_schema", "src_table"),
            "is_named": F.col("src_schema").isNotNull() & F.col("src_table").isNotNull(),
            "count": F.expr("try_cast(source_count AS BIGINT)"),
        }
    )
    if specs is None:
        return named.withColumns(
            {"derived_spec": F.lit(None).cast("string"), "spec_error": F.lit(None).cast("string")}
        )
    found = specs.select(
        F.col("table").alias("spec_table"),
        F.col("partition_columns").alias("derived_spec"),
        F.col("error").alias("spec_error"),
    )
    return named.join(found, named["table"] == found["spec_table"], "left")


def derived_specs(selections: DataFrame, catalog: str = "spark_catalog") -> DataFrame:
    """``table, partition_columns, error`` of the selected tables without partition columns, read from the catalog."""
    blank = _checked(selections, None).where(F.col("is_named") & F.col("partition_columns").isNull())
    names = [f"{catalog}.{r['table']}" for r in blank.select("table").distinct().collect()]
    found = partition_specs(selections.sparkSession, names)
    return found.select(F.substring("fqn", len(catalog) + 2, 1 << 30).alias("table"), "partition_columns", "error")


def normalize(
    selections: DataFrame, specs: DataFrame | None = None, *, auto_derive: bool = False, source_catalog: str = "spark_catalog"
) -> DataFrame:
    """Manifest rows: names trimmed, the target given only where it is not the source's.

    ``specs`` (``table, partition_columns, error``) fills the partition columns a selection
    leaves blank; with ``auto_derive`` they are read from the tables themselves.
    """
    if auto_derive and specs is None:
        specs = derived_specs(selections, source_catalog)
    rows = _checked(selections, specs).where("is_named")

    def when_other(target: str, source: str):
        return F.when(F.col(target) != F.col(source), F.col(target))

    return rows.select(
        "table",
        F.coalesce("partition_columns", "derived_spec", F.lit("")).alias("partitionColumns"),
        F.col("filter_expression").alias("filterExpression"),
        when_other("tgt_schema", "src_schema").alias("outputSchema"),
        when_other("tgt_table", "src_table").alias("outputTable"),
        F.col("k8s_name").alias("k8sName"),
        F.col("count").alias("source_count"),
    )


def errors(selections: DataFrame, specs: DataFrame | None = None) -> DataFrame:
    """What is wrong with selections: rows left out, counts and specs that were dropped."""
    rows = _checked(selections, specs)
    named = F.col("is_named")
    found = F.array(
        F.when(~named, F.lit("missing src_schema or src_table")),
        F.when(
            named & F.col("has_count") & F.col("count").isNull(),
            F.concat(F.lit("source_count is not an integer: "), F.col("count_text")),
        ),
        F.when(
            named & F.col("partition_columns").isNull() & F.col("spec_error").isNotNull(),
            F.concat(F.lit("partition derivation failed: "), F.col("spec_error")),
        ),
        F.when(
            named & F.exists(spec_parts(F.col("partition_columns")), lambda p: ~p["valid"]),
            F.concat(F.lit("cannot read partition spec: "), F.col("partition_columns")),
        ),
    )
    return rows.select("table", F.explode(F.array_compact(found)).alias("error"))


def with_keys(manifest: DataFrame) -> DataFrame:
    """Add the job key, the state key and the key of older states."""
    table = F.col("table")
    return manifest.withColumn("job_key", naming.job_key(table, F.col("k8sName"))).withColumns(
        {
            "state_key": naming.state_key(table, F.col("job_key")),
            "legacy_key": naming.legacy_key(table),
        }
    )


def with_targets(manifest: DataFrame) -> DataFrame:
    """Add the target schema and table, and an error where no schema can be told."""
    table = F.col("table")
    return manifest.withColumns(
        {
            "target_schema": naming.target_schema(table, F.col("outputSchema")),
            "target_name": naming.target_table(table, F.col("outputTable")),
        }
    ).withColumns(
        {
            "target_table": F.when(
                F.col("target_schema").isNotNull(), F.concat_ws(".", "target_schema", "target_name")
            ),
            "target_error": F.when(
                F.col("target_schema").isNull(),
                F.concat(F.lit("no target schema for table "), F.coalesce("table", F.lit("<null>"))),
            ),
        }
    )


def key_problems(manifest: DataFrame, name_limit: int | None = None) -> DataFrame:
    """Job keys that would stop a batch: used by more than one row, or longer than ``name_limit``
    where something outside asks for one.

    The pair (key, table) is counted first, so a key that a third of the rows share is
    already one row per table and task when the keys are brought together.
    """
    per_table = with_keys(manifest).groupBy("job_key", "table").agg(F.count(F.lit(1)).alias("n"))
    per_key = per_table.groupBy("job_key").agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("tables")
    )
    problems = F.array(
        F.when(F.col("tables") > 1, F.lit("same key for different tables")),
        F.when((F.col("tables") == 1) & (F.col("rows") > 1), F.lit("same key for several rows")),
        F.when(F.length("job_key") > F.lit(name_limit), F.lit("key too long")),
    )
    return per_key.select(
        "job_key", "rows", "tables", F.explode(F.array_compact(problems)).alias("problem")
    )


def target_conflicts(plan: DataFrame) -> DataFrame:
    """``target_table, conflict`` where several rows write one table and are not windows of one source."""
    per_target = plan.where(F.col("target_table").isNotNull()).groupBy("target_table").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("source_table").alias("one"),
        F.max("source_table").alias("other"),
        F.min(F.length("filter_expression")).alias("shortest"),
    )
    several = F.col("rows") > 1
    conflict = F.when(
        several & (F.col("one") != F.col("other")), F.lit("several sources write this table")
    ).when(several & (F.col("shortest") == 0), F.lit("several rows write this table, one without a window"))
    return per_target.select("target_table", conflict.alias("conflict")).where("conflict IS NOT NULL")


def select_rows(manifest: DataFrame, *selectors: str) -> DataFrame:
    """Rows named by any selector: full or bare table name, state key, older key or job key."""
    wanted = list(selectors)
    keyed = with_keys(manifest)
    names = [
        F.trim("table"),
        naming.bare_name(F.trim("table")),
        F.col("legacy_key"),
        F.col("state_key"),
        F.col("job_key"),
    ]
    hit = F.lit(False)
    for name in names:
        hit = hit | name.isin(wanted)
    return keyed.where(hit)


def plan(manifest: DataFrame) -> DataFrame:
    """What a batch would do with every row, without doing it."""
    resolved = with_targets(with_keys(manifest))
    invalid = F.exists(spec_parts(F.col("partitionColumns")), lambda p: ~p["valid"])
    return resolved.select(
        "state_key",
        "job_key",
        F.col("table").alias("source_table"),
        "target_table",
        F.coalesce("partitionColumns", F.lit("")).alias("partition_columns"),
        F.coalesce("filterExpression", F.lit("")).alias("filter_expression"),
        "source_count",
        F.coalesce(
            F.col("target_error"),
            F.when(invalid, F.concat(F.lit("cannot read partition spec: "), F.col("partitionColumns"))),
        ).alias("plan_error"),
    )
