"""State tables: what was done to which table or view, one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.manifest import with_keys, with_targets
from tablesync.schemas import TABLE_STATE, VALIDATION_COLUMNS

DONE = ("success", "ok")
# Fixed value: the name the key column had in older files.
OLD_KEY_NAME = "table_suffix"


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns first and typed, absent ones null; columns of the user's own after."""
    key = schema.fieldNames()[0]
    if OLD_KEY_NAME in df.columns and key not in df.columns:
        df = df.withColumnRenamed(OLD_KEY_NAME, key)
    own = [c for c in df.columns if c not in schema.fieldNames()]

    def typed(field: T.StructField) -> Column:
        if field.name not in df.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        column = F.col(field.name)
        if df.schema[field.name].dataType == field.dataType:
            return column
        return column.try_cast(field.dataType).alias(field.name)

    return df.select(*[typed(f) for f in schema.fields], *own)


def is_done(status: Column) -> Column:
    return F.coalesce(F.lower(F.trim(status)).isin(*DONE), F.lit(False))


def upsert(state: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Change only the columns ``updates`` has; a null there blanks the cell. New keys are added."""
    given = [c for c in updates.columns if c != key]
    changes = updates.select(key, F.struct(F.lit(True).alias("given"), *given).alias("change"))
    joined = state.join(changes, key, "full_outer")
    columns = [key]
    for c in [*[c for c in state.columns if c != key], *[c for c in given if c not in state.columns]]:
        old = F.col(c) if c in state.columns else F.lit(None)
        new = F.when(F.col("change").isNotNull(), F.col(f"change.{c}")).otherwise(old)
        columns.append(new.alias(c) if c in given else F.col(c))
    return joined.select(*columns)


def pending(work: DataFrame, state: DataFrame, key: str, status: str) -> DataFrame:
    """The work whose key is not done yet; a key the state does not know is pending."""
    return work.join(state.where(is_done(F.col(status))).select(key), key, "left_anti")


def skipped(work: DataFrame, state: DataFrame, key: str, status: str) -> DataFrame:
    """The complement of :func:`pending`."""
    return work.join(state.where(is_done(F.col(status))).select(key), key, "left_semi")


def reset(state: DataFrame, columns: Sequence[str] = VALIDATION_COLUMNS) -> DataFrame:
    """Blank the validation columns, so that every row is validated again."""
    types = {f.name: f.dataType for f in state.schema.fields}
    return state.withColumns({c: F.lit(None).cast(types[c]) for c in columns if c in types})


def seed(manifest: DataFrame) -> DataFrame:
    """One row with blank statuses per manifest row."""
    rows = with_targets(with_keys(manifest)).select(
        F.col("state_key").alias("table_key"),
        F.col("table").alias("source_table"),
        "target_table",
        F.col("job_key").alias("k8s_name"),
    )
    return conform(rows, TABLE_STATE)


def status_of(manifest: DataFrame, state: DataFrame, status: str = "apply_status") -> DataFrame:
    """Manifest rows with their status, found by the state key or else by the older key."""
    known = state.select(F.col("table_key"), F.lower(F.trim(status)).alias("found"))
    own = known.select(
        F.col("table_key").alias("state_key"), F.struct(F.col("found").alias("status")).alias("own")
    )
    old = known.select(
        F.col("table_key").alias("legacy_key"), F.struct(F.col("found").alias("status")).alias("old")
    )
    keyed = with_keys(manifest)
    return (
        keyed.join(own, "state_key", "left")
        .join(old, "legacy_key", "left")
        .select(
            *keyed.columns,
            F.coalesce(
                F.when(F.col("own").isNotNull(), F.col("own.status")).otherwise(F.col("old.status")),
                F.lit(""),
            ).alias("status"),
        )
    )


def upgrade(state: DataFrame, manifest: DataFrame) -> DataFrame:
    """Give rows under an older key the state key of their manifest rows.

    A manifest row that already has its own state row keeps that one; the older row goes.
    """
    keyed = with_keys(manifest).select("state_key", "legacy_key", "job_key").distinct()
    keyed = keyed.where(F.col("state_key") != F.col("legacy_key"))
    columns = state.columns
    missing = keyed.join(
        state.select(F.col("table_key").alias("state_key")), "state_key", "left_anti"
    )
    old_rows = state.select(F.col("table_key").alias("legacy_key"), F.struct(*columns).alias("row"))
    moved = missing.join(old_rows, "legacy_key").select(
        F.col("state_key").alias("table_key"),
        *[
            F.col("job_key" if c == "k8s_name" else f"row.{c}").alias(c)
            for c in columns
            if c != "table_key"
        ],
    )
    older = keyed.select(F.col("legacy_key").alias("table_key")).distinct()
    return state.join(older, "table_key", "left_anti").unionByName(moved).select(*columns)


def summary(state: DataFrame, status: str) -> DataFrame:
    """Rows per status, rows not touched left out."""
    shown = F.lower(F.trim(status))
    return (
        state.where(F.coalesce(shown, F.lit("")) != "")
        .groupBy(shown.alias("status"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def status_label(state: DataFrame) -> Column:
    """``OK``, ``DIFF (...)``, ``ERROR: ...`` or ``PENDING`` for a validated row."""
    status = F.lower(F.trim("validation_status"))
    shown = {"source": "source_count", "target": "target_count", "mismatched_rows": "mismatched_rows"}
    parts = [
        F.concat(F.lit(f"{name}="), F.coalesce(F.col(c).cast("string"), F.lit("")))
        for name, c in shown.items()
        if c in state.columns
    ]
    diff = F.concat(F.lit("DIFF ("), F.concat_ws(", ", *parts), F.lit(")"))
    error = F.concat(F.lit("ERROR: "), F.substring(F.coalesce("validation_error", F.lit("")), 1, 120))
    return (
        F.when(status == "ok", "OK")
        .when(status == "mismatch", diff)
        .when(status == "error", error)
        .otherwise("PENDING")
    )
