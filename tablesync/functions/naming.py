"""Keys and names of manifest rows, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def filled(column: Column) -> Column:
    """The trimmed text, null when blank."""
    return F.nullif(F.trim(column), F.lit(""))


def has_schema(table: Column) -> Column:
    return F.contains(table, F.lit("."))


def first_part(table: Column) -> Column:
    return F.substring_index(table, ".", 1)


def after_first_part(table: Column) -> Column:
    return F.when(has_schema(table), F.regexp_replace(table, r"^[^.]*\.", "")).otherwise(table)


def bare_name(table: Column) -> Column:
    return F.substring_index(table, ".", -1)


def job_key(table: Column, override: Column) -> Column:
    """The override, or the bare name without ``_`` and ``-``."""
    return F.coalesce(filled(override), F.translate(bare_name(F.trim(table)), "_-", ""))


def legacy_key(table: Column) -> Column:
    """``<schema>__<table>``, the key of states written before jobs had names."""
    name = F.trim(table)
    joined = F.concat_ws("__", first_part(name), after_first_part(name))
    return F.when(has_schema(name), joined).otherwise(name)


def state_key(table: Column, job: Column) -> Column:
    return F.concat_ws("__", legacy_key(table), filled(job))


def target_schema(table: Column, override: Column) -> Column:
    """Null when neither the override nor the table names a schema."""
    own = F.when(has_schema(table), first_part(F.trim(table)))
    return F.coalesce(filled(override), own)


def target_table(table: Column, override: Column) -> Column:
    return F.coalesce(filled(override), after_first_part(F.trim(table)))
