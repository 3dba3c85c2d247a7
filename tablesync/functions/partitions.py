"""Partition specs: ``"ts:days,kind"``, their columns, and filters derived from them.

A Parquet table has no hidden partitioning, so a transform becomes a stored column next to
its source (``ts:days`` is the column ``ts_day``). An Iceberg table takes the transform itself.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.quoting import quote_part

# The transforms a spec may name, and the column suffix of each.
SUFFIXES = {
    "days": "day",
    "hours": "hour",
    "months": "month",
    "years": "year",
    "bucket": "bucket",
    "truncate": "trunc",
}
MONOTONE = ("identity", "days", "hours", "months", "years", "truncate")
SPEC_PROPERTY = "tablesync.partition_spec"


class BadSpec(ValueError):
    """A partition spec that cannot be read."""


@dataclass(frozen=True)
class PartitionField:
    source: str
    transform: str = "identity"
    width: int | None = None

    @property
    def column(self) -> str:
        if self.transform == "identity":
            return self.source
        return f"{self.source}_{SUFFIXES[self.transform]}"

    @property
    def text(self) -> str:
        if self.transform == "identity":
            return self.source
        width = "" if self.width is None else f"[{self.width}]"
        return f"{self.source}:{self.transform}{width}"


def parse_spec(spec: str | None) -> list[PartitionField]:
    """The fields of one spec. Blank means not partitioned; an unknown transform is an error."""
    fields = []
    for part in (spec or "").split(","):
        if not part.strip(" "):
            continue
        source, colon, transform = (p.strip(" ") for p in part.partition(":"))
        match = re.fullmatch(r"(\w+?)(?:\[(\d+)\])?", transform if colon else "identity", re.ASCII)
        name = match.group(1) if match else None
        width = int(match.group(2)) if match and match.group(2) else None
        if not source or (name != "identity" and name not in SUFFIXES):
            raise BadSpec(f"cannot read partition spec part {part.strip()!r}")
        if (name in ("bucket", "truncate")) != (width is not None) or (width is not None and not 0 < width < 1 << 31):
            raise BadSpec(f"{name} must{' ' if not width else ' not '}have a width: {part.strip()!r}")
        fields.append(PartitionField(source, name, width))
    return fields


def spec_text(fields: list[PartitionField]) -> str:
    return ",".join(f.text for f in fields)


def spec_parts(spec: Column) -> Column:
    """The same reading for a column of specs: array of ``(col, transform, width, valid)``."""

    def part(text: Column) -> Column:
        pieces = F.transform(F.split(text, ":"), lambda x: F.trim(x))
        col = F.get(pieces, F.lit(0))
        transform = F.coalesce(F.get(pieces, F.lit(1)), F.lit("identity"))
        name = F.regexp_extract(transform, r"^(\w+?)(\[\d+\])?$", 1)
        width = F.nullif(F.regexp_extract(transform, r"\[(\d+)\]$", 1), F.lit(""))
        sized = name.isin("bucket", "truncate")
        known = name.isin("identity", *SUFFIXES)
        return F.struct(
            col.alias("col"),
            transform.alias("transform"),
            width.try_cast("int").alias("width"),
            (
                (F.size(pieces) <= 2)
                & (col != "")
                & known
                & (sized == width.isNotNull())
                & F.coalesce(width.try_cast("int") > 0, width.isNull())
            ).alias("valid"),
        )

    parts = F.filter(F.split(F.coalesce(spec, F.lit("")), ","), lambda x: F.trim(x) != "")
    return F.transform(parts, part)


def _utc_units(column: Column, micros: int) -> Column:
    """Whole units since 1970, rounded down."""
    since = F.unix_micros(column)
    return F.call_function("div", since - F.pmod(since, F.lit(micros).cast("long")), F.lit(micros).cast("long"))


def _utc_day(column: Column, dtype: T.DataType) -> Column:
    """The day in UTC: an instant is in one partition, whatever zone a session shows it in."""
    if isinstance(dtype, T.TimestampType):
        return F.date_from_unix_date(_utc_units(column, 86_400_000_000).cast("int"))
    return F.to_date(column)


def transformed(column: Column, dtype: T.DataType, field: PartitionField) -> Column:
    """The partition value of a source column."""
    match field.transform:
        case "identity":
            return column
        case "days":
            return _utc_day(column, dtype)
        case "hours":
            if isinstance(dtype, T.TimestampType):
                return _utc_units(column, 3_600_000_000)
            day = F.datediff(F.to_date(column), F.lit("1970-01-01").cast("date"))
            return day.cast("long") * 24 + F.hour(column)
        case "months":
            return F.trunc(_utc_day(column, dtype), "MM")
        case "years":
            return F.trunc(_utc_day(column, dtype), "YYYY")
        case "bucket":
            return F.pmod(F.hash(column), F.lit(field.width))
        case _:
            if isinstance(dtype, T.StringType):
                return F.substring(column, 1, field.width)
            return column - F.pmod(column, F.lit(field.width))


def with_partition_columns(df: DataFrame, fields: list[PartitionField]) -> DataFrame:
    """Add the derived columns and move all partition columns to the end, in spec order."""
    derived = {
        f.column: transformed(df[quote_part(f.source)], df.schema[f.source].dataType, f)
        for f in fields
        if f.transform != "identity"
    }
    names = [f.column for f in fields]
    plain = [c for c in df.columns if c not in names]
    return df.withColumns(derived).select(*map(quote_part, [*plain, *names]))


def partition_filter(
    dtype: T.DataType, field: PartitionField, op: str, value: Any
) -> Column | None:
    """What ``source <op> value`` says about the stored partition column, or None.

    Catalyst prunes partitions by predicates on the stored column only. The transforms used
    here never reverse the order, so the derived comparison holds for all matching rows; it is
    never strict, because rows on both sides of the value share the value's partition.
    """
    if field.transform not in MONOTONE:
        return None
    bound = transformed(F.lit(value).cast(dtype), dtype, field)
    column = F.col(quote_part(field.column))
    if op in ("<", "<="):
        return column <= bound
    if op in (">", ">="):
        return column >= bound
    return column == bound if op == "=" else None


def compare(df: DataFrame, fields: list[PartitionField], column: str, op: str, value: Any) -> Column:
    """``column <op> value`` together with every partition filter that follows from it."""
    dtype = df.schema[column].dataType
    left, right = F.col(quote_part(column)), F.lit(value).cast(dtype)
    condition = {
        "<": left < right,
        "<=": left <= right,
        ">": left > right,
        ">=": left >= right,
        "=": left == right,
    }[op]
    for field in fields:
        if field.source != column or field.transform == "identity" or field.column not in df.columns:
            continue
        derived = partition_filter(dtype, field, op, value)
        if derived is not None:
            condition = condition & derived
    return condition


def window(df: DataFrame, fields: list[PartitionField], column: str, low: Any, high: Any) -> Column:
    """The half-open window ``low <= column < high`` with its partition filters."""
    return compare(df, fields, column, ">=", low) & compare(df, fields, column, "<", high)
