"""Null-safe comparison of values of any type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _needs_rewrite(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.MapType):
        return True
    if isinstance(dtype, T.ArrayType):
        return _needs_rewrite(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_needs_rewrite(f.dataType) for f in dtype.fields)
    return isinstance(dtype, (T.VariantType, T.CalendarIntervalType))


def comparable(column: Column, dtype: T.DataType) -> Column:
    """The value in a form Spark can group by and compare.

    Maps have no equality, so they become key-sorted entry arrays, at any depth.
    """
    if not _needs_rewrite(dtype):
        return column
    if isinstance(dtype, T.MapType):
        return F.sort_array(
            F.transform(
                F.map_entries(column),
                lambda e: F.struct(
                    comparable(e["key"], dtype.keyType).alias("key"),
                    comparable(e["value"], dtype.valueType).alias("value"),
                ),
            )
        )
    if isinstance(dtype, T.ArrayType):
        return F.transform(column, lambda x: comparable(x, dtype.elementType))
    if isinstance(dtype, T.StructType):
        fields = [comparable(column[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.VariantType):
        return F.to_json(column)
    return column.cast("string")


def differs(left: Column, right: Column) -> Column:
    """True where the two values are not equal, nulls being equal to nulls."""
    return ~left.eqNullSafe(right)


def any_of(conditions: list[Column]) -> Column:
    """OR over any number of conditions, as a balanced tree so that wide tables stay shallow."""
    if not conditions:
        return F.lit(False)
    if len(conditions) == 1:
        return conditions[0]
    middle = len(conditions) // 2
    return any_of(conditions[:middle]) | any_of(conditions[middle:])
