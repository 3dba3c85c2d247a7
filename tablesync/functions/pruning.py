"""Partition filters that follow from any predicate.

Catalyst prunes partitions by predicates on the stored columns only. From a predicate on the columns that these were
derived from follow weaker ones on them: the transforms never reverse the order, so each
comparison has its bound, AND keeps what either side says, OR needs both sides, and equality also
fixes a bucket. What has no bound here only prunes nothing.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.partitions import PartitionField, partition_filter, transformed
from tablesync.functions.quoting import quote_part

# Catalyst's names of comparisons, and each one seen from the other side.
COMPARISONS = {"EqualTo": "=", "EqualNullSafe": "<=>", "LessThan": "<", "LessThanOrEqual": "<=", "GreaterThan": ">", "GreaterThanOrEqual": ">="}
MIRRORED = {"=": "=", "<=>": "<=>", "<": ">", "<=": ">=", ">": "<", ">=": "<="}


def implied(df: DataFrame, fields: list[PartitionField], where: str | Column) -> Column | None:
    """What ``where`` says about the stored partition columns of ``df`` that were derived, or None."""
    derived = [f for f in fields if f.transform != "identity" and f.column in df.columns and f.source in df.columns]
    if not derived:
        return None
    # The predicate is resolved against the columns alone: nothing is read or listed.
    spark = df.sparkSession
    empty = spark.createDataFrame(spark.sparkContext.emptyRDD(), df.schema)
    plan = empty.where(where)._jdf.queryExecution().analyzed()
    if plan.nodeName() != "Filter":
        return None
    return _Reader(df.schema, derived).read(plan.condition())


class _Reader:
    def __init__(self, schema: T.StructType, fields: list[PartitionField]):
        self.schema, self.fields, self.shared = schema, fields, {}

    def read(self, node) -> Column | None:
        name = node.nodeName()
        if name in ("And", "Or"):
            sides = [self.read(node.left()), self.read(node.right())]
            known = [s for s in sides if s is not None]
            if name == "Or":
                return reduce(or_, known) if len(known) == 2 else None
            return reduce(and_, known) if known else None
        if name == "Between":
            return self.read(node.replacement())
        if name == "With":  # an expression that is read several times
            self.shared |= {d.id().toString(): d.child() for d in _each(node.defs())}
            return self.read(node.child())
        if name == "In":
            source, values = self._source(node.value()), _each(node.list())
            if source is None or not all(v.foldable() for v in values):
                return None
            bounds = [self._bound(source, "=", v) for v in values]
            return reduce(or_, bounds) if bounds and all(b is not None for b in bounds) else None
        if name in ("IsNull", "IsNotNull"):
            source = self._source(node.child())
            if source is None:
                return None
            columns = [F.col(quote_part(f.column)) for f in self.fields if f.source == source]
            return reduce(and_, [c.isNull() if name == "IsNull" else c.isNotNull() for c in columns])
        if name in COMPARISONS:
            op, left, right = COMPARISONS[name], node.left(), node.right()
            if left.foldable():
                op, left, right = MIRRORED[op], right, left
            source = self._source(left)
            if source is not None and right.foldable():
                return self._bound(source, op, right)
        return None

    def _source(self, node) -> str | None:
        """The column that a partition column was derived from, if the expression is just that."""
        if node.nodeName() == "CommonExpressionRef":
            node = self.shared.get(node.id().toString(), node)
        while node.nodeName() == "Cast" and node.child().dataType().equals(node.dataType()):
            node = node.child()
        if node.nodeName() != "AttributeReference":
            return None
        name = node.name()
        return name if any(f.source == name for f in self.fields) else None

    def _bound(self, source: str, op: str, value) -> Column | None:
        """``source op value`` as all derived columns tell it; the value keeps its type, which the source was given by the resolution."""
        dtype = self.schema[source].dataType
        literal = F.expr(value.sql())
        parts = []
        for field in self.fields:
            if field.source != source:
                continue
            column = F.col(quote_part(field.column))
            if op in ("=", "<=>"):
                bound = transformed(literal.cast(dtype), dtype, field)
                parts.append(column.eqNullSafe(bound) if op == "<=>" else column == bound)
            else:
                found = partition_filter(dtype, field, op, literal)
                if found is not None:
                    parts.append(found)
        return reduce(and_, parts) if parts else None


def _each(found) -> list:
    at, out = found.iterator(), []
    while at.hasNext():
        out.append(at.next())
    return out


def pruned(df: DataFrame, fields: list[PartitionField], where: str | Column) -> DataFrame:
    """``df`` filtered by ``where`` and by what follows from it for the partitions."""
    found = implied(df, fields, where)
    return df.where(where) if found is None else df.where(where).where(found)
