"""Copy: scan, filter, and overwrite only the partitions the data falls in."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.errors import SPARK_ERRORS, message
from tablesync.functions.partitions import (
    SPEC_PROPERTY,
    PartitionField,
    parse_spec,
    spec_text,
    window,
    with_partition_columns,
)
from tablesync.functions.pruning import pruned
from tablesync.functions.quoting import quote_name, quote_part, quote_text
from tablesync.sources.catalog import partition_spec
from tablesync.sources.workspace import scratch_schema, use_checkpoints


# Begins the message of a write that was stopped because the target cannot hold a value.
NARROWED = "tablesync: the target cannot hold a value of "


class LayoutConflict(ValueError):
    """The target has other columns, other partitions or narrower types than what is to be written."""


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def scan(spark: SparkSession, table: str, where: str | Column | None = None) -> DataFrame:
    """The table, filtered; a blank filter keeps every row. Only partitions are read that the filter leaves, also
    where their columns were derived from those of the filter."""
    df = spark.table(quote_name(table))
    if where is None or (isinstance(where, str) and not where.strip()):
        return df
    return pruned(df, parse_spec(partition_spec(spark, table)), where)


def scan_window(spark: SparkSession, table: str, column: str, low: Any, high: Any) -> DataFrame:
    """The rows with ``low <= column < high``, reading only the partitions they can be in.

    The table's own spec says which stored columns were derived from this one.
    """
    df = spark.table(quote_name(table))
    return df.where(window(df, parse_spec(partition_spec(spark, table)), column, low, high))


def _fields(spec: str | Sequence[PartitionField]) -> list[PartitionField]:
    return parse_spec(spec) if spec is None or isinstance(spec, str) else list(spec)


def _laid_out(df: DataFrame, fields: list[PartitionField], distribute: str) -> DataFrame:
    """Partition columns last, and rows brought together so that a day is not one file per task.

    REBALANCE splits a partition value that is too large for one task and joins small ones.
    ``none`` writes as scanned, without a shuffle.
    """
    df = with_partition_columns(df, fields)
    if distribute == "none" or not fields:
        return df
    if distribute != "rebalance":
        raise ValueError(f"distribute must be 'rebalance' or 'none', not {distribute!r}")
    return df.hint("rebalance", *[F.col(quote_part(f.column)) for f in fields])


def _check_layout(spark: SparkSession, table: str, rows: DataFrame, fields: list[PartitionField]) -> None:
    """Stop before a write that would leave a column out or replace more than its partitions."""
    folded = _folded(spark)
    have = spark.table(quote_name(table)).columns
    written = {folded(c) for c in rows.columns}
    lost = [c for c in rows.columns if folded(c) not in {folded(h) for h in have}]
    absent = [h for h in have if folded(h) not in written]
    if lost or absent:
        raise LayoutConflict(f"{table}: the table lacks columns {lost}, the rows lack {absent}")
    stored = [folded(c.name) for c in spark.catalog.listColumns(quote_name(table)) if c.isPartition]
    wanted = [folded(f.column) for f in fields]
    if stored != wanted:
        raise LayoutConflict(f"{table} is partitioned by {stored}, not by {wanted}")


def _whole(dtype: T.DataType, kind: type[T.DataType]) -> bool:
    """Is the kind of type found anywhere within?"""
    if isinstance(dtype, T.StructType):
        return any(_whole(f.dataType, kind) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _whole(dtype.elementType, kind)
    return isinstance(dtype, kind)


def _nullable(dtype: T.DataType) -> T.DataType:
    """The type with nulls allowed everywhere within, as casts need it."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in dtype.fields])
    return T.ArrayType(_nullable(dtype.elementType)) if isinstance(dtype, T.ArrayType) else dtype


def _bare(dtype: T.DataType) -> str:
    """The type without what is said about nulls."""
    return dtype.simpleString()


def stored(rows: DataFrame, target: T.StructType, table: str, fold: Callable[[str], str] = str.lower) -> DataFrame:
    """The columns of ``rows`` in the order and the types of ``target``, where every value is kept.

    A value that does not come back from the target's type as it was stops the write with an error that begins with NARROWED; the
    check is part of the pass that writes. Types that values cannot be compared in, such as maps, must be the same.
    """
    names = {fold(c): c for c in rows.columns}
    out = []
    for field in target.fields:
        name = names[fold(field.name)]
        own, kind = F.col(quote_part(name)), rows.schema[name].dataType
        if _bare(kind) == _bare(field.dataType):
            out.append(own.alias(field.name))
            continue
        if _whole(kind, T.MapType) or _whole(field.dataType, T.MapType):
            raise LayoutConflict(f"{table}: {name} is {_bare(kind)}, the table has {_bare(field.dataType)}")
        # Types within types know no try_cast; there a cast that fails stops the write by itself.
        nested = isinstance(kind, (T.ArrayType, T.StructType)) or isinstance(field.dataType, (T.ArrayType, T.StructType))
        new = own.cast(_nullable(field.dataType)) if nested else own.try_cast(field.dataType)
        back = new.cast(_nullable(kind)) if nested else new.try_cast(kind)
        told = f"{NARROWED}{name}, which is {_bare(kind)}, in {table}, which has {_bare(field.dataType)}"
        out.append(F.when(own.eqNullSafe(back), new).otherwise(F.raise_error(F.lit(told))).alias(field.name))
    return rows.select(*out)


@contextmanager
def _narrowing(table: str) -> Iterator[None]:
    """A write stopped by ``stored`` is a LayoutConflict."""
    try:
        yield
    except SPARK_ERRORS as problem:
        told = message(problem)
        found = re.search(re.escape(NARROWED) + r"[^\n]*", told) or re.search(r"\[CAST_(OVERFLOW|INVALID_INPUT)[^\n]*", told)
        if not found:
            raise
        raise LayoutConflict(f"{table}: {found[0]}") from problem


@contextmanager
def _staged(rows: DataFrame, aside: bool) -> Iterator[DataFrame]:
    """The rows; with ``aside`` written to a table of their own first, so that what can stop them does so before anything is replaced.

    Only partitions are replaced after the write has ended; a table without partitions is emptied before.
    """
    if not aside:
        yield rows
        return
    spark = rows.sparkSession
    place = scratch_schema(spark, "aside")
    try:
        rows.write.format("parquet").saveAsTable(f"{place}.ready")
        yield spark.table(f"{place}.ready")
    finally:
        spark.sql(f"DROP SCHEMA {quote_part(place)} CASCADE")


def overwrite_partitions(
    df: DataFrame,
    table: str,
    spec: str | Sequence[PartitionField] = "",
    *,
    provider: str = "parquet",
    distribute: str = "rebalance",
) -> None:
    """Create the table, or replace the partitions that ``df`` has rows in and keep the others.

    A table without partitions is replaced as a whole. A table with other columns, another
    layout, or a type that cannot hold a value is left alone: that is a :class:`LayoutConflict`.
    """
    spark = df.sparkSession
    fields = _fields(spec)
    if provider == "iceberg":
        _overwrite_iceberg(df, table, fields)
        return
    rows = _laid_out(df, fields, distribute)
    columns = [f.column for f in fields]
    if not spark.catalog.tableExists(quote_name(table)):
        # Created empty: filling it by insert registers the written partitions as it goes,
        # where a filled create lists the whole table again.
        writer = spark.createDataFrame([], rows.schema).write.format(provider)
        if columns:
            writer = writer.partitionBy(*columns)
        writer.saveAsTable(quote_name(table))
        if fields:
            _set_property(spark, table, SPEC_PROPERTY, spec_text(fields))
    else:
        _check_layout(spark, table, rows, fields)
    # The option of the same name is ignored by insertInto, the session setting is not.
    with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        target = spark.table(quote_name(table)).schema
        fitted = stored(rows, target, table, _folded(spark))
        checked = {_bare(f.dataType) for f in rows.schema.fields} != {_bare(f.dataType) for f in target.fields}
        with _narrowing(table), _staged(fitted, aside=not columns and checked) as ready:
            ready.write.insertInto(quote_name(table), overwrite=True)


def _overwrite_iceberg(df: DataFrame, table: str, fields: list[PartitionField]) -> None:
    transforms = {
        "days": F.partitioning.days,
        "hours": F.partitioning.hours,
        "months": F.partitioning.months,
        "years": F.partitioning.years,
    }
    if df.sparkSession.catalog.tableExists(quote_name(table)):
        df.writeTo(quote_name(table)).overwritePartitions()
        return
    columns = []
    for f in fields:
        if f.transform == "bucket":
            columns.append(F.partitioning.bucket(f.width, f.source))
        elif f.transform == "truncate":
            raise ValueError("Spark cannot create a truncate partition; create the table first")
        else:
            columns.append(transforms[f.transform](f.source) if f.transform in transforms else F.col(f.source))
    writer = df.writeTo(quote_name(table)).using("iceberg")
    (writer.partitionedBy(*columns) if columns else writer).create()


def _set_property(spark: SparkSession, table: str, key: str, value: str) -> None:
    spark.sql(
        f"ALTER TABLE {quote_name(table)} SET TBLPROPERTIES ({quote_text(key)} = {quote_text(value)})"
    )


def carry_properties(spark: SparkSession, source: str, target: str, prefix: str = "graph") -> None:
    """Set the source's properties under a prefix on the target, in one statement."""
    shown = spark.sql(f"SHOW TBLPROPERTIES {quote_name(source)}")
    rows = shown.where(F.col("key").startswith(prefix)).collect()
    if rows:
        pairs = ", ".join(f"{quote_text(r['key'])} = {quote_text(r['value'])}" for r in rows)
        spark.sql(f"ALTER TABLE {quote_name(target)} SET TBLPROPERTIES ({pairs})")


def copy_table(
    spark: SparkSession,
    source: str,
    target: str,
    *,
    spec: str = "",
    where: str | Column | None = None,
    property_prefix: str = "graph",
    provider: str = "parquet",
    distribute: str | None = None,
    merge_schema: bool = False,
    conflict: str = "error",
) -> None:
    """Scan, filter, overwrite the touched partitions, carry the properties over.

    ``merge_schema`` adds the columns that the target lacks; without it they stop the copy. ``conflict`` is then what happens to
    columns of other types, as in :func:`copy_merging_schema`.

    A source stored by the spec already has each partition's rows together and is not shuffled.
    """
    rows = scan(spark, source, where)
    if distribute is None:
        stored_alike = partition_spec(spark, source) == spec_text(parse_spec(spec))
        distribute = "none" if stored_alike else "rebalance"
    if merge_schema and provider != "iceberg":
        copy_merging_schema(rows, target, spec, provider=provider, distribute=distribute, conflict=conflict)
    else:
        overwrite_partitions(rows, target, spec, provider=provider, distribute=distribute)
    carry_properties(spark, source, target, property_prefix)


# ---- one table in several windows


def _partitions_of(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*map(quote_part, columns)).distinct()


def _in_partitions(target: DataFrame, values: DataFrame, columns: list[str]) -> DataFrame:
    """The target's rows in the partitions listed by ``values``.

    The range of each column is a literal, which prunes the scan whatever the number of
    partitions; the semi join leaves out what lies between.
    """
    bounds = [
        x
        for c in columns
        for x in (
            F.min(quote_part(c)).alias(f"low {c}"),
            F.max(quote_part(c)).alias(f"high {c}"),
            F.coalesce(F.bool_or(F.col(quote_part(c)).isNull()), F.lit(False)).alias(f"null {c}"),
        )
    ]
    found = values.agg(*bounds).first()
    kept = target
    for c in columns:
        column = target[quote_part(c)]
        low, high, has_null = found[f"low {c}"], found[f"high {c}"], found[f"null {c}"]
        inside = F.lit(False) if low is None else column.between(F.lit(low), F.lit(high))
        kept = kept.where(inside | column.isNull() if has_null else inside)
    listed = values.select(*[F.col(quote_part(c)).alias(f"touched {c}") for c in columns])
    same = [F.col(quote_part(c)).eqNullSafe(F.col(quote_part(f"touched {c}"))) for c in columns]
    return kept.join(listed, reduce(and_, same), "left_semi")


def _drop_partitions(spark: SparkSession, table: str, emptied: DataFrame, columns: list[str]) -> None:
    """Drop the listed partitions, some at a time as the statements are text."""
    types = {f.name: f.dataType.simpleString() for f in spark.table(quote_name(table)).schema.fields}
    specs: list[str] = []

    def run() -> None:
        if specs:
            spark.sql(f"ALTER TABLE {quote_name(table)} DROP IF EXISTS {', '.join(specs)}")
            specs.clear()

    texts = emptied.select(*[F.col(quote_part(c)).cast("string").alias(f"v{i}") for i, c in enumerate(columns)])
    for r in texts.toLocalIterator():
        parts = [
            f"{quote_part(c)} = {'null' if v is None else v if types[c] in ('int', 'bigint', 'smallint', 'tinyint') else quote_text(v)}"
            for c, v in zip(columns, r)
        ]
        specs.append(f"PARTITION ({', '.join(parts)})")
        if len(specs) == 100:
            run()
    run()


def copy_chunk(
    df: DataFrame,
    table: str,
    spec: str,
    predicate: str | Column,
    *,
    provider: str = "parquet",
    distribute: str | None = None,
    merge_schema: bool = False,
) -> None:
    """Replace the target's rows that match the predicate by the source's, and no others.

    A window that cuts a partition would otherwise lose the rows of that partition that another
    window wrote: an overwrite replaces whole partitions. The partitions touched are those of the
    new rows and those of the target's own matching rows, so that a rerun also takes away what the source no
    longer has; a partition that is left without rows is dropped.
    """
    if provider == "iceberg":
        raise ValueError("windows of an Iceberg table need its own overwrite by filter")
    spark = df.sparkSession
    fields = _fields(spec)
    distribute = distribute or "rebalance"
    matching = F.expr(predicate) if isinstance(predicate, str) else predicate
    rows = df.where(matching)
    if not spark.catalog.tableExists(quote_name(table)):
        overwrite_partitions(rows, table, fields, provider=provider, distribute=distribute)
        return
    new = with_partition_columns(rows, fields)
    if merge_schema:
        new = _with_merged_columns(new, table)
    _check_layout(spark, table, new, fields)
    target = spark.table(quote_name(table))
    others = ~F.coalesce(matching, F.lit(False))
    if fields:
        use_checkpoints(spark)
        columns = [f.column for f in fields]
        values = _partitions_of(new, columns).union(_partitions_of(target.where(matching), columns)).distinct().checkpoint()
        kept = _in_partitions(target, values, columns).where(others)
        left = _partitions_of(new, columns).union(_partitions_of(kept, columns)).distinct()
        same = [values[quote_part(c)].eqNullSafe(left[quote_part(c)]) for c in columns]
        emptied = values.join(left, reduce(and_, same), "left_anti").checkpoint()
        merged = new.unionByName(kept)
        merged = merged.select(*map(quote_part, [c for c in merged.columns if c not in columns] + columns))
        identity = [PartitionField(c) for c in columns]
        overwrite_partitions(merged, table, identity, provider=provider, distribute=distribute)
        _drop_partitions(spark, table, emptied, columns)
        return
    # Without partitions the table cannot be read and replaced at once, so the kept rows are
    # written aside first.
    place = scratch_schema(spark, "aside")
    try:
        target.where(others).unionByName(new).write.format("parquet").saveAsTable(f"{place}.kept")
        overwrite_partitions(spark.table(f"{place}.kept"), table, provider=provider, distribute="none")
    finally:
        spark.sql(f"DROP SCHEMA {quote_part(place)} CASCADE")


def chunk_coverage(df: DataFrame, predicates: Sequence[str | Column]) -> DataFrame:
    """How many rows fall in no window, in one, in several: ``hits, n``. One narrow scan."""
    inside = [
        F.coalesce((F.expr(p) if isinstance(p, str) else p).cast("int"), F.lit(0)) for p in predicates
    ]
    hits = sum(inside[1:], inside[0]) if inside else F.lit(0)
    return df.select(hits.cast("long").alias("hits")).groupBy("hits").agg(F.count(F.lit(1)).alias("n"))


# ---- schema merge


class TypeConflict(ValueError):
    """A column has another type on the target."""


# Whole-number types from the narrowest, with the digits that the largest of each has.
WHOLE = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that keeps every value of both: the join of two types in the lattice that ends in string.

    Whole numbers widen to each other, to decimals of enough digits and, up to int, to double; float to double; date to timestamp without zone;
    all else, and types within types, to string.
    """
    x, y = a.simpleString(), b.simpleString()
    if x == y:
        return a
    if x in WHOLE and y in WHOLE:
        return a if WHOLE[x] > WHOLE[y] else b
    sized = {n: (t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (WHOLE.get(n), 0) for n, t in ((x, a), (y, b))}
    if isinstance(a, T.DecimalType) or isinstance(b, T.DecimalType):
        (whole, scale), (other, more) = sized[x], sized[y]
        if None not in (whole, other) and max(whole, other) + max(scale, more) <= 38:
            return T.DecimalType(max(whole, other) + max(scale, more), max(scale, more))
        return T.StringType()
    real = {"float", "double", "tinyint", "smallint", "int"}
    if {x, y} <= real and {x, y} & {"float", "double"}:
        small = {"float", "tinyint", "smallint"}
        return T.FloatType() if {x, y} <= small else T.DoubleType()
    if {x, y} == {"date", "timestamp_ntz"}:
        return T.TimestampNTZType()
    return T.StringType()


def _folded(spark: SparkSession) -> Callable[[str], str]:
    return (lambda n: n) if spark.conf.get("spark.sql.caseSensitive") == "true" else str.lower


def _replace_columns(spark: SparkSession, table: str, columns: list[Column], stored_by: list[str]) -> None:
    """Make the table anew with these columns. Its rows are in ``<table>__made`` from before the old one goes until the new one is whole."""
    made = f"{table}__made"
    if spark.catalog.tableExists(quote_name(made)):
        raise TypeConflict(f"{made} is left from a run that did not end and may hold the only rows of {table}")
    provider = spark.sql(f"DESCRIBE TABLE EXTENDED {quote_name(table)}").where("col_name = 'Provider'").first()
    shown = spark.sql(f"SHOW TBLPROPERTIES {quote_name(table)}").where("key NOT LIKE 'transient%' AND key NOT LIKE 'spark.sql%'").collect()
    spark.table(quote_name(table)).select(*columns).write.format("parquet").saveAsTable(quote_name(made))
    spark.sql(f"DROP TABLE {quote_name(table)}")
    writer = spark.table(quote_name(made)).write.format(provider["data_type"] if provider else "parquet")
    (writer.partitionBy(*stored_by) if stored_by else writer).saveAsTable(quote_name(table))
    for r in shown:
        _set_property(spark, table, r["key"], r["value"])
    spark.sql(f"DROP TABLE {quote_name(made)}")


def _reconciled(rows: DataFrame, table: str, conflict: str) -> None:
    """Change the table where its columns cannot take the types of ``rows``, by the strategy ``conflict``."""
    if conflict not in ("error", "widen", "keep_aside"):
        raise ValueError(f"conflict must be 'error', 'widen' or 'keep_aside', not {conflict!r}")
    spark = rows.sparkSession
    fold = _folded(spark)
    old = spark.table(quote_name(table))
    stored_by = [c.name for c in spark.catalog.listColumns(quote_name(table)) if c.isPartition]
    given = {fold(f.name): f.dataType for f in rows.schema.fields}
    taken = {fold(c) for c in [*old.columns, *rows.columns]}
    columns, changed = [], False
    for f in old.schema.fields:
        own = F.col(quote_part(f.name))
        new = given.get(fold(f.name), f.dataType)
        if wider(f.dataType, new).simpleString() == f.dataType.simpleString() and not (
            conflict == "error" and new.simpleString() != f.dataType.simpleString()
        ):
            columns.append(own)
            continue
        if conflict == "error" or f.name in stored_by or _whole(new, T.MapType) or _whole(f.dataType, T.MapType):
            raise TypeConflict(f"{table}.{f.name} is {f.dataType.simpleString()}, not {new.simpleString()}")
        changed = True
        if conflict == "widen":
            columns.append(own.cast(wider(f.dataType, new)).alias(f.name))
            continue
        aside, turn = f"{f.name}__{re.sub('[^a-z0-9]+', '_', f.dataType.simpleString()).strip('_')}", 1
        while fold(aside) in taken:
            turn += 1
            aside = f"{aside.rsplit('__v', 1)[0]}__v{turn}"
        taken.add(fold(aside))
        columns += [own.alias(aside), F.lit(None).cast(new).alias(f.name)]
    if changed:
        _replace_columns(spark, table, columns, stored_by)


def _with_merged_columns(rows: DataFrame, table: str, conflict: str = "error") -> DataFrame:
    """Add to the table the columns it lacks, and to the rows, as nulls, those they lack."""
    spark = rows.sparkSession
    folded = _folded(spark)
    _reconciled(rows, table, conflict)
    have = {folded(f.name): f for f in spark.table(quote_name(table)).schema.fields}
    added = [f for f in rows.schema.fields if folded(f.name) not in have]
    if added:
        columns = ", ".join(f"{quote_part(f.name)} {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {quote_name(table)} ADD COLUMNS ({columns})")
    given = {folded(c) for c in rows.columns}
    absent = [F.lit(None).cast(f.dataType).alias(f.name) for n, f in have.items() if n not in given]
    return rows.select("*", *absent)


def copy_merging_schema(
    df: DataFrame,
    table: str,
    spec: str = "",
    *,
    provider: str = "parquet",
    distribute: str = "rebalance",
    conflict: str = "error",
) -> None:
    """Overwrite the touched partitions; columns the target lacks are added, those the data
    lacks become null. For a column of another type, ``conflict`` decides:

    * ``error``: a :class:`TypeConflict`, and nothing is changed.
    * ``widen``: a type that holds the data's values stays; else the column becomes the narrowest type that holds both.
    * ``keep_aside``: as before, but a column that does not hold the data is kept under a new name, its own and its type's,
      and the data gets a new column, null in the rows that are there.

    A changed column means that the table is written anew before the copy. Partition columns are never changed.
    """
    fields = _fields(spec)
    if not df.sparkSession.catalog.tableExists(quote_name(table)):
        overwrite_partitions(df, table, fields, provider=provider, distribute=distribute)
        return
    rows = _with_merged_columns(with_partition_columns(df, fields), table, conflict)
    identity = [PartitionField(f.column) for f in fields]
    overwrite_partitions(rows, table, identity, provider=provider, distribute=distribute)
