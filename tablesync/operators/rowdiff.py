"""Row-level diff of two relations on a key.

Rows with a unique key meet in one full outer join. Spark cannot split a hot key in such a
join, and duplicates would meet pairwise, so the keys that repeat are found first, from the key
columns alone, and their rows are compared as bags instead: one ``groupBy`` over key and
values counts the copies on either side and what is equal cancels. That grouping hashes the
whole row, so a hot key spreads over all tasks and its size never squares.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.compare import any_of, comparable, differs
from tablesync.functions.quoting import quote_part
from tablesync.sources.workspace import use_checkpoints

SALT_BITS = 8
SETS_AT_ONCE = 24
# Keys of so many rows on both sides together make their pairs.
PAIRED_ROWS = 64
KINDS = ("changed", "only_source", "only_target")


class KeyMissing(ValueError):
    """A key column is not on both sides."""


@dataclass(frozen=True)
class Sides:
    """Both sides projected to positional names: keys ``k0..``, compare columns ``c0..``."""

    source: DataFrame
    target: DataFrame
    keys: tuple[str, ...]
    columns: tuple[str, ...]
    null_keys: str
    lost: tuple[str, ...] = ()

    @property
    def k(self) -> list[str]:
        return [f"k{i}" for i in range(len(self.keys))]

    @property
    def c(self) -> list[str]:
        return [f"c{i}" for i in range(len(self.columns))]

    @property
    def o(self) -> list[str]:
        return [f"o{i}" for i in range(len(self.columns))]

    @property
    def n(self) -> list[str]:
        return [f"n{i}" for i in range(len(self.columns))]


def _common_type(source: DataFrame, target: DataFrame, name: str) -> str | None:
    """The type to cast both sides to, so that the result has one schema whatever the rows.

    None where the types agree. Numbers are widened as a union would; all else becomes text.
    """
    left, right = source.schema[name].dataType, target.schema[name].dataType
    if left.simpleString() == right.simpleString():
        return None
    if isinstance(left, T.NumericType) and isinstance(right, T.NumericType):
        column = quote_part(name)
        return source.select(column).union(target.select(column)).schema[0].dataType.simpleString()
    return "string"


def project_sides(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str] | str,
    *,
    columns: Sequence[str] | None = None,
    cast_to_string: Sequence[str] = (),
    where: str | Column | None = None,
    null_keys: str = "separate",
) -> Sides:
    """Filter both sides alike and keep the keys and the columns to compare.

    The compare columns are those both sides have, in source order. ``null_keys`` is
    ``"separate"`` (a null key meets nothing, as in an equi-join) or ``"match"``.
    """
    keys = (keys,) if isinstance(keys, str) else tuple(keys)
    if null_keys not in ("separate", "match"):
        raise ValueError(f"null_keys must be 'separate' or 'match', not {null_keys!r}")
    for key in keys:
        for side, df in (("source", source), ("target", target)):
            if key not in df.columns:
                raise KeyMissing(f"key column {key!r} is not in the {side}")
    shared = [c for c in source.columns if c in target.columns and c not in keys]
    if columns is not None:
        unknown = [c for c in columns if c not in shared]
        if unknown:
            raise ValueError(f"compare columns not on both sides: {unknown}")
        shared = [c for c in shared if c in set(columns)]

    casts = {}
    for name in (*keys, *shared):
        common = "string" if name in cast_to_string else _common_type(source, target, name)
        if common is not None:
            casts[name] = common
    lost = () if columns is not None else tuple(c for c in source.columns if c not in target.columns)

    def projected(df: DataFrame) -> DataFrame:
        if where is not None and not (isinstance(where, str) and not where.strip()):
            df = df.where(where)

        def value(name: str) -> Column:
            column = df[quote_part(name)]
            dtype = df.schema[name].dataType
            return column.cast(casts[name]) if name in casts else comparable(column, dtype)

        return df.select(
            *[value(n).alias(f"k{i}") for i, n in enumerate(keys)],
            *[value(n).alias(f"c{i}") for i, n in enumerate(shared)],
        )

    return Sides(projected(source), projected(target), keys, tuple(shared), null_keys, lost)


class RowDiff:
    """The diff of two relations on a key.

    A key with one differing row on each side is ``changed``. Every other differing row is
    reported by itself as ``only_source`` or ``only_target`` with its number of copies, so a
    duplicated key never gives pairs.

    ``strict=False`` leaves out one-sided rows whose compare columns are all null.
    ``unique_keys=True`` is the caller's word that no key repeats or is null on either side (a
    primary key, or :func:`key_quality` found none) and saves the pass that looks for such keys.
    The other options are those of :func:`project_sides`.
    """

    def __init__(
        self,
        source: DataFrame,
        target: DataFrame,
        keys,
        *,
        strict: bool = True,
        unique_keys: bool = False,
        **options,
    ):
        self.sides = project_sides(source, target, keys, **options)
        self.strict = strict
        self.unique_keys = unique_keys

    # ---- both sides next to each other: k.., o.., n.., old_present, new_present, copies

    def _any_null_key(self) -> Column:
        return any_of([F.col(k).isNull() for k in self.sides.k])

    def _keys(self) -> DataFrame:
        """Every key with the rows it has on either side. Reads the key columns only."""
        sides = self.sides

        def keys_of(df: DataFrame, old: int, new: int) -> DataFrame:
            return df.select(*sides.k, F.lit(old).alias("old"), F.lit(new).alias("new"))

        keys = keys_of(sides.source, 1, 0).unionByName(keys_of(sides.target, 0, 1))
        is_null = F.lit(False) if sides.null_keys == "match" else self._any_null_key()
        counted = keys.groupBy(*sides.k).agg(F.sum("old").alias("old"), F.sum("new").alias("new"))
        return counted.select(
            *sides.k,
            is_null.alias("is_null"),
            ((F.col("old") > 1) | (F.col("new") > 1)).alias("twice"),
            (F.col("old") + F.col("new")).alias("rows"),
        )

    @cached_property
    def _key_facts(self) -> Row:
        """How many rows have a null, a repeated and any key."""
        if self.unique_keys:
            return Row(null_rows=0, repeated_rows=0, rows=1)

        def rows_where(condition: Column) -> Column:
            return F.coalesce(F.sum(F.when(condition, F.col("rows"))), F.lit(0))

        return self._keys().agg(
            rows_where(F.col("is_null")).alias("null_rows"),
            rows_where(F.col("twice") & ~F.col("is_null")).alias("repeated_rows"),
            rows_where(F.lit(True)).alias("rows"),
        ).first()

    @property
    def _has_null_keys(self) -> bool:
        return self._key_facts["null_rows"] > 0

    @property
    def _has_repeated_keys(self) -> bool:
        return self._key_facts["repeated_rows"] > 0

    @property
    def _often_repeated(self) -> bool:
        """Then picking the other rows out costs more than comparing them as bags too."""
        return 4 * self._key_facts["repeated_rows"] > self._key_facts["rows"]

    @cached_property
    def _repeated_keys(self) -> DataFrame:
        use_checkpoints(self.sides.source.sparkSession)
        return self._keys().where("twice AND NOT is_null").select(*self.sides.k).checkpoint()

    def _same_key(self, left: DataFrame, right: DataFrame) -> list[Column]:
        if self.sides.null_keys == "match":
            return [left[k].eqNullSafe(right[k]) for k in self.sides.k]
        return [left[k] == right[k] for k in self.sides.k]

    def _restricted(self, df: DataFrame, how: str) -> DataFrame:
        """Rows with (``left_semi``) or without (``left_anti``) a repeated key, null keys left out."""
        if self._has_null_keys:
            df = df.where(~self._any_null_key())
        if not self._has_repeated_keys or self._often_repeated:
            return df
        return df.join(self._repeated_keys, self._same_key(df, self._repeated_keys), how)

    def _joined(self) -> DataFrame:
        """The full outer join of the rows with a unique key."""
        sides = self.sides

        def prepared(df: DataFrame, prefix: str) -> DataFrame:
            return self._restricted(df, "left_anti").select(
                *sides.k,
                F.lit(True).alias(f"{prefix}_present"),
                *[F.col(c).alias(prefix[0] + c[1:]) for c in sides.c],
            )

        old, new = prepared(sides.source, "old"), prepared(sides.target, "new")
        return old.join(new, self._same_key(old, new), "full_outer").select(
            *[F.coalesce(old[k], new[k]).alias(k) for k in sides.k],
            F.col("old_present").isNotNull().alias("old_present"),
            F.col("new_present").isNotNull().alias("new_present"),
            F.lit(1).cast("long").alias("copies"),
            *sides.o,
            *sides.n,
        )

    def _lone(self) -> DataFrame:
        """Rows with a null key, which meet nothing; equal ones are counted, so that however many
        there are they never come together in one task."""
        sides = self.sides

        def one_sided(df: DataFrame, is_old: bool) -> DataFrame:
            rows = df.where(self._any_null_key()).groupBy(*sides.k, *sides.c)
            present, absent = (sides.o, sides.n) if is_old else (sides.n, sides.o)
            types = {f.name: f.dataType for f in df.schema.fields}
            return rows.agg(F.count(F.lit(1)).alias("copies")).select(
                *sides.k,
                F.lit(is_old).alias("old_present"),
                F.lit(not is_old).alias("new_present"),
                "copies",
                *[F.col(c).alias(p) for c, p in zip(sides.c, present)],
                *[F.lit(None).cast(types[c]).alias(x) for c, x in zip(sides.c, absent)],
            )

        return one_sided(sides.source, True).unionByName(one_sided(sides.target, False))

    @cached_property
    def _bags(self) -> DataFrame:
        """Rows with a repeated key: one per distinct key and value, with its copies per side.

        Checkpointed, because the equal rows and the rows left over are both read from it.
        """
        sides = self.sides

        def tagged(df: DataFrame, old: int, new: int) -> DataFrame:
            return self._restricted(df, "left_semi").select(
                *sides.k,
                *sides.c,
                F.lit(old).cast("long").alias("old_rows"),
                F.lit(new).cast("long").alias("new_rows"),
            )

        rows = tagged(sides.source, 1, 0).unionByName(tagged(sides.target, 0, 1))
        value = F.struct(*sides.c) if sides.c else F.struct(F.lit(True).alias("c"))
        salt = F.shiftrightunsigned(F.xxhash64(*sides.c), 64 - SALT_BITS) if sides.c else F.lit(0)
        bags = (
            rows.groupBy(*sides.k, *sides.c)
            .agg(F.sum("old_rows").alias("old_rows"), F.sum("new_rows").alias("new_rows"))
            .select(
                F.struct(*sides.k).alias("key"),
                value.alias("value"),
                salt.cast("long").alias("salt"),
                F.least("old_rows", "new_rows").alias("equal"),
                F.greatest(F.col("old_rows") - F.col("new_rows"), F.lit(0)).alias("more_old"),
                F.greatest(F.col("new_rows") - F.col("old_rows"), F.lit(0)).alias("more_new"),
            )
        )
        use_checkpoints(bags.sparkSession)
        return bags.checkpoint()

    def _cancelled(self) -> DataFrame:
        """The rows with a repeated key, in the columns ``_joined`` has."""
        sides, value = self.sides, F.col("value")
        equal = self._bags.where(F.col("equal") > 0).select(
            "key", value.alias("old"), value.alias("new"), F.col("equal").alias("copies")
        )
        left_over = self._bags.where((F.col("more_old") > 0) | (F.col("more_new") > 0))
        old = F.when(F.col("more_old") > 0, value)
        new = F.when(F.col("more_new") > 0, value)
        per_salt = left_over.groupBy("key", "salt").agg(
            F.sum("more_old").alias("more_old"),
            F.sum("more_new").alias("more_new"),
            F.first(old, ignorenulls=True).alias("old"),
            F.first(new, ignorenulls=True).alias("new"),
        )
        # At most 2 ** SALT_BITS rows per key reach this window, however hot the key.
        per_key = Window.partitionBy("key")
        totals = per_salt.withColumns(
            {"key_old": F.sum("more_old").over(per_key), "key_new": F.sum("more_new").over(per_key)}
        )
        is_changed = (F.col("key_old") == 1) & (F.col("key_new") == 1)
        changed = (
            totals.where(is_changed)
            .groupBy("key")
            .agg(
                F.first("old", ignorenulls=True).alias("old"),
                F.first("new", ignorenulls=True).alias("new"),
            )
            .withColumn("copies", F.lit(1).cast("long"))
        )
        alone = totals.where(~is_changed).select("key", "salt")
        one_sided = left_over.join(alone, ["key", "salt"], "left_semi").select(
            "key",
            old.alias("old"),
            new.alias("new"),
            (F.col("more_old") + F.col("more_new")).alias("copies"),
        )
        return equal.unionByName(changed).unionByName(one_sided).select(
            *[F.col(f"key.{k}").alias(k) for k in sides.k],
            F.col("old").isNotNull().alias("old_present"),
            F.col("new").isNotNull().alias("new_present"),
            "copies",
            *[F.col(f"old.{c}").alias(o) for c, o in zip(sides.c, sides.o)],
            *[F.col(f"new.{c}").alias(n) for c, n in zip(sides.c, sides.n)],
        )

    def _aligned(self) -> DataFrame:
        parts = []
        if not self._often_repeated:
            parts.append(self._joined())
        if self._has_repeated_keys:
            parts.append(self._cancelled())
        if self._has_null_keys:
            parts.append(self._lone())
        return reduce(DataFrame.unionByName, parts)

    # ---- what is read from it

    def _flags(self) -> list[Column]:
        return [differs(F.col(o), F.col(n)) for o, n in zip(self.sides.o, self.sides.n)]

    def _is_mismatch(self) -> Column:
        any_flag = any_of(self._flags())
        if not self.strict:
            return any_flag
        return ~F.col("old_present") | ~F.col("new_present") | any_flag

    def _row_status(self) -> Column:
        return (
            F.when(~F.col("new_present"), "only_source")
            .when(~F.col("old_present"), "only_target")
            .otherwise("changed")
        )

    def _key_columns(self) -> list[Column]:
        return [F.col(k).alias(name) for name, k in zip(self.sides.keys, self.sides.k)]

    def _value_columns(self) -> list[Column]:
        out = []
        for name, o, n in zip(self.sides.columns, self.sides.o, self.sides.n):
            out += [F.col(o).alias(f"old__{name}"), F.col(n).alias(f"new__{name}")]
        return out

    def aligned(self) -> DataFrame:
        """Every row of both sides next to its counterpart.

        ``row_copies`` counts the equal rows of a duplicated key; it is 1 for a unique key.
        """
        return self._aligned().select(
            *self._key_columns(),
            F.col("old_present").alias("old__present"),
            F.col("new_present").alias("new__present"),
            F.col("copies").alias("row_copies"),
            *self._value_columns(),
        )

    def rows(self) -> DataFrame:
        """The mismatching rows: key, names of the differing columns, old and new values."""
        names = [F.when(f, F.lit(n)) for n, f in zip(self.sides.columns, self._flags())]
        mismatched = F.concat_ws(", ", F.array(*names)) if names else F.lit("")
        return self._aligned().where(self._is_mismatch()).select(
            *self._key_columns(),
            self._row_status().alias("row_status"),
            F.col("copies").alias("row_copies"),
            mismatched.alias("mismatched_columns"),
            *self._value_columns(),
        )

    def summary(self) -> DataFrame:
        """One row: both counts, the mismatching rows by kind, and ``by_column``, a map of the
        mismatches of each column that has any. All of it is one aggregate of one pass."""
        sides = self.sides

        old, new, copies = F.col("old_present"), F.col("new_present"), F.col("copies")
        flags = self._flags()
        flagged = F.lit(True) if self.strict else any_of(flags)

        def copies_where(condition: Column) -> Column:
            return F.coalesce(F.sum(F.when(condition, copies)), F.lit(0))

        totals = self._aligned().agg(
            copies_where(old).alias("source_count"),
            copies_where(new).alias("target_count"),
            copies_where(old & new & any_of(flags)).alias("changed"),
            copies_where(old & ~new & flagged).alias("only_source"),
            copies_where(new & ~old & flagged).alias("only_target"),
            *[copies_where(flag).alias(c) for c, flag in zip(sides.c, flags)],
        )
        entries = [
            F.struct(F.lit(name).alias("column_name"), F.col(c).alias("mismatches"))
            for name, c in zip(sides.columns, sides.c)
        ]
        found = F.array(*entries).cast("array<struct<column_name:string,mismatches:bigint>>")
        return totals.select(
            "source_count",
            "target_count",
            sum((F.col(kind) for kind in KINDS), F.lit(0)).alias("mismatched_rows"),
            *KINDS,
            F.map_from_entries(F.filter(found, lambda e: e["mismatches"] > 0)).alias("by_column"),
        )

    def pair_counts(self) -> DataFrame:
        """What a plain full outer join would count, where duplicates meet pairwise:
        ``column_name, mismatches``, with ``*`` for rows that differ anywhere.

        Keys of up to PAIRED_ROWS rows meet in that join, a quarter of PAIRED_ROWS pairs for each row
        at most; of keys with more rows the pairs are counted without making them, and null keys meet nothing.
        """
        sides, hot = self.sides, None
        if not self.unique_keys:
            use_checkpoints(sides.source.sparkSession)
            often = self._keys().where((F.col("rows") > PAIRED_ROWS) & ~F.col("is_null"))
            hot = often.select(*sides.k).checkpoint()
            hot = None if hot.isEmpty() else hot
        lone = F.lit(False) if sides.null_keys == "match" else self._any_null_key()

        def few(df: DataFrame) -> DataFrame:
            rows = df.where(~lone)
            return rows if hot is None else rows.join(hot, self._same_key(rows, hot), "left_anti")

        old = few(sides.source).select(*sides.k, *[F.col(c).alias(o) for c, o in zip(sides.c, sides.o)])
        new = few(sides.target).select(*sides.k, *[F.col(c).alias(n) for c, n in zip(sides.c, sides.n)])
        parts = [self._tallied(old.join(new, self._same_key(old, new), "full_outer"), self._flags())]
        if sides.null_keys == "separate":
            filled = [F.col(c).isNotNull() for c in sides.c]
            parts += [self._tallied(df.where(lone), filled) for df in (sides.source, sides.target)]
        if hot is not None:
            many = [df.join(hot, self._same_key(df, hot), "left_semi") for df in (sides.source, sides.target)]
            parts.append(self._counted_pairs(*many))
        # A column without a mismatch has its row too, unless there are no rows at all.
        found = reduce(DataFrame.unionByName, parts).groupBy("column_name")
        return found.agg(F.sum("mismatches").cast("decimal(38,0)").alias("mismatches"))

    def _tallied(self, rows: DataFrame, flags: list[Column]) -> DataFrame:
        """``column_name, mismatches`` from a flag for each column; nothing where there are no rows."""
        named = [("*", any_of(flags)), *zip(self.sides.columns, flags)]
        sums = [F.count_if(flag).alias(f"m{i}") for i, (_, flag) in enumerate(named)]
        entries = [
            F.struct(F.lit(name).alias("column_name"), F.col(f"m{i}").cast("decimal(38,0)").alias("mismatches"))
            for i, (name, _) in enumerate(named)
        ]
        totals = rows.agg(F.count(F.lit(1)).alias("rows"), *sums).where("rows > 0")
        return totals.select(F.inline(F.array(*entries)))

    def _counted_pairs(self, source: DataFrame, target: DataFrame) -> DataFrame:
        """The pairs of keys with many rows, counted without making them.

        A key with n old and m new rows makes n * m pairs, and those equal in a column are the
        sum over its values of old rows times new rows. So the rows are counted per key and
        value, once for each column and once for all together.
        """
        sides = self.sides
        group, exact = sides.k, "decimal(38,0)"

        def tagged(df: DataFrame, old: int, new: int) -> DataFrame:
            return df.select(*sides.k, *sides.c, F.lit(old).alias("o"), F.lit(new).alias("n"))

        sums = [F.sum("o").alias("o"), F.sum("n").alias("n")]
        rows = tagged(source, 1, 0).unionByName(tagged(target, 0, 1))
        bags = rows.groupBy(*group, *sides.c).agg(*sums)

        def tally(per_value: DataFrame, columns: list[str]) -> DataFrame:
            filled = any_of([F.col(c).isNotNull() for c in columns])
            old, new = F.col("o").cast(exact), F.col("n").cast(exact)
            per_key = per_value.groupBy("column_name", *group).agg(
                *sums,
                F.sum((old * new).cast(exact)).cast(exact).alias("equal"),
                F.coalesce(F.sum(F.when(filled, F.col("o") + F.col("n"))), F.lit(0)).alias("filled"),
            )
            pairs = (old * new).cast(exact) - F.col("equal")
            unequal = F.when((old > 0) & (new > 0), pairs).otherwise(F.col("filled")).cast(exact)
            return per_key.groupBy("column_name").agg(F.sum(unequal).cast(exact).alias("mismatches"))

        found = [tally(bags.withColumn("column_name", F.lit("*")), sides.c)]
        for start in range(0, len(sides.c), SETS_AT_ONCE):
            some = sides.c[start : start + SETS_AT_ONCE]
            # grouping_id has a bit per column, set where the column is left out.
            full = 2 ** len(some) - 1
            names = [
                x
                for i, name in enumerate(sides.columns[start : start + SETS_AT_ONCE])
                for x in (F.lit(full ^ 2 ** (len(some) - 1 - i)).cast("long"), F.lit(name))
            ]
            per_value = bags.groupingSets([[*group, c] for c in some], *group, *some).agg(
                *sums, F.create_map(*names)[F.grouping_id()].alias("column_name")
            )
            found.append(tally(per_value, some))
        return reduce(DataFrame.unionByName, found)

    def counts(self) -> DataFrame:
        """Row counts of both sides and whether they agree, without comparing any row."""
        zero, rows = F.lit(0).cast("long"), F.count(F.lit(1))
        source = self.sides.source.agg(rows.alias("source_count")).withColumn("target_count", zero)
        target = self.sides.target.agg(rows.alias("target_count")).withColumn("source_count", zero)
        return (
            source.unionByName(target)
            .agg(F.sum("source_count").alias("source_count"), F.sum("target_count").alias("target_count"))
            .withColumn("count_match", F.col("source_count") == F.col("target_count"))
        )

    def count(self) -> DataFrame:
        return self.summary().select("mismatched_rows")

    def by_column(self) -> DataFrame:
        """Mismatches per column, columns without one left out."""
        return self.summary().select(F.explode("by_column").alias("column_name", "mismatches"))

    def by_status(self) -> DataFrame:
        """Mismatching rows per status, a status without one left out."""
        kinds = F.array(*[F.struct(F.lit(k).alias("row_status"), F.col(k).alias("n")) for k in KINDS])
        return self.summary().select(F.inline(F.filter(kinds, lambda e: e["n"] > 0)))

    def verdict(self) -> DataFrame:
        """``ok`` when the counts agree and no row mismatches, else ``mismatch``.

        A source column that the target does not have is an ``error``, unless the columns to
        compare were named. Columns of the target's own, such as derived partitions, are not.
        """
        agree = (F.col("source_count") == F.col("target_count")) & (F.col("mismatched_rows") == 0)
        status = F.when(F.lit(bool(self.sides.lost)), "error").when(agree, "ok").otherwise("mismatch")
        return self.summary().select(
            "source_count",
            "target_count",
            "mismatched_rows",
            status.alias("validation_status"),
        )


def key_quality(df: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """How many keys occur more than once, the rows they hold, and the rows with a null key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    columns = [F.col(quote_part(k)) for k in keys]
    null_key = columns[0].isNull()
    for column in columns[1:]:
        null_key = null_key | column.isNull()
    per_key = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"), F.first(null_key).alias("is_null"))
    repeated = (F.col("n") > 1) & ~F.col("is_null")
    zero = F.lit(0).cast("long")
    return per_key.agg(
        F.count_if(repeated).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("n"))), zero).alias("rows_affected"),
        F.coalesce(F.sum(F.when(F.col("is_null"), F.col("n"))), zero).alias("null_key_rows"),
    )


def schema_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """Columns of the two relations side by side: equal, type_changed or on one side only."""
    spark = source.sparkSession
    left = {f.name: f.dataType.simpleString() for f in source.schema.fields}
    right = {f.name: f.dataType.simpleString() for f in target.schema.fields}
    rows = []
    for name in [*left, *[n for n in right if n not in left]]:
        old, new = left.get(name), right.get(name)
        if old is None:
            status = "only_target"
        elif new is None:
            status = "only_source"
        else:
            status = "equal" if old == new else "type_changed"
        rows.append((name, old, new, status))
    return spark.createDataFrame(
        rows, "column_name string, source_type string, target_type string, status string"
    )
