"""Count and partition-spec validation of copied tables."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.errors import SPARK_ERRORS, message
from tablesync.functions.partitions import parse_spec
from tablesync.functions.pruning import pruned
from tablesync.functions.quoting import quote_name
from tablesync.operators.manifest import with_keys
from tablesync.sources.catalog import partition_spec

# Pairs that are counted side by side, each in a job of its own.
PAIRS_AT_ONCE = 16


@dataclass(frozen=True)
class TablePair:
    """Two relations to validate against each other, by name or as DataFrames."""

    key: str
    source: str | DataFrame
    target: str | DataFrame
    where: str = ""


NUMBERS = ("source_count", "target_count", "target_count_total")


def _branches(spark: SparkSession, pair: TablePair, specs: tuple[str, str] | None = None) -> list[tuple[DataFrame, tuple[str, ...]]]:
    """What is to be counted for a pair, and for which numbers.

    The filtered counts prune row groups, and partitions too where a table's spec says how they were derived; the total comes
    from the footers. ``specs`` are those of both sides, where they are known.
    """

    def relation(table: str | DataFrame) -> DataFrame:
        return spark.table(quote_name(table)) if isinstance(table, str) else table

    def filtered(table: str | DataFrame, spec: str | None) -> DataFrame:
        if not isinstance(table, str):
            return table.where(pair.where)
        spec = partition_spec(spark, table) if spec is None else spec
        return pruned(relation(table), parse_spec(spec), pair.where)

    target = relation(pair.target)
    old, new = specs or (None, None)
    if not pair.where.strip():
        return [(relation(pair.source), NUMBERS[:1]), (target, NUMBERS[1:])]
    return [(filtered(pair.source, old), NUMBERS[:1]), (filtered(pair.target, new), NUMBERS[1:2]), (target, NUMBERS[2:])]


def _counts(spark: SparkSession, pair: TablePair) -> DataFrame:
    """Rows ``pair_key`` and the numbers, to be summed: each relation is counted for itself."""
    zero = F.lit(0).cast("long")
    return _united(
        [
            df.agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(pair.key).alias("pair_key"), *[(F.col("n") if c in names else zero).alias(c) for c in NUMBERS]
            )
            for df, names in _branches(spark, pair)
        ]
    )


def _counted_alone(spark: SparkSession, pair: TablePair, specs: tuple[str, str]) -> tuple:
    """The numbers of one pair by one aggregate over all its relations, which takes one shuffle.

    Nothing in its plan names the pair, so that the code Spark makes for one pair serves the next.
    """
    flags = [df.select(*[F.lit(c in names).alias(c) for c in NUMBERS]) for df, names in _branches(spark, pair, specs)]
    return tuple(_united(flags).agg(*[F.count_if(c).alias(c) for c in NUMBERS]).first())


def _united(frames: list[DataFrame]) -> DataFrame:
    """The union of any number of frames as a balanced tree."""
    if len(frames) == 1:
        return frames[0]
    middle = len(frames) // 2
    return _united(frames[:middle]).unionByName(_united(frames[middle:]))


def count_parity(spark: SparkSession, pairs: Sequence[TablePair]) -> DataFrame:
    """Counts of all pairs under each pair's filter, in one plan and one action."""
    rows = _united([_counts(spark, p) for p in pairs])
    sums = [
        F.sum(c).alias(c) for c in ("source_count", "target_count", "target_count_total")
    ]
    return rows.groupBy("pair_key").agg(*sums).withColumns(
        {
            "beyond_filter": F.col("target_count_total") - F.col("target_count"),
            "count_match": F.col("source_count") == F.col("target_count"),
        }
    )


def compare_specs(source: DataFrame, target: DataFrame, key: str = "pair_key") -> DataFrame:
    """Partition specs of both sides (``key, partition_columns``); the order of fields matters."""
    return source.select(key, F.col("partition_columns").alias("partition_source")).join(
        target.select(key, F.col("partition_columns").alias("partition_target")), key, "full_outer"
    ).withColumn(
        "partition_match", F.col("partition_source").eqNullSafe(F.col("partition_target"))
    )


def verdict(counts: DataFrame, specs: DataFrame, key: str = "pair_key") -> DataFrame:
    """``ok`` when the filtered counts and the specs agree; the unfiltered total is only shown.

    A pair that has no counts or no specs is an ``error``.
    """
    agree = F.col("count_match") & F.col("partition_match")
    return counts.join(specs, key, "full_outer").withColumn(
        "validation_status",
        F.when(agree.isNull() | F.col("count_match").isNull() | F.col("partition_match").isNull(), "error")
        .when(agree, "ok")
        .otherwise("mismatch"),
    )


def filter_lookup(state: DataFrame, manifest: DataFrame, fallback: str) -> DataFrame:
    """The filter of each state row by job key. A manifest row without filter means unfiltered;
    the fallback is for keys the manifest does not have. A key of several rows stops the query."""
    twice = F.raise_error(F.concat(F.lit("several manifest rows have the job key "), F.col("job_key")))
    filters = (
        with_keys(manifest)
        .groupBy("job_key")
        .agg(F.max("filterExpression").alias("text"), F.count(F.lit(1)).alias("rows"))
        .select("job_key", F.struct(F.when(F.col("rows") > 1, twice).otherwise(F.col("text")).alias("text")).alias("found"))
    )
    columns = state.columns
    return state.withColumn("job_key", F.trim("k8s_name")).join(filters, "job_key", "left").select(
        *columns,
        F.when(F.col("found").isNull(), F.lit(fallback))
        .otherwise(F.coalesce("found.text", F.lit("")))
        .alias("where_sql"),
    )


RESULT = (
    "pair_key string, source_count bigint, target_count bigint, target_count_total bigint, "
    "count_match boolean, partition_source string, partition_target string, "
    "partition_match boolean, validation_status string, validation_error string"
)


COUNTED = "pair_key string, source_count bigint, target_count bigint, target_count_total bigint, count_match boolean"
SPECS = "pair_key string, partition_columns string"
FAILED = "pair_key string, validation_error string"


def validate_pairs(spark: SparkSession, pairs: Sequence[TablePair], at_once: int = PAIRS_AT_ONCE) -> DataFrame:
    """Counts, specs and verdict of named tables. A pair that fails is an ``error`` row.

    ``at_once`` pairs are counted side by side, each in one action, so that small tables do not wait for
    large ones, all cores have work, and one unreadable table costs the others nothing.
    """
    sources, targets, errors, counted = [], [], [], []
    known: dict[str, str] = {}  # several pairs may be windows of one table

    def spec_of(table: str) -> str:
        if table not in known:
            known[table] = partition_spec(spark, table)
        return known[table]

    def judge(pair: TablePair) -> tuple:
        old = new = None
        try:
            old, new = spec_of(pair.source), spec_of(pair.target)
            return old, new, _counted_alone(spark, pair, (old, new)), None
        except SPARK_ERRORS as problem:
            return old, new, None, message(problem)

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        for pair, (old, new, found, error) in zip(pairs, pool.map(judge, pairs)):
            if new is not None:
                sources.append((pair.key, old))
                targets.append((pair.key, new))
            if error is not None:
                errors.append((pair.key, error))
            if found is not None:
                counted.append((pair.key, *found, found[0] == found[1]))
    counts = spark.createDataFrame(counted, COUNTED)
    specs = compare_specs(spark.createDataFrame(sources, SPECS), spark.createDataFrame(targets, SPECS))
    broken = spark.createDataFrame(errors, FAILED)
    judged = verdict(counts, specs).join(broken, "pair_key", "full_outer")
    return judged.select(
        *[c.split()[0] for c in RESULT.split(", ")[:-2]],
        F.coalesce("validation_status", F.lit("error")).alias("validation_status"),
        "validation_error",
    )
