"""Table properties of all tables at once, as ``table_fqn, key, value`` rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.errors import SPARK_ERRORS, message
from tablesync.sources.workspace import use_checkpoints

# Keys that are made from table metadata and cannot be set; the last two are
# the ones Spark itself refuses.
RESERVED_KEYS = (
    "current-snapshot-id",
    "format",
    "format-version",
    "snapshot-count",
    "last-updated-ms",
    "current-schema-id",
    "default-partition-spec",
    "default-sort-order-id",
    "provider",
    "location",
)


def compare_readings(by_sql: DataFrame, by_metadata: DataFrame) -> DataFrame:
    """Two readings of the same tables side by side, sorted by table and key."""
    left = by_sql.select("table_fqn", "key", F.struct("value").alias("a"))
    right = by_metadata.select("table_fqn", "key", F.struct("value").alias("b"))
    only_in = F.when(F.col("b").isNull(), "sql").when(F.col("a").isNull(), "metadata").otherwise("both")
    return (
        left.join(right, ["table_fqn", "key"], "full_outer")
        .select(
            "table_fqn",
            "key",
            F.coalesce("a.value", F.lit("")).alias("sql_value"),
            F.coalesce("b.value", F.lit("")).alias("metadata_value"),
            only_in.alias("only_in"),
        )
        .orderBy("table_fqn", "key")
    )


def diff(pairs: DataFrame, source: DataFrame, target: DataFrame) -> DataFrame:
    """Every key of every pair with its status on the two sides."""
    left = pairs.join(source, pairs["source_fqn"] == source["table_fqn"]).select(
        "source_fqn", "target_fqn", "key", F.struct("value").alias("s")
    )
    right = pairs.join(target, pairs["target_fqn"] == target["table_fqn"]).select(
        "source_fqn", "target_fqn", "key", F.struct("value").alias("t")
    )
    status = (
        F.when(F.col("t").isNull(), "missing_on_target")
        .when(F.col("s").isNull(), "extra_on_target")
        .when(F.col("s.value").eqNullSafe(F.col("t.value")), "equal")
        .otherwise("value_changed")
    )
    return left.join(right, ["source_fqn", "target_fqn", "key"], "full_outer").select(
        "source_fqn",
        "target_fqn",
        "key",
        F.coalesce("s.value", F.lit("")).alias("source_value"),
        F.coalesce("t.value", F.lit("")).alias("target_value"),
        status.alias("status"),
    )


def _settable(key: Column) -> Column:
    return ~key.isin(*RESERVED_KEYS)


def sync_plan(pairs: DataFrame, source: DataFrame, target: DataFrame) -> DataFrame:
    """What to set: source keys the target lacks or has otherwise, reserved keys left out."""
    wanted = pairs.join(
        source.where(_settable(F.col("key"))), pairs["source_fqn"] == source["table_fqn"]
    ).select("source_fqn", "target_fqn", "key", "value")
    present = target.select(F.col("table_fqn").alias("target_fqn"), "key", F.col("value").alias("now"))
    return (
        wanted.join(present, ["target_fqn", "key"], "left")
        .where(~F.col("value").eqNullSafe(F.col("now")))
        .select("source_fqn", "target_fqn", "key", "value")
    )


def key_plan(pairs: DataFrame, source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """The action for one key on every pair."""
    s = source.where(F.col("key") == key).select(
        F.col("table_fqn").alias("source_fqn"), F.col("value").alias("source_value")
    )
    t = target.where(F.col("key") == key).select(
        F.col("table_fqn").alias("target_fqn"), F.col("value").alias("target_value")
    )
    action = (
        F.when(F.lit(key in RESERVED_KEYS), "skip (reserved)")
        .when(F.col("source_value").isNull(), "skip (source missing)")
        .when(F.col("source_value").eqNullSafe(F.col("target_value")), "noop")
        .otherwise("set")
    )
    return (
        pairs.join(s, "source_fqn", "left")
        .join(t, "target_fqn", "left")
        .select("source_fqn", "target_fqn", "source_value", "target_value", action.alias("action"))
    )


def plan_of(key_rows: DataFrame, key: str) -> DataFrame:
    """The rows of :func:`key_plan` to set, as a plan that can be applied."""
    return key_rows.where(F.col("action") == "set").select(
        "source_fqn", "target_fqn", F.lit(key).alias("key"), F.col("source_value").alias("value")
    )


def statements(plan: DataFrame) -> DataFrame:
    """One ``ALTER TABLE`` per target. A group is the property map of one table, which every
    catalog client holds in memory as a whole."""
    name = F.concat_ws(
        ".",
        F.transform(
            F.split("target_fqn", r"\."),
            lambda p: F.concat(F.lit("`"), F.replace(p, F.lit("`"), F.lit("``")), F.lit("`")),
        ),
    )

    def text(column: Column) -> Column:
        escaped = F.replace(F.replace(column, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
        return F.concat(F.lit("'"), escaped, F.lit("'"))

    pair = F.concat(text(F.col("key")), F.lit(" = "), text(F.col("value")))
    return (
        plan.withColumn("pair", pair)
        .groupBy("target_fqn")
        .agg(F.array_join(F.sort_array(F.collect_list("pair")), ", ").alias("pairs"))
        .select(
            "target_fqn",
            F.concat(
                F.lit("ALTER TABLE "), name, F.lit(" SET TBLPROPERTIES ("), "pairs", F.lit(")")
            ).alias("statement"),
        )
    )


def report(pairs: DataFrame, plan: DataFrame) -> DataFrame:
    """Per pair the number and names of the keys the plan would set."""
    planned = plan.groupBy("source_fqn", "target_fqn").agg(
        F.count(F.lit(1)).alias("key_count"),
        F.array_join(F.sort_array(F.collect_list("key")), ",").alias("keys"),
    )
    return pairs.join(planned, ["source_fqn", "target_fqn"], "left").select(
        "source_fqn",
        "target_fqn",
        F.coalesce("key_count", F.lit(0)).cast("long").alias("key_count"),
        F.coalesce("keys", F.lit("")).alias("keys"),
    )


def verify(pairs: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """The value of one key on every target, null where it is not set."""
    found = target.where(F.col("key") == key).select(
        F.col("table_fqn").alias("target_fqn"), F.col("value")
    )
    return pairs.select("target_fqn").join(found, "target_fqn", "left")


def counts(rows: DataFrame, column: str) -> DataFrame:
    """Rows per status or action."""
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def apply_plan(spark: SparkSession, plan: DataFrame) -> DataFrame:
    """Run one statement per target; ``target_fqn, applied, error``. An empty plan runs none."""
    rows = []
    for r in statements(plan).toLocalIterator():
        try:
            spark.sql(r["statement"])
            rows.append((r["target_fqn"], True, ""))
        except SPARK_ERRORS as problem:
            rows.append((r["target_fqn"], False, message(problem)))
    return spark.createDataFrame(rows, "target_fqn string, applied boolean, error string")


def sync(
    spark: SparkSession, pairs: DataFrame, source: DataFrame, target: DataFrame, *, dry_run: bool = True
) -> DataFrame:
    """Plan all pairs and, unless ``dry_run``, apply; the report says what happened to each."""
    plan = sync_plan(pairs, source, target)
    rows = report(pairs, plan)
    if dry_run:
        outcome = spark.createDataFrame([], "target_fqn string, applied boolean, error string")
    else:
        use_checkpoints(spark)
        plan = plan.checkpoint()  # as planned, before the change
        rows = report(pairs, plan)
        outcome = apply_plan(spark, plan)
    return rows.join(outcome, "target_fqn", "left").select(
        "source_fqn",
        "target_fqn",
        "key_count",
        "keys",
        F.coalesce("applied", F.lit(False)).alias("applied"),
        F.coalesce("error", F.lit("")).alias("error"),
        F.current_timestamp().alias("at"),
    )

