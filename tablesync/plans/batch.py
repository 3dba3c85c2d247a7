"""Batches over a manifest or a list of view specs, with a state that lets them resume.

The rows that drive a batch are collected: each becomes one Spark write or one validation. The
state is saved after every row, so a batch that stops anywhere goes on with what is not done.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.errors import SPARK_ERRORS, message
from tablesync.functions.quoting import quote_name
from tablesync.operators import manifest as manifests
from tablesync.operators import state as states
from tablesync.operators import views
from tablesync.operators.copy import carry_properties, chunk_coverage, copy_chunk, copy_table, scan
from tablesync.operators.rowdiff import RowDiff
from tablesync.operators.validate import PAIRS_AT_ONCE, TablePair, filter_lookup, validate_pairs
from tablesync.sources.catalog import view_texts
from tablesync.sources.state import StateTable


# Pairs that are validated between two records of the state.
PAIRS_A_RECORD = 128


def now() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="seconds")


class BadManifest(ValueError):
    """Job keys that are too long or not unique; nothing was copied. ``problems`` has them all."""

    def __init__(self, problems: DataFrame, count: int):
        super().__init__(f"{count} problems with job keys, such as {problems.first().asDict()}")
        self.problems = problems


def _uncovered(source: DataFrame, windows: list[str]) -> str | None:
    """What is wrong with the windows of a table: rows in none or in several of them."""
    hits = {r["hits"]: r["n"] for r in chunk_coverage(source, windows).collect()}
    none, several = hits.get(0, 0), sum(n for h, n in hits.items() if h > 1)
    if none or several:
        return f"{none} source rows are in no window and {several} in more than one"
    return None


def copy_batch(
    spark: SparkSession,
    manifest: DataFrame,
    state: StateTable,
    *,
    source_catalog: str = "spark_catalog",
    target_catalog: str = "spark_catalog",
    continue_on_failure: bool = False,
    rerun_all: bool = False,
    selectors: tuple[str, ...] = (),
    name_limit: int | None = None,
    property_prefix: str = "graph",
    **options,
) -> DataFrame:
    """Copy every pending row in manifest order; returns the state.

    The first failure stops the batch unless ``continue_on_failure``; ``selectors`` copy only the rows they
    name. Columns that a target lacks are added. Several rows with one target are windows of one
    table and are merged instead of overwritten: they must have one source, each a filter, and each
    source row must be in exactly one window. Else none of them is copied.
    """
    problems = manifests.key_problems(manifest, name_limit).orderBy("job_key")
    count = problems.count()
    if count:
        raise BadManifest(problems, count)
    state.save(states.upgrade(state.load(), manifest))
    ordered = manifest.withColumn("position", F.monotonically_increasing_id())
    plan = manifests.plan(manifest)
    chunks = plan.groupBy("target_table").agg(
        F.count(F.lit(1)).alias("windows"), F.collect_list("filter_expression").alias("window_list")
    )
    keyed = manifests.with_keys(ordered).select(F.col("state_key").alias("table_key"), "position")
    work = (
        plan.withColumnRenamed("state_key", "table_key")
        .join(keyed, "table_key")
        .join(chunks, "target_table", "left")
        .join(manifests.target_conflicts(plan), "target_table", "left")
    )
    if selectors:
        named = manifests.select_rows(manifest, *selectors).select(F.col("state_key").alias("table_key"))
        work = work.join(named, "table_key", "left_semi")
    if not rerun_all:
        work = states.pending(work, state.load(), "table_key", "apply_status")
    covered: dict[str, str | None] = {}
    for r in work.orderBy("position").collect():
        known = {
            "table_key": r["table_key"],
            "source_table": r["source_table"],
            "target_table": r["target_table"],
            "k8s_name": r["job_key"],
        }
        state.record(**known, apply_status="applying", apply_at=now(), apply_error=None)
        try:
            if r["plan_error"] or r["conflict"]:
                raise ValueError(r["plan_error"] or r["conflict"])
            source = f"{source_catalog}.{r['source_table']}"
            target = f"{target_catalog}.{r['target_table']}"
            if (r["windows"] or 1) > 1:
                rows = scan(spark, source)
                if target not in covered:
                    covered[target] = _uncovered(rows, r["window_list"])
                if covered[target]:
                    raise ValueError(covered[target])
                copy_chunk(rows, target, r["partition_columns"], r["filter_expression"], merge_schema=True, **options)
                carry_properties(spark, source, target, property_prefix)
            else:
                copy_table(
                    spark,
                    source,
                    target,
                    spec=r["partition_columns"],
                    where=r["filter_expression"],
                    property_prefix=property_prefix,
                    merge_schema=True,
                    **options,
                )
            state.record(**known, apply_status="success", apply_at=now(), apply_error=None)
        except (*SPARK_ERRORS, ValueError) as problem:
            state.record(**known, apply_status="failed", apply_at=now(), apply_error=message(problem))
            if not continue_on_failure:
                break
    return state.compact()


def validate_batch(
    spark: SparkSession,
    manifest: DataFrame,
    state: StateTable,
    *,
    fallback: str = "",
    source_catalog: str = "spark_catalog",
    target_catalog: str = "spark_catalog",
) -> DataFrame:
    """Validate every state row that is not ``ok`` yet, some at a time; each lot is recorded when it
    is done. A row whose source has columns that its target lacks is an ``error``."""
    before = state.load()
    rows = before.where(~states.is_done(F.col("validation_status")))
    pairs = [
        TablePair(
            r["table_key"],
            f"{source_catalog}.{r['source_table']}",
            f"{target_catalog}.{r['target_table']}",
            r["where_sql"],
        )
        for r in filter_lookup(rows, manifest, fallback).collect()
    ]
    for start in range(0, len(pairs), PAIRS_A_RECORD):
        some = pairs[start : start + PAIRS_A_RECORD]
        found = validate_pairs(spark, some).drop("count_match")
        with ThreadPoolExecutor(PAIRS_AT_ONCE) as pool:
            absent = list(pool.map(lambda p: (p.key, _lost(spark, p)), some))
        lost = spark.createDataFrame(absent, "pair_key string, lost string")
        judged = found.join(lost, "pair_key", "left").withColumns(
            {
                "validation_status": F.when(F.col("lost").isNotNull(), "error").otherwise(F.col("validation_status")),
                "validation_error": F.coalesce("validation_error", "lost"),
                "validation_at": F.lit(now()),
            }
        )
        state.record_all(judged.drop("lost").withColumnRenamed("pair_key", "table_key"))
    return state.compact() if pairs else before


def _lost(spark: SparkSession, pair: TablePair) -> str | None:
    """The source's columns that the target does not have, if both can be read."""
    try:
        source, target = (spark.table(quote_name(t)).columns for t in (pair.source, pair.target))
    except SPARK_ERRORS:
        return None
    lost = [c for c in source if c not in target]
    return f"the target lacks columns {lost}" if lost else None


def _specs(
    specs: DataFrame, state: StateTable, status: str, catalogs: dict, options: dict, rerun_all: bool
) -> DataFrame:
    """The resolved specs still to be done. One without a schema is recorded as failed and left out."""
    resolved = views.resolve(specs, **catalogs, **options).withColumn(
        "view_key", F.coalesce(F.concat(F.col("source_view_fqn"), F.lit(" -> "), F.col("target_view_fqn")), "view_full")
    )
    error = "migrate_error" if status == "migrate_status" else "validation_error"
    word = "failed" if status == "migrate_status" else "error"
    bad = resolved.where("spec_error IS NOT NULL").select(
        F.coalesce("view_key", F.lit("<null>")).alias("view_key"), F.lit(word).alias(status), F.col("spec_error").alias(error)
    )
    if not bad.isEmpty():
        state.record_all(bad)
    good = resolved.where("spec_error IS NULL")
    return good if rerun_all else states.pending(good, state.load(), "view_key", status)


def publish_batch(
    spark: SparkSession,
    specs: DataFrame,
    state: StateTable,
    *,
    source_catalog: str = "spark_catalog",
    target_catalog: str = "spark_catalog",
    dry_run: bool = False,
    rerun_all: bool = False,
    **options,
) -> DataFrame:
    """Re-create every view not published yet; with ``dry_run`` return the DDL and publish nothing."""
    catalogs = {"source_catalog": source_catalog, "target_catalog": target_catalog}
    todo = _specs(specs, state, "migrate_status", catalogs, options, rerun_all)
    schemas = [r[0] for r in todo.select("src_db").distinct().collect()]
    texts = view_texts(spark, source_catalog, schemas)
    written = views.rewrite(texts, todo, source_catalog=source_catalog, target_catalog=target_catalog)
    if dry_run:
        return written.select("view_key", "source_view_fqn", "target_view_fqn", "target_ddl")
    for r in written.orderBy("view_key").collect():
        ok, error = (False, r["ddl_error"]) if r["ddl_error"] else views.publish(spark, r["target_ddl"], target_catalog)
        state.record(
            view_key=r["view_key"],
            source_view_fqn=r["source_view_fqn"],
            target_view_fqn=r["target_view_fqn"],
            migrate_status="success" if ok else "failed",
            migrate_at=now(),
            migrate_error=error,
        )
    return state.compact()


def validate_views(
    spark: SparkSession,
    specs: DataFrame,
    state: StateTable,
    *,
    source_catalog: str = "spark_catalog",
    target_catalog: str = "spark_catalog",
    strict: bool = True,
    unique_keys: bool = False,
    rerun_all: bool = False,
    **options,
) -> DataFrame:
    """Diff every view not ``ok`` yet against its source; a view that fails, or lacks a column, is an
    ``error``. ``rerun_all`` also takes those that are ``ok``."""
    catalogs = {"source_catalog": source_catalog, "target_catalog": target_catalog}
    todo = _specs(specs, state, "validation_status", catalogs, options, rerun_all)
    for r in todo.orderBy("view_key").collect():
        result = {
            "view_key": r["view_key"],
            "source_view_fqn": r["source_view_fqn"],
            "target_view_fqn": r["target_view_fqn"],
            "validation_at": now(),
        }
        try:
            diff = RowDiff(
                spark.table(quote_name(r["source_view_fqn"])),
                spark.table(quote_name(r["target_view_fqn"])),
                [k.strip() for k in r["join_key"].split(",")],
                where=r["filter_expression"],
                cast_to_string=r["cast_to_string"],
                strict=strict,
                unique_keys=unique_keys,
            )
            found = diff.verdict().first().asDict()
            lost = list(diff.sides.lost)
            result |= found | {"validation_error": f"the target lacks columns {lost}" if lost else None}
        except (*SPARK_ERRORS, ValueError) as problem:
            result |= {"validation_status": "error", "validation_error": message(problem)}
        state.record(**result)
    return state.compact()
