"""Time the headline queries, next to the job-per-number form they replace. Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from workloads import QUERIES
from workloads.base import ORDERS_COPY, TABLES, derived, table
from workloads.diffs import KEY
from tablesync.operators.rowdiff import RowDiff
from tablesync.operators.validate import TablePair, count_parity

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))

# Registered queries that are timed as they are; all write or read whole tables.
REGISTERED = (
    "row_diff",
    "row_diff_by_column",
    "row_diff_duplicates",
    "copy_days",
    "copy_months",
    "copy_identity",
    "copy_chunked",
    "inventory_counts",
    "manifest_normalize",
    "batch_plan",
    "property_diff",
    "property_plan",
    "state_upsert",
    "state_pending",
)


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def by_column_unique(spark):
    source, target = table(spark, FOLDER, "orders"), derived(spark, FOLDER, ORDERS_COPY)
    run(RowDiff(source, target, KEY, unique_keys=True).by_column())


def by_column_job_per_number(spark):
    """One statement for each number: two counts, and how many rows differ in any and in each column."""
    source, target = table(spark, FOLDER, "orders"), derived(spark, FOLDER, ORDERS_COPY)
    tests = [f"s.{c} IS DISTINCT FROM t.{c}" for c in source.columns if c != KEY]
    query = f"SELECT count_if({{}}) FROM {{{{s}}}} s FULL JOIN {{{{t}}}} t ON s.{KEY} = t.{KEY}"
    for condition in [" OR ".join(tests), *tests]:
        spark.sql(query.format(condition), s=source, t=target).collect()
    for side in (source, target):
        side.count()


def inventory_job_per_table(spark):
    for name in TABLES:
        table(spark, FOLDER, name).count()


FILTER = "o_orderdate <= timestamp_ntz '2000-12-31 23:59:59.999'"


def parity_one_plan(spark):
    orders, copy = table(spark, FOLDER, "orders"), derived(spark, FOLDER, ORDERS_COPY)
    pairs = [TablePair(str(i), orders, copy, FILTER) for i in range(4)]
    count_parity(spark, pairs).collect()


def parity_three_jobs_per_pair(spark):
    orders, copy = table(spark, FOLDER, "orders"), derived(spark, FOLDER, ORDERS_COPY)
    for _ in range(4):
        orders.where(FILTER).count(), copy.where(FILTER).count(), copy.count()


def timed(spark, *jobs) -> list[list[float]]:
    """Seconds of each run of each job. Jobs to be compared take turns, so that they see the
    same noise of the machine; the first turn is a warm-up and not kept."""
    taken = [[] for _ in jobs]
    for turn in range(RUNS + 1):
        for job, seconds in zip(jobs, taken):
            start = time.perf_counter()
            job(spark)
            if turn:
                seconds.append(round(time.perf_counter() - start, 3))
    return taken


def registered(name: str):
    return lambda spark: run(QUERIES[name](spark, FOLDER))


def main() -> None:
    folder = tempfile.mkdtemp(prefix="bench-")
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tablesync-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", f"{folder}/shared")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    runs = {}
    compared = {
        "row_diff_by_column": (registered("row_diff_by_column"), by_column_unique, by_column_job_per_number),
        "inventory_counts": (registered("inventory_counts"), inventory_job_per_table),
        "count_parity": (parity_one_plan, parity_three_jobs_per_pair),
    }
    other = {}
    for name, jobs in compared.items():
        found = timed(spark, *jobs)
        runs[name], other[name] = found[0], found[-1]
        if len(found) == 3:
            runs[f"{name}_unique"] = found[1]
    for name in REGISTERED:
        if name not in compared:
            (runs[name],) = timed(spark, registered(name))
    queries = {name: statistics.median(seconds) for name, seconds in runs.items()}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": FOLDER.rsplit("sf", 1)[-1],
                "runs": runs,
                "job_per_number_form": {name: statistics.median(s) for name, s in other.items()},
                "job_per_number_runs": other,
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
