"""Property snapshots: one ``table_fqn, key, value`` row per property of every table."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.errors import SPARK_ERRORS, message
from tablesync.functions.quoting import quote_name
from tablesync.schemas import PROPERTIES
from tablesync.sources.catalog import READERS

UNREADABLE = "table_fqn string, error string"


def snapshot_by_sql(spark: SparkSession, fqns: Iterable[str], errors: list | None = None) -> DataFrame:
    """As ``SHOW TBLPROPERTIES`` lists them. See :func:`unreadable` for ``errors``."""

    def read(fqn: str) -> list[tuple]:
        shown = spark.sql(f"SHOW TBLPROPERTIES {quote_name(fqn)}").select("key", "value").collect()
        return [(fqn, r["key"], r["value"]) for r in shown]

    return spark.createDataFrame([row for rows in _each(fqns, read, errors) for row in rows], PROPERTIES)


def snapshot_by_metadata(spark: SparkSession, fqns: Iterable[str], errors: list | None = None) -> DataFrame:
    """As the table's own description holds them. See :func:`unreadable` for ``errors``."""

    def read(fqn: str) -> tuple:
        return fqn, spark.sql(f"DESCRIBE TABLE EXTENDED {quote_name(fqn)} AS JSON").first()[0]

    described = spark.createDataFrame(_each(fqns, read, errors), "table_fqn string, description string")
    properties = F.from_json("description", "table_properties map<string,string>")["table_properties"]
    return described.select("table_fqn", F.explode(properties).alias("key", "value"))


def _each(fqns: Iterable[str], read: Callable[[str], Any], errors: list | None) -> list:
    """What ``read`` finds for each table, in order, several at a time; tables that fail are noted, or stop all."""

    def noted(fqn: str) -> tuple:
        try:
            return fqn, read(fqn), None
        except SPARK_ERRORS as problem:
            if errors is None:
                raise
            return fqn, None, message(problem)

    with ThreadPoolExecutor(READERS) as pool:
        found = list(pool.map(noted, fqns))
    if errors is not None:
        errors += [(fqn, problem) for fqn, _, problem in found if problem is not None]
    return [value for _, value, problem in found if problem is None]


def unreadable(spark: SparkSession, errors: list) -> DataFrame:
    """``table_fqn, error`` of the tables a snapshot left out.

    A snapshot given a list notes there what it cannot read and goes on; without one it stops.
    """
    return spark.createDataFrame(errors, UNREADABLE)
