"""Registry of the queries, and inputs derived from the given tables.

Input texts are plain SQL that Spark and the checking engine both run; ``{orders}`` and the
like stand for the tables. Perturbed copies change, move and lose rows of the whole table, as a
bad copy would.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.functions.quoting import quote_name, quote_text

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = text(sql)
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def derived(spark: SparkSession, folder: str, sql: str) -> DataFrame:
    """An input text over the given tables."""
    used = {n: table(spark, folder, n) for n in TABLES if "{" + n + "}" in sql}
    return spark.sql(sql, **used)


def text(sql: str) -> str:
    """The same text for the checking engine, where the tables go by their names."""
    return sql.format(**{n: n for n in TABLES})


def attach(spark: SparkSession, schema: str, folder: str, names=TABLES) -> None:
    """Given files as external tables of a schema; nothing is copied."""
    for name in names:
        path = quote_text(f"{folder}/{name}.parquet")
        spark.sql(f"CREATE TABLE {quote_name(f'{schema}.{name}')} USING parquet LOCATION {path}")


def counts_of(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """``name, rows`` of catalog tables."""
    frames = [
        spark.table(quote_name(fqn)).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("name"), "rows"
        )
        for name, fqn in tables.items()
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


ORDERS_COPY = """
SELECT CASE WHEN o_totalprice < 6000 THEN o_orderkey + 1000000000000 ELSE o_orderkey END AS o_orderkey,
       o_custkey,
       CASE WHEN o_totalprice BETWEEN 100000 AND 112000 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_totalprice BETWEEN 200000 AND 209000 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       o_orderdate,
       o_orderpriority
FROM {orders}
WHERE NOT (o_totalprice BETWEEN 300000 AND 305000)
"""

LINEITEM_COPY = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CASE WHEN l_extendedprice BETWEEN 20000 AND 21000 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
       l_extendedprice, l_discount, l_tax, l_returnflag,
       CASE WHEN l_extendedprice BETWEEN 30000 AND 30500 THEN 'X' ELSE l_linestatus END AS l_linestatus,
       l_shipdate
FROM {lineitem}
WHERE NOT (l_extendedprice BETWEEN 40000 AND 41000)
"""
