"""Where states are kept: CSV files for people, a versioned table for batches."""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.quoting import quote_name, quote_part, quote_text
from tablesync.operators.state import conform


# Quoted cells may hold line breaks, and a quote in one is doubled.
CSV = {
    "header": "true", "multiLine": "true", "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A state file with a header. A missing file is an empty state, a missing column is null."""
    try:
        found = spark.read.options(**CSV).csv(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return conform(found, schema)


def write_csv(state: DataFrame, path: str) -> None:
    """Sorted by key, blank cells for nulls."""
    state.orderBy(state.columns[0]).write.mode("errorifexists").options(**CSV).csv(path)


class StateTable:
    """A state under a name in the catalog.

    Parquet tables have no MERGE and cannot be read and replaced at once. So each save writes a
    new table and an empty log, and the view with the state's name is then pointed at both: a reader sees the
    old state or the new one, and a crash before the switch leaves the old. A record is one row
    appended to the log; the view shows the table with the log's latest values. ``compact`` saves
    what the view shows. The version before the current one is kept for those who still read it.
    """

    def __init__(self, spark: SparkSession, schema_name: str, name: str, schema: T.StructType):
        self.spark = spark
        self.schema = schema
        self.key = schema.fieldNames()[0]
        self.place = quote_part(schema_name)
        self.name = name
        self.view = f"{schema_name}.{name}"

    def load(self) -> DataFrame:
        if not self.spark.catalog.tableExists(quote_name(self.view)):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.table(quote_name(self.view))

    def _versions(self) -> list[int]:
        prefix = f"{self.name}__v"
        shown = self.spark.sql(f"SHOW TABLES IN {self.place}").where("NOT isTemporary").collect()
        names = [r["tableName"] for r in shown]
        ends = [n[len(prefix) :] for n in names if n.startswith(prefix)]
        return sorted(int(e) for e in ends if e.isdigit())

    def _table(self, kind: str, version: int) -> str:
        return f"{self.place}.{quote_part(f'{self.name}__{kind}{version}')}"

    def _latest(self, columns: list[str], table: str, log: str) -> str:
        """The query behind the view: of each cell the last recorded value, or else the saved one."""
        key = quote_part(self.key)
        own = [c for c in self.schema.fieldNames() if c != self.key]
        last = ", ".join(
            f"max_by(struct({quote_part(c)} AS value), at) FILTER (WHERE array_contains(given, {quote_text(c)})) AS {quote_part(c)}"
            for c in own
        )
        shown = []
        for c in columns:
            name = quote_part(c)
            if c == self.key:
                shown.append(f"coalesce(s.{name}, l.{name}) AS {name}")
            elif c in own:
                shown.append(f"if(l.{name} IS NULL, s.{name}, l.{name}.value) AS {name}")
            else:
                shown.append(f"s.{name}")
        return (
            f"SELECT {', '.join(shown)} FROM {table} s FULL OUTER JOIN "
            f"(SELECT {key}, {last} FROM {log} GROUP BY {key}) l ON s.{key} = l.{key}"
        )

    def save(self, state: DataFrame) -> None:
        old = self._versions()
        version = (old[-1] if old else 0) + 1
        table, log = self._table("v", version), self._table("log", version)
        state.write.format("parquet").saveAsTable(table)
        fields = [T.StructField("at", T.LongType()), T.StructField("given", T.ArrayType(T.StringType()))]
        empty = self.spark.createDataFrame([], T.StructType([*fields, *self.schema.fields]))
        empty.write.format("parquet").saveAsTable(log)
        query = self._latest(state.columns, table, log)
        self.spark.sql(f"CREATE OR REPLACE VIEW {quote_name(self.view)} AS {query}")
        for before in old[:-1]:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table('v', before)}")
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table('log', before)}")

    def record(self, **fields) -> None:
        """Append the key and the fields to change; a field given as None is blanked."""
        types = {f.name: f.dataType for f in self.schema.fields}
        schema = T.StructType([T.StructField(n, types[n]) for n in fields])
        self.record_all(self.spark.createDataFrame([tuple(fields.values())], schema).coalesce(1))

    def record_all(self, updates: DataFrame) -> None:
        """Append one row for each of ``updates``: the key and the columns to change."""
        if not self._versions():
            self.save(self.spark.createDataFrame([], self.schema))
        given = F.array(*[F.lit(c) for c in updates.columns]).alias("given")
        cells = [
            (F.col(f.name) if f.name in updates.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in self.schema.fields
        ]
        events = updates.select(F.lit(time.time_ns()).alias("at"), given, *cells)
        events.write.insertInto(self._table("log", self._versions()[-1]))

    def compact(self) -> DataFrame:
        """Save what the view shows, with the log worked in."""
        self.save(self.load())
        return self.load()
