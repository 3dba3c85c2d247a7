"""Views: resolve what to publish, rewrite their DDL for the target, create them there."""

from __future__ import annotations

import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from itertools import islice
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.errors import SPARK_ERRORS, message
from tablesync.functions.naming import after_first_part, filled, first_part, has_schema
from tablesync.functions.quoting import quote_text
from tablesync.functions.sqltext import (
    NAME, PART, Relation, marked, marked_relations, new_mark, parts_of, shown_relations, split_view, wanted_relations
)
from tablesync.sources.workspace import share_package, shared_folder

TEXTS_AT_ONCE, TEXTS_HELD = 8, 20_000


def _names(specs: DataFrame) -> DataFrame:
    """``view_full`` split at its first dot, and the target's names, which default to the source's."""
    full = F.trim("view")
    whole = F.coalesce(has_schema(full), F.lit(False))
    src_db, src_view = F.when(whole, first_part(full)), F.when(whole, after_first_part(full))
    problem = F.concat(F.lit("view must be <schema>.<name>: "), F.coalesce("view", F.lit("<null>")))
    return specs.select(
        "*",
        full.alias("view_full"),
        F.struct(
            src_db.alias("src_db"),
            src_view.alias("src_view"),
            F.coalesce(filled(F.col("target_db")), src_db).alias("tgt_db"),
            F.coalesce(filled(F.col("target_view")), src_view).alias("tgt_view"),
        ).alias("names"),
        F.when(~whole, problem).alias("spec_error"),
    )


def resolve(
    specs: DataFrame,
    *,
    source_catalog: str,
    target_catalog: str,
    base_suffix: str = "",
    default_key: str = "",
    default_casts: tuple[str, ...] = (),
    default_filter: str = "",
    location_root: str | None = None,
) -> DataFrame:
    """View specs with every default filled in; ``spec_error`` where the name has no schema.

    No filter means every row. The base table defaults to the source view's name and
    ``base_suffix``, the location to the target's place below ``location_root``.
    """
    n, named = F.col("names"), F.col("spec_error").isNull()
    defaults = {
        "base_table": F.concat(n["src_db"], F.lit("."), n["src_view"], F.lit(base_suffix)),
        "target_location": F.when(
            named, F.concat(F.lit(location_root), F.lit("/"), n["tgt_db"], F.lit(".db/"), n["tgt_view"])
        ),
        "filter_expression": F.lit(default_filter),
        "join_key": F.lit(default_key),
    }
    casts = F.array(*[F.lit(c) for c in default_casts]).cast("array<string>")
    return _names(specs).select(
        "view_full",
        "names.*",
        *[F.coalesce(filled(F.col(c)), default).alias(c) for c, default in defaults.items()],
        F.coalesce("cast_to_string", casts).alias("cast_to_string"),
        F.concat(F.lit(f"{source_catalog}."), n["src_db"], F.lit("."), n["src_view"]).alias("source_view_fqn"),
        F.when(named, F.concat(F.lit(f"{target_catalog}."), n["tgt_db"], F.lit("."), n["tgt_view"])).alias("target_view_fqn"),
        "spec_error",
    )


_CREATED = re.compile(
    rf"^(?P<before>(?:\s|--[^\n]*\n|/\*.*?\*/)*)CREATE\s+(?:OR\s+REPLACE\s+)?VIEW\s+(?P<name>{NAME})", re.I | re.S
)
_PAIR = r"(?<!\\)'location'\s*=\s*'[^']*'"
_MOVED = re.compile(r"((?<!\\)'location'\s*=\s*|\bLOCATION\s+)'[^']*'", re.I)
_LOCATED = re.compile(rf"\s*TBLPROPERTIES\s*\(\s*{_PAIR}\s*\)|,\s*{_PAIR}|{_PAIR}\s*,|\s*\bLOCATION\s+'[^']*'", re.I)


def case_sensitive(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.caseSensitive") == "true"


@dataclass(frozen=True)
class _Text:
    """A view's text as it should be on the target, but for the relations of its query."""

    head: str
    query: str
    base: str
    known: frozenset[tuple[str, ...]]
    source_catalog: str
    target_catalog: str
    sensitive: bool

    def folded(self, parts: tuple[str, ...]) -> tuple[str, ...]:
        return _folded(parts, self.sensitive)

    def moves(self, parts: tuple[str, ...]) -> bool:
        return self.folded(parts) in self.known or (
            len(parts) > 2 and self.folded(parts[:1]) == self.folded((self.source_catalog,))
        )

    def moved(self, relations: list[Relation]) -> str:
        """The whole text, its relations at these places on the target."""
        out, at = [], 0
        for name in relations:
            if self.folded(name.parts) in self.known:
                new = self.base
            else:
                new = re.sub(rf"^{PART}", lambda _: self.target_catalog, self.query[name.start : name.end])
            out += [self.query[at : name.start], new]
            at = name.end
        return self.head + "".join(out) + self.query[at:]


def _folded(parts: tuple[str, ...], sensitive: bool) -> tuple[str, ...]:
    return parts if sensitive else tuple(p.lower() for p in parts)


def _text(
    ddl: str,
    *,
    source_view: str,
    target_view: str,
    base_table: str,
    location: str | None,
    source_catalog: str,
    target_catalog: str,
    sensitive: bool,
) -> _Text:
    own = _folded(parts_of(source_view), sensitive)
    known = frozenset({own, *(_folded((c,), sensitive) + own for c in (source_catalog, target_catalog))})
    head, query = split_view(ddl)
    created = _CREATED.match(head)
    if created and _folded(parts_of(created["name"]), sensitive) in known:
        head = f"{created['before']}CREATE OR REPLACE VIEW {target_view}{head[created.end():]}"
    if location is None:
        head = _LOCATED.sub("", head)
    else:
        quoted = quote_text(location)
        head = _MOVED.sub(lambda m: m[1] + quoted, head)
    base = base_table if len(parts_of(base_table)) > 2 else f"{target_catalog}.{base_table}"
    return _Text(head, query, base, known, source_catalog, target_catalog, sensitive)


def rewrite_ddl(
    spark: SparkSession,
    ddl: str,
    *,
    source_view: str,
    target_view: str,
    base_table: str,
    location: str | None,
    source_catalog: str,
    target_catalog: str,
    sensitive: bool | None = None,
) -> str:
    """The DDL of a view as it should be on the target.

    Relations are those that Spark's parser finds in the query, so that aliases, columns, literals,
    comments and names of a WITH stay as they are. Relations in the source catalog become relations in the
    target catalog; the view's own source name becomes the base table there. Before the query, the created view is
    renamed; a location property or clause is replaced where a location is given and else taken out, as the
    source's would be wrong; CREATE becomes CREATE OR REPLACE. A query that Spark cannot read raises its ParseException.
    """
    text = _text(
        ddl,
        source_view=source_view,
        target_view=target_view,
        base_table=base_table,
        location=location,
        source_catalog=source_catalog,
        target_catalog=target_catalog,
        sensitive=case_sensitive(spark) if sensitive is None else sensitive,
    )
    if not text.query.strip():
        return text.head
    return text.moved(wanted_relations(spark, text.query, text.moves))


def rewrite(texts: DataFrame, resolved: DataFrame, *, source_catalog: str, target_catalog: str) -> DataFrame:
    """``resolved`` with ``ddl``, the view's text among ``texts`` (``fqn, ddl``), ``target_ddl`` and ``ddl_error``.

    Each text is parsed in the task that has its row. Only those that Spark cannot read there, whose places only the
    parser knows, or that hold variables go to the driver, TEXTS_HELD of them at a time; what is written goes to the
    shared folder. One that Spark cannot read at all has a null ``target_ddl``.
    """
    spark = resolved.sparkSession
    joined = resolved.where("spec_error IS NULL").join(
        texts.select(F.col("fqn").alias("source_view_fqn"), "ddl"), "source_view_fqn", "left"
    )
    options = {"source_catalog": source_catalog, "target_catalog": target_catalog, "sensitive": case_sensitive(spark)}
    used = ["source_view_fqn", "view_full", "target_view_fqn", "base_table", "target_location", "ddl"]
    mark = new_mark()

    def names_of(view_full, target_view_fqn, base_table, target_location) -> dict:
        return {
            "source_view": view_full, "target_view": target_view_fqn, "base_table": base_table, "location": target_location, **options
        }

    def to_parse(ddl, *names):
        if ddl is None:
            return None
        text = _text(ddl, **names_of(*names))
        return None if not text.query.strip() or "${" in text.query else marked(text.query, text.moves, mark)[0]

    def written(shown, ddl, *names):
        if ddl is None:
            return None
        text = _text(ddl, **names_of(*names))
        if not text.query.strip():
            return text.head
        if shown is None:
            return None
        found = marked_relations(marked(text.query, text.moves, mark)[1], text.moves, mark, shown)
        return None if found is None else text.moved(found)

    def written_here(row) -> tuple:
        try:
            return (*row, rewrite_ddl(spark, row["ddl"], **names_of(*row[1:5])), None)
        except SPARK_ERRORS as problem:
            return (*row, None, message(problem))

    share_package(spark)
    folder = f"{shared_folder(spark)}/ddl/{uuid.uuid4().hex}"
    given = ["ddl", *used[1:5]]
    shown = shown_relations(spark, F.udf(to_parse, "string", useArrow=False)(*given))
    # Parsing is much work for few bytes: as many tasks as there may be.
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = joined.repartition(tasks).withColumn("target_ddl", F.udf(written, "string", useArrow=False)(shown, *given))
    rows.write.parquet(f"{folder}/rows")
    saved = spark.read.schema(rows.schema).parquet(f"{folder}/rows")
    done = F.col("ddl").isNull() | F.col("target_ddl").isNotNull()
    whole = saved.where(done).withColumn("ddl_error", F.lit(None).cast("string"))

    schema = ", ".join(f"{c} string" for c in [*used, "target_ddl", "ddl_error"])
    asked = saved.where(~done).drop("target_ddl")
    left = asked.select(*used).distinct().toLocalIterator()
    # The parser goes by the settings of its thread's session.
    active = spark._jvm.org.apache.spark.sql.classic.SparkSession.setActiveSession
    with ThreadPoolExecutor(TEXTS_AT_ONCE, initializer=lambda: active(spark._jsparkSession)) as pool:
        # Executor.map would take all rows at once.
        while some := list(islice(left, TEXTS_HELD)):
            found = spark.createDataFrame(list(pool.map(written_here, some)), schema)
            found.coalesce(TEXTS_AT_ONCE).write.mode("append").parquet(f"{folder}/asked")
    spark.createDataFrame([], schema).write.mode("append").parquet(f"{folder}/asked")
    new = spark.read.schema(schema).parquet(f"{folder}/asked")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in used]
    others = asked.alias("a").join(new.alias("b"), reduce(and_, same), "left").select("a.*", "b.target_ddl", "b.ddl_error")
    return whole.unionByName(others)


def publish(spark: SparkSession, ddl: str | None, catalog: str | None = None) -> tuple[bool, str | None]:
    """Run one rewritten DDL: whether it worked, and the error if not.

    Names without a catalog are read in ``catalog``, by a session of its own if the current one has another.
    """
    if not ddl:
        return False, "the source view has no readable definition"
    try:
        if catalog and catalog != spark.catalog.currentCatalog():
            spark = spark.newSession()
            spark.catalog.setCurrentCatalog(catalog)
        spark.sql(ddl)
        return True, None
    except SPARK_ERRORS as problem:
        return False, message(problem)
