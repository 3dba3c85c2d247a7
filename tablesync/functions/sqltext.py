"""Where a SQL text names relations. The text is read by Spark's parser, which keeps the place of all it finds."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tablesync.errors import SPARK_ERRORS

PART = r"(?:`(?:[^`]|``)*`|\w+)"
NAME = rf"{PART}(?:\s*\.\s*{PART})*"
_COMMENT = r"--[^\n]*|/\*.*?\*/"
_LITERAL = r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\""
_TOKEN = re.compile(rf"{_COMMENT}|{_LITERAL}|{PART}|.", re.S)
_DOTTED = re.compile(rf"{_COMMENT}|\b[rR](?:'[^']*'|\"[^\"]*\")|{_LITERAL}|(?P<name>{NAME})", re.S)
_SHOWN = re.compile(r"UnresolvedRelation \[(?=([^\n]*))")
_SPARK_PARSER = "org.apache.spark.sql.execution.SparkSqlParser"


@dataclass(frozen=True)
class Relation:
    """A name of one or more parts at ``text[start:end]``."""

    start: int
    end: int
    parts: tuple[str, ...]


def split_view(ddl: str) -> tuple[str, str]:
    """The text of a view before its query, AS included, and the query; without one, the query is empty."""
    depth = 0
    for token in _TOKEN.finditer(ddl):
        word = token.group()
        depth += (word == "(") - (word == ")")
        if depth == 0 and word.upper() == "AS":
            return ddl[: token.end()], ddl[token.end() :]
    return ddl, ""


def parts_of(name: str) -> tuple[str, ...]:
    """The parts of a name as written, without the quotes."""
    found = (re.sub(r"^`(.*)`$", r"\1", p.strip(), flags=re.S) for p in re.findall(PART, name))
    return tuple(p.replace("``", "`") for p in found)


def wanted_relations(spark: SparkSession, query: str, wanted: Callable[[tuple[str, ...]], bool]) -> list[Relation]:
    """Those of :func:`relations` whose parts are wanted, all of two parts or more, by one reading of the parsed text.

    Where the parser still finds a wanted relation under its old name, the places are read from the parser instead.
    """
    mark = new_mark()
    text, found = marked(query, wanted, mark)
    try:
        names = _SHOWN.findall(_parsed(spark, text).toString())
    except SPARK_ERRORS:
        # The error should show the text as it was given.
        return [r for r in relations(spark, query) if wanted(r.parts)]
    read = marked_relations(found, wanted, mark, names)
    return [r for r in relations(spark, query) if wanted(r.parts)] if read is None else read


def new_mark() -> str:
    return f"m{uuid.uuid4().hex}_"


def marked(query: str, wanted: Callable[[tuple[str, ...]], bool], mark: str) -> tuple[str, list[Relation]]:
    """The query with a name of its own for each wanted name outside comments and literals, and the places of these.

    The parser then tells which of them are relations.
    """
    names = (Relation(m.start(), m.end(), parts_of(m["name"])) for m in _DOTTED.finditer(query) if m["name"])
    found = [r for r in names if wanted(r.parts)]
    out, at = [], 0
    for i, r in enumerate(found):
        out += [query[at : r.start], f"{mark}{i}_"]
        at = r.end
    return "".join(out) + query[at:], found


def marked_relations(
    found: list[Relation], wanted: Callable[[tuple[str, ...]], bool], mark: str, names: list[str]
) -> list[Relation] | None:
    """The marked names that are relations, by what the parsed text shows of its relations.

    None where a wanted relation is still there under its old name, so that only the parser knows its place.
    """
    for name in names:
        ends = [i for i, c in enumerate(name) if c == "]"]
        if any(wanted(tuple(name[:end].split(", "))) for end in ends):
            return None
    read = {name.split("]", 1)[0] for name in names}
    return [r for i, r in enumerate(found) if f"{mark}{i}_" in read]


def shown_relations(spark: SparkSession, query: Column) -> Column:
    """What a query, parsed where its row is, shows of each of its relations; null where only the driver can read it.

    That is a query that Spark's parser refuses, or any where a session has another parser.
    """
    if _parser(spark).getClass().getName() != _SPARK_PARSER:
        return F.lit(None).cast("array<string>")
    jvm = spark._jvm
    made, types, seq = jvm.org.apache.spark.sql.catalyst.expressions, jvm.org.apache.spark.sql.types, jvm.PythonUtils.toSeq
    bridge = jvm.org.apache.spark.sql.classic.ExpressionUtils
    # A class of a package that was added to a session is known to the thread's loader.
    loader, none = jvm.java.lang.Thread.currentThread().getContextClassLoader(), jvm.scala.Option.empty()

    def of(name: str):
        return types.ObjectType(jvm.java.lang.Class.forName(name, False, loader))

    def call(target, method: str, result: str, *arguments):
        return made.objects.Invoke(target, method, of(result), seq(list(arguments)), seq([]), True, True, True)

    parser = made.objects.NewInstance(of(_SPARK_PARSER).cls(), seq([]), seq([]), False, of(_SPARK_PARSER), none)
    given = call(bridge.expression(query._jc), "toString", "java.lang.String")
    plan = call(parser, "parsePlan", "org.apache.spark.sql.catalyst.plans.logical.LogicalPlan", given)
    text = made.objects.StaticInvoke(
        of("org.apache.spark.unsafe.types.UTF8String").cls(),
        getattr(getattr(types, "StringType$"), "MODULE$"),
        "fromString",
        seq([call(plan, "toString", "java.lang.String")]),
        seq([]),
        True,
        True,
        True,
        none,
    )
    return F.regexp_extract_all(Column(bridge.column(made.TryEval(text))), F.lit(_SHOWN.pattern), F.lit(1))


def _parsed(spark: SparkSession, query: str):
    return _parser(spark).parsePlan(query)


@lru_cache(maxsize=1)
def _parser(spark: SparkSession):
    return spark._jsparkSession.sessionState().sqlParser()


def relations(spark: SparkSession, query: str) -> list[Relation]:
    """The relations of a query in order, also those in its subqueries and common table expressions.

    Names that a WITH defines are among them where they are read; they have one part. Raises Spark's ParseException where the text is not a query.
    """
    plan = _parsed(spark, query)
    named = set()
    for node in _nodes(plan, whole=re.search(r"\bWITH\b", query, re.I) is not None):
        while node.nodeName() == "RelationTimeTravel":
            node = node.relation()
        if node.nodeName() != "UnresolvedRelation":
            continue
        at = node.origin()
        if at.startIndex().isDefined() and at.stopIndex().isDefined():
            parts = tuple(node.multipartIdentifier().mkString("\0").split("\0"))
            named.add(Relation(at.startIndex().get(), at.stopIndex().get() + 1, parts))
    return sorted(named, key=lambda r: r.start)


def _nodes(plan, whole: bool):
    """The leaves of a plan and of all its subqueries; all nodes where inner plans may hang on others."""
    if not whole:
        yield from _each(plan.collectLeaves())
        for sub in _each(plan.subqueriesAll()):
            yield from _each(sub.collectLeaves())
        return
    yield plan
    for inner in (plan.children(), plan.innerChildren(), plan.subqueries()):
        for node in _each(inner):
            yield from _nodes(node, whole)


def _each(found):
    at = found.iterator()
    while at.hasNext():
        yield at.next()
