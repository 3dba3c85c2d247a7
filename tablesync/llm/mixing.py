"""Mixing sources to target weights by budgets that run down a tree.

The leaves are the sources of a language of a domain. A budget of tokens is shared out from the
root: siblings get shares by their weights, and what one cannot use, because all its leaves together
have fewer tokens over the allowed epochs, goes to its siblings. Only what a whole group of siblings
cannot use was never given to their parent, so shortages are met among siblings before ancestors.
Budgets are whole tokens; the last few go to the largest remainders.

A leaf with budget q takes its documents in seeded epochs: in each epoch they are
sorted by a hash of seed, epoch and id, and the leaf's stream of tokens is cut after q. So each document is
taken in every full epoch, and once more if it is in the prefix of the last. What is left of q where the next document does
not fit is pooled among siblings, which take the next document of as many of them as it pays for, the smallest first; what is
then left is pooled higher up, to the root. No document is cut, and the whole budget is never passed. To find where
that prefix ends, the documents of a leaf are counted in as many hash ranges as it has thousands of documents, and only
the range in which the prefix ends is sorted; a leaf with a third of all rows needs no more.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm.common import checkpointed

BROADCAST_LEAVES = 10_000
RANGE_DOCS = 1000
WORD = r"[^\x20\x09-\x0D]+"


def token_count(text: str = "text") -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")


def domain_of(source: str = "source") -> Column:
    """One of four domains for each source, for tables without such a column."""
    digit = F.substring(F.md5(F.coalesce(F.col(source), F.lit("")).cast("binary")), 1, 1)
    return F.concat(F.lit("domain"), F.floor((F.instr(F.lit("0123456789abcdef"), digit) - 1) / 4).cast("string"))


def _share(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """``nodes`` with ``budget``: the parent's ``given`` shared out by ``weight`` up to ``capacity``.

    Siblings sorted by capacity for weight: the first ones take all they can, as long as an even share
    of the rest would be too much for them; the others share what is then left.
    """
    order = Window.partitionBy(*parent).orderBy(F.col("capacity") / F.col("weight"), name)
    so_far = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    family = Window.partitionBy(*parent)
    whole = (
        nodes.withColumn("left", F.col("given") - F.coalesce(F.sum("capacity").over(so_far), F.lit(0)))
        .withColumn("weights", F.sum("weight").over(onward))
        .withColumn("short", F.col("capacity") * F.col("weights") <= F.col("weight") * F.col("left"))
        .withColumn("rest", F.max(F.when(~F.col("short"), F.col("left"))).over(family))
        .withColumn("open", F.sum(F.when(F.col("short"), 0).otherwise(F.col("weight"))).over(family))
    )
    part = F.col("weight") * F.col("rest")
    even = whole.withColumn(
        "floor", F.when(F.col("short"), F.col("capacity")).otherwise(F.expr("weight * rest div open"))
    ).withColumn("over", F.when(F.col("short"), F.lit(-1).cast("long")).otherwise(part % F.col("open")))
    by_rest = Window.partitionBy(*parent).orderBy(F.desc("over"), name)
    used = F.sum("floor").over(family)
    return (
        even.withColumn("unused", F.least("given", F.sum("capacity").over(family)) - used)
        .withColumn("turn", F.row_number().over(by_rest))
        .withColumn("budget", F.col("floor") + ((F.col("turn") <= F.col("unused")) & (F.col("over") >= 0)).cast("long"))
        .drop("left", "weights", "short", "rest", "open", "floor", "over", "unused", "turn")
    )


def budgets(
    leaves: DataFrame, levels: list[str], weights: Mapping[str, Mapping[str, int]], total: Callable[[Column], Column], epochs: int
) -> DataFrame:
    """``leaves`` (levels, ``tokens``, ``docs``) with ``budget``.

    ``weights[level][name]`` are whole numbers, 1 where none is given; siblings of weight 0
    get nothing, and what lies below them adds nothing to what their ancestors can use. ``total`` makes the whole budget from the tokens of
    all leaves.
    """

    def weight(name: str) -> Column:
        named = F.lit(1)
        for value, given in weights.get(name, {}).items():
            named = F.when(F.col(name) == value, F.lit(given)).otherwise(named)
        return named.cast("long")

    usable = F.lit(True)
    for name in levels:
        usable = usable & (weight(name) > 0)
    sized = leaves.withColumn("capacity", F.when(usable, F.col("tokens") * epochs).otherwise(F.lit(0)))
    out = sized
    given: DataFrame | None = None
    for depth in range(1, len(levels) + 1):
        path, name = levels[:depth], levels[depth - 1]
        own = sized.groupBy(*path).agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
        own = own.withColumn("weight", weight(name))
        if given is None:
            everything = F.sum("tokens").over(Window.partitionBy("__root"))
            root = own.withColumn("__root", F.lit(0)).withColumn("given", total(everything).cast("long"))
            given = _share(root.where(F.col("weight") > 0), ["__root"], name).select(*path, F.col("budget").alias("given"))
        else:
            own = own.where(F.col("weight") > 0).join(given, path[:-1])
            given = _share(own, path[:-1], name).select(*path, F.col("budget").alias("given"))
    found = out.join(given.withColumnRenamed("given", "budget"), levels, "left")
    return found.withColumns({"budget": F.when(usable, F.col("budget")).otherwise(F.lit(0)), "usable": usable})


def _passed_on(quota: DataFrame, levels: list[str]) -> DataFrame:
    """``quota`` (levels, ``left``, ``next``) with ``more``: is the next document of the leaf taken too?

    ``left`` is what is left of the leaf's budget and ``next`` the size of the document that did not fit. From the lowest families up, what all
    leaves below a node have left pays for the smallest of the documents not yet taken.
    """
    out = quota.withColumn("more", F.lit(False))
    for depth in range(len(levels) - 1, -1, -1):
        family = Window.partitionBy(F.lit(0), *levels[:depth])
        pool = F.sum(F.col("left") - F.when(F.col("more"), F.col("next")).otherwise(F.lit(0))).over(family)
        open_ = ~F.col("more") & F.col("next").isNotNull()
        order = Window.partitionBy(F.lit(0), *levels[:depth], open_).orderBy("next", *levels)
        paid = open_ & (F.sum("next").over(order.rowsBetween(Window.unboundedPreceding, 0)) <= F.col("pool"))
        out = out.withColumn("pool", pool).withColumn("more", F.col("more") | F.coalesce(paid, F.lit(False))).drop("pool")
    return out


def _order_key(seed: int, epoch: Column, doc_id: str) -> Column:
    key = F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    return F.md5(key.cast("binary"))


def _hash_range(key: Column, ranges: Column) -> Column:
    """The place of a hash among equal ranges, of which there are at most 2^20."""
    return F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("double") / 4294967296.0 * ranges).cast("int")


def mix(
    docs: DataFrame,
    levels: Mapping[str, Column],
    weights: Mapping[str, Mapping[str, int]],
    total: Callable[[Column], Column],
    epochs: int = 2,
    seed: int = 5,
    tokens: Column | None = None,
) -> DataFrame:
    """``docs`` with ``__times``, how often each is taken, ``__tokens`` and the levels as ``__level_*``.

    ``levels`` are the tree's levels from the top, as expressions; null is a name of its own. A
    document is counted in words unless ``tokens`` says otherwise, a null text in none. The first document
    in the order that does not fit ends the prefix, unless what siblings, or else others, have left pays for it; the whole budget is never passed. Equal keys
    (repeated ids) are taken together. Rows of a leaf of weight 0, or below a node of weight 0, have 0 times; documents without tokens cost nothing, and a leaf
    of only such ones has each of them once. An empty table gives no rows.
    """
    names = [f"__level_{k}" for k in levels]
    placed = docs.withColumns(
        {f"__level_{k}": F.coalesce(v.cast("string"), F.lit("")) for k, v in levels.items()}
        | {"__tokens": token_count() if tokens is None else tokens}
    )
    ids = checkpointed(placed.select("doc_id", "__tokens", *names))
    leaves = ids.groupBy(*names).agg(F.sum("__tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    named = {f"__level_{k}": v for k, v in weights.items()}
    quota = (
        budgets(leaves, names, named, total, epochs)
        .withColumn("full", F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(F.lit(0)))
        .withColumn("part", F.col("budget") - F.col("full") * F.col("tokens"))
        .withColumn("ranges", F.least(F.expr(f"docs div {RANGE_DOCS}") + 1, F.lit(1 << 20)).cast("int"))
    )
    quota = checkpointed(quota)
    # The leaves are broadcast behind this check only; beyond it they are joined as they are.
    small = quota.count() <= BROADCAST_LEAVES
    held = (lambda df: F.broadcast(df)) if small else (lambda df: df)
    keyed = (
        ids.join(held(quota.select(*names, "full", "part", "ranges")), names)
        .withColumn("key", _order_key(seed, F.col("full"), "doc_id"))
        .withColumn("range", _hash_range(F.col("key"), F.col("ranges")))
    )
    in_ranges = keyed.groupBy(*names, "part", "range").agg(F.sum("__tokens").alias("tokens"))
    before = F.sum("tokens").over(Window.partitionBy(*names).orderBy("range")) - F.col("tokens")
    ends = (
        in_ranges.withColumn("before", before)
        .where((F.col("before") <= F.col("part")) & (F.col("before") + F.col("tokens") > F.col("part")))
        .select(*names, "range", F.col("before").alias("before"))
    )
    within = Window.partitionBy(*names, "range").orderBy("key")
    same = Window.partitionBy(*names, "range", "key")
    edge = (
        keyed.join(held(ends), [*names, "range"])
        .withColumns({"after": F.col("before") + F.sum("__tokens").over(within), "next": F.sum("__tokens").over(same)})
        .where(F.col("after") > F.col("part"))
        .groupBy(*names)
        .agg(F.min(F.struct("key", "after", "next")).alias("edge"))
        .select(*names, F.col("edge.key").alias("end"), "edge.after", "edge.next")
    )
    known = quota.join(edge, names, "left").withColumn(
        "left", F.when(F.col("end").isNull(), F.lit(0)).otherwise(F.col("part") + F.col("next") - F.col("after"))
    )
    # A leaf that already has all its epochs takes nothing beyond them.
    known = known.withColumn("next", F.when(F.col("usable") & (F.col("full") < epochs), F.col("next")))
    ends_at = [F.col("full").alias("__full"), F.col("end").alias("__end"), F.col("more").alias("__more"), F.col("usable").alias("__usable")]
    cut = checkpointed(_passed_on(known, names).select(*names, *ends_at))
    key, end = _order_key(seed, F.col("__full"), "doc_id"), F.col("__end")
    last = F.col("__usable") & (end.isNull() | (key < end) | (F.col("__more") & (key == end)))
    out = placed.join(held(cut), names).withColumn("__times", F.col("__full") + last.cast("long"))
    return out.drop("__full", "__end", "__more", "__usable")


def taken(docs: DataFrame, **options) -> DataFrame:
    """The columns of ``docs``, each row as often as it is taken."""
    mixed = mix(docs, **options).where(F.col("__times") > 0)
    once = mixed.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__times"))))
    return once.select(*docs.columns)
