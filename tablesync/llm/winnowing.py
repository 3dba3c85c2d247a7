"""Document fingerprints by winnowing, in DataFrame functions only.

A text's words are hashed, every run of ``gram`` words gets a polynomial hash that rolls from one
word to the next, and of every ``window`` hashes in a row the smallest is kept with its position, the
rightmost of equal ones. Whatever two texts share over ``gram + window - 1`` words leaves a
common fingerprint in both, at positions that tell where; nothing shorter than ``gram`` words does.

A hash and its position are one long number, the position counted down, so that the
least number is the least hash at its rightmost place. Minima over a window come from minima over
half of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import checkpointed

GRAM, WINDOW = 4, 8
PRIME, BASE = (1 << 31) - 1, 1_000_003
LAST = (1 << 32) - 1
_BLANKS = r"[\x20\x09-\x0D]+"


def _from(column: str, skip: int, size: Column) -> Column:
    return F.slice(F.col(column), F.lit(skip + 1), size)


def with_fingerprint(df: DataFrame, text: str, out: str, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Add ``out``, an array of longs: the chosen hashes with their positions.

    Fewer words than ``gram`` are one hash; fewer hashes than ``window`` are one window; a text without words
    has an empty fingerprint. ``window`` is a power of two. The columns ``__w*`` are used up.
    """
    roll = lambda a, b: (a * BASE + b) % PRIME
    words = F.filter(F.split(F.lower(F.col(text)), _BLANKS), lambda w: w != "")
    df = df.withColumn("__w0", F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(PRIME))))
    size = F.size("__w0")
    rolled: Column = _from("__w0", 0, size - gram + 1)
    for j in range(1, gram):
        rolled = F.zip_with(rolled, _from("__w0", j, size - gram + 1), roll)
    few = F.when(size > 0, F.array(F.aggregate("__w0", F.lit(0).cast("long"), roll))).otherwise(
        F.array().cast("array<bigint>")
    )
    df = df.withColumn("__w1", F.when(size >= gram, rolled).otherwise(few)).drop("__w0")
    df = df.withColumn("__w2", F.transform("__w1", lambda h, i: h * (LAST + 1) + (LAST - i))).drop("__w1")
    chosen = "__w2"
    step = 1
    while step < window:
        size = F.size(chosen)
        halves = F.zip_with(
            F.slice(chosen, 1, size - step), F.slice(chosen, step + 1, size - step), lambda a, b: F.least(a, b)
        )
        # A text with too few hashes for one window keeps one minimum over all of them.
        name = f"__w{step + 2}m"
        df = df.withColumn(name, F.when(size > step, halves).otherwise(F.slice(F.array(F.array_min(chosen)), 1, F.least(size, F.lit(1)))))
        df = df.drop(chosen)
        chosen, step = name, step * 2
    return df.withColumn(out, F.array_distinct(chosen)).drop(chosen)


def hashes_of(fingerprint: Column) -> Column:
    """The distinct hashes, without positions."""
    return F.array_distinct(F.transform(fingerprint, lambda x: F.shiftright(x, 32).cast("int")))


def text_of(fingerprint: Column) -> Column:
    """``hash:position`` in order, the hash in hexadecimal."""
    one = lambda x: F.concat(F.hex(F.shiftright(x, 32)), F.lit(":"), (LAST - x % (LAST + 1)).cast("string"))
    return F.array_join(F.transform(fingerprint, one), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two sets of hashes; two empty sets are equal."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def before(docs: DataFrame) -> DataFrame:
    """``doc_id, prev_id, prev_n`` of each distinct id: the next smaller id and its text's length.

    The smallest id gets the largest. Ids are sorted in ranges; only the ranges' ends meet in one place.
    """
    from pyspark.sql import Window

    ids = docs.groupBy("doc_id").agg(F.max(F.length("__text")).alias("n"))
    ranged = checkpointed(ids.repartitionByRange("doc_id").withColumn("part", F.spark_partition_id()))
    ends = ranged.groupBy("part").agg(F.max(F.struct(F.col("doc_id").isNotNull().alias("k"), "doc_id", "n")).alias("end"))
    order = Window.orderBy("part")
    everywhere = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    joined = F.coalesce(F.lag("end").over(order), F.last("end").over(everywhere))
    ends = ends.select("part", joined.alias("end"))
    within = Window.partitionBy("part").orderBy("doc_id")
    own = ranged.withColumn("prev", F.lag(F.struct("doc_id", "n")).over(within))
    end = F.struct(F.col("end.doc_id").alias("doc_id"), F.col("end.n").alias("n"))
    return (
        own.join(ends, "part")
        .withColumn("prev", F.when(F.col("prev").isNull(), end).otherwise(F.col("prev")))
        .select("doc_id", F.col("prev.doc_id").alias("prev_id"), F.col("prev.n").alias("prev_n"))
    )


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Fingerprints of each text and of its edited text, with their likenesses.

    Columns: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``. In the edited text the last quarter of the code points is replaced by as many from
    the start of the next document, by ascending ``doc_id``, or by all it has; the last
    document is followed by the first. A null text counts as empty. Where an id repeats, the row with the
    smallest text hash stands for it as a next document.
    """
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("__text"))
    links = before(own)
    placed = own.join(
        links.withColumnRenamed("doc_id", "__id"), F.col("doc_id").eqNullSafe(F.col("__id"))
    ).drop("__id")
    following = (
        with_fingerprint(placed, "__text", "f", gram, window)
        .select(
            F.col("prev_id").alias("__before"),
            F.struct(
                F.xxhash64("__text").alias("h"),
                F.expr("left(__text, cast(prev_n div 4 as int))").alias("head"),
                hashes_of(F.col("f")).alias("next"),
            ).alias("following"),
        )
        .groupBy("__before")
        .agg(F.min("following").alias("following"))
    )
    quarter = F.floor(F.length("__text") / 4).cast("int")
    joined = placed.join(following, F.col("doc_id").eqNullSafe(F.col("__before"))).select(
        "doc_id",
        "__text",
        F.concat(
            F.substring("__text", F.lit(1), F.length("__text") - quarter),
            F.substring("following.head", F.lit(1), quarter),
        ).alias("__edited"),
        F.col("following.next").alias("next"),
    )
    done = with_fingerprint(joined, "__text", "f", gram, window)
    done = with_fingerprint(done, "__edited", "e", gram, window)
    done = done.withColumns({"fh": hashes_of(F.col("f")), "eh": hashes_of(F.col("e"))})
    return done.select(
        "doc_id",
        F.length("__text").cast("long").alias("n_chars"),
        F.sha2(F.col("__edited").cast("binary"), 256).alias("edited_sha256"),
        text_of(F.col("f")).alias("fingerprint"),
        text_of(F.col("e")).alias("edited_fingerprint"),
        likeness(F.col("fh"), F.col("eh")).alias("near_edited"),
        likeness(F.col("fh"), F.col("next")).alias("near_next"),
    )
