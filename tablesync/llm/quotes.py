"""Quotation linking: messages that quote others, tied to what they quote and put in reply order.

A line's quote level is the number of ``>`` before it. Quoted lines are normalised and hashed, and so are the lines
that messages say themselves. A quoted passage belongs to the last message before it, in its conversation,
that said it; passages nobody said there before are looked for in all other conversations, where the earliest is their
origin. A message replies to the latest message that it quotes at the lowest level. Following replies to their
start gives threads; within a thread messages come in the order of turns, so each follows what
it replies to, without the quotes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablesync.llm.common import checkpointed

_MARKS = r"^((?:[ \t]*>)+)[ \t]?"


def _lines(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, pos, level, line, key``: one row for each line; the key is null for a blank one."""
    split = messages.select(
        "conv_id", "turn", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("pos", "raw")
    )
    marks = F.regexp_extract("raw", _MARKS, 1)
    line = F.regexp_replace("raw", _MARKS, "")
    plain = F.trim(F.regexp_replace(F.lower(line), r"[ \t\x0B\f\r]+", " "))
    return split.select(
        "conv_id",
        "turn",
        "pos",
        F.length(F.regexp_replace(marks, r"[ \t]", "")).alias("level"),
        line.alias("line"),
        F.when(plain != "", F.sha2(plain.cast("binary"), 256)).alias("key"),
    )


def link_quotes(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, pos, level, key, from_turn, origin_conv, origin_turn`` of every quoted line that is not blank.

    ``from_turn`` is the last earlier turn of the conversation that said the line. Where there is none,
    ``origin_conv`` and ``origin_turn`` are the first message of another conversation that did, if one did.
    """
    lines = _lines(messages).where(F.col("key").isNotNull())
    # One sort by conversation, line and turn finds the last one who said it; no pairs are made.
    earlier = Window.partitionBy("conv_id", "key").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    said = F.when(F.col("level") == 0, F.col("turn"))
    quoted = lines.withColumn("from_turn", F.max(said).over(earlier)).where(F.col("level") > 0)
    # Of the conversations that said a line two are enough: one of them is not the one that quotes it.
    spoken = lines.where(F.col("level") == 0).groupBy("key", "conv_id").agg(F.min("turn").alias("turn"))
    turn_of = F.row_number().over(Window.partitionBy("key").orderBy("conv_id"))
    two = spoken.withColumn("of", turn_of).where(F.col("of") <= 2)
    origins = two.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("conv_id", "turn"))).alias("origins"))
    other = F.get(F.filter("origins", lambda o: o["conv_id"] != F.col("conv_id")), F.lit(0))
    elsewhere = F.when(F.col("from_turn").isNull(), other)
    return quoted.join(origins, "key", "left").select(
        "conv_id",
        "turn",
        "pos",
        "level",
        "key",
        "from_turn",
        elsewhere["conv_id"].alias("origin_conv"),
        elsewhere["turn"].alias("origin_turn"),
    )


def _threads(replies: DataFrame) -> DataFrame:
    """``conv_id, turn, thread, depth`` by doubling the steps towards the start of each thread."""
    now = checkpointed(
        replies.select("conv_id", "turn", F.coalesce("reply_to", "turn").alias("up"), F.col("reply_to").isNotNull().cast("int").alias("depth"))
    )
    while True:
        above = now.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("higher"), F.col("depth").alias("more"))
        moved = checkpointed(now.join(above, ["conv_id", "up"]))
        now = moved.select("conv_id", "turn", F.col("higher").alias("up"), (F.col("depth") + F.col("more")).alias("depth"))
        if moved.where(F.col("up") != F.col("higher")).isEmpty():
            return now.withColumnRenamed("up", "thread")


def conversations(messages: DataFrame) -> DataFrame:
    """Messages without quotes, in reply order.

    Columns: ``conv_id, turn, role, said, n_quoted, n_linked, reply_to, origin_conv, origin_turn, thread, depth, place``. ``said`` are the
    message's own lines; ``n_quoted`` counts its quoted lines that are not blank, ``n_linked`` those whose message
    was found; ``origin_conv`` and ``origin_turn`` are the message of another conversation that it quotes at the lowest level, of several the first;
    ``thread`` is the turn the thread starts with and ``place`` the message's place in it. A null
    text is empty. Rows that repeat a turn stay and share its links. Rows with a null ``conv_id`` or ``turn`` cannot be placed and are left out.
    """
    known = messages.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull()).select("conv_id", "turn", "role", "text")
    links = link_quotes(known)
    found = links.groupBy("conv_id", "turn").agg(
        F.countDistinct("pos").alias("n_quoted"),
        F.count_distinct(F.when(F.col("from_turn").isNotNull() | F.col("origin_conv").isNotNull(), F.col("pos"))).alias("n_linked"),
        F.max(F.when(F.col("from_turn").isNotNull(), F.struct((-F.col("level")).alias("near"), F.col("from_turn")))).alias("up"),
        F.min(F.when(F.col("origin_conv").isNotNull(), F.struct("level", "origin_conv", "origin_turn"))).alias("origin"),
    )
    turns = known.select("conv_id", "turn").distinct()
    replies = checkpointed(
        turns.join(found, ["conv_id", "turn"], "left").select(
            "conv_id",
            "turn",
            F.coalesce("n_quoted", F.lit(0).cast("long")).alias("n_quoted"),
            F.coalesce("n_linked", F.lit(0).cast("long")).alias("n_linked"),
            F.col("up.from_turn").alias("reply_to"),
            "origin.origin_conv",
            "origin.origin_turn",
        )
    )
    own = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: ~x.rlike(_MARKS))
    placed = known.join(replies, ["conv_id", "turn"]).join(_threads(replies), ["conv_id", "turn"])
    order = Window.partitionBy("conv_id", "thread").orderBy("turn", "role", "said")
    return placed.withColumn("said", F.array_join(own, "\n")).select(
        "conv_id", "turn", "role", "said", "n_quoted", "n_linked", "reply_to", "origin_conv", "origin_turn", "thread", "depth",
        F.row_number().over(order).cast("long").alias("place"),
    )
