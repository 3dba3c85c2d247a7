"""Exact deduplication of a growing table of documents, as a stream with keyed state.

The files of a table are a stream. For each digest of a text the state keeps how many rows had it, the
largest identifier among them, and where the text of that row lies (file and row). The state is on disk
(RocksDB, with its changes in the shared folder), nothing in it expires, and rows are aggregated in each task before
they reach it, so a text that a third of all rows share is one row from each task. A later run goes on
from there with the files that are new.

Digests only say where to look. On each hit the whole texts are compared: texts whose digest repeats are
grouped by all their bytes, and a group that does not hold the located text is another text with the same digest, which
is then counted on its own. Before that a bitmap of digests of fixed size leaves out most texts that are not repeated;
where there are so many repeated ones that it fills up, every text is sent once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import BITMAP_BITS, checkpointed
from tablesync.sources.workspace import shared_folder

# Small stores take no space ahead, and a batch writes its changes, not the whole store.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
BUCKET_BITS = 32768


def _text(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def _placed(files: DataFrame, digest_bytes: int) -> DataFrame:
    """``doc, digest, place``: all columns of each row, the key, and id, file and row."""
    at = files.metadataColumn("_metadata")
    place = F.struct(F.col("doc_id"), at["file_path"].alias("file"), at["row_index"].alias("row"))
    digest = F.substring(F.unhex(F.sha2(_text("text"), 256)), 1, digest_bytes)
    return files.select(F.struct(*[files[_quoted(c)] for c in files.columns]).alias("doc"), digest.alias("digest"), place.alias("place"))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _one_path(path: str) -> str:
    """A pattern for exactly this path: a stream may then read a single file too."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def remember(spark: SparkSession, path: str, state: str, files_per_batch: int = 1000, digest_bytes: int = 32) -> DataFrame:
    """Bring the state in the folder ``state`` up to date with all files of ``path``; return it.

    Columns: ``digest, keep`` (the place of the row that stays), ``n`` (rows). Files that the state has seen are not
    read again. The session is left as it is.
    """
    own = spark.newSession()
    partitions = {"spark.sql.shuffle.partitions": spark.conf.get("spark.sql.shuffle.partitions")}
    for key, value in {**STATE_STORE, **partitions}.items():
        own.conf.set(key, value)
    stream = (
        own.readStream.schema(spark.read.parquet(path).schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(_one_path(path))
    )
    seen = _placed(stream, digest_bytes).groupBy("digest").agg(F.max("place").alias("keep"), F.count(F.lit(1)).alias("n"))
    query = (
        seen.writeStream.outputMode("update").format("noop").option("checkpointLocation", state).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.format("statestore").load(state).select(
        "key.digest", F.col("value.max").alias("keep"), F.col("value.count").alias("n")
    )


def _among(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows whose digest may be among ``keys``, by a bitmap of at most 16 MB that is broadcast."""
    bits = min(1 << max(16 * keys.count(), BUCKET_BITS).bit_length(), 1 << BITMAP_BITS)
    place = F.pmod(F.xxhash64("digest"), F.lit(bits))
    filled = (
        keys.select(place.alias("p"))
        .groupBy(F.expr(f"p div {BUCKET_BITS}").alias("bucket"))
        .agg(F.expr(f"bitmap_construct_agg(p % {BUCKET_BITS})").alias("bits"))
    )
    byte = F.conv(F.hex(F.expr("substring(bits, cast(bit div 8 as int) + 1, 1)")), 16, 10).cast("long")
    return (
        rows.withColumns({"bucket": F.floor(place / BUCKET_BITS), "bit": place % BUCKET_BITS})
        .join(F.broadcast(filled), "bucket")
        .where(F.getbit(byte, F.expr("cast(bit % 8 as int)")) == 1)
        .drop("bucket", "bit", "bits")
    )


def _checked(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """``digest, text, keep, n`` of the texts of which another one has the same digest."""
    texts = (
        _among(docs.select("digest", _text("doc.text").alias("text"), "place"), hits)
        .groupBy("digest", "text")
        .agg(F.max("place").alias("keep"), F.count(F.lit(1)).alias("n"))
    )
    # The row that stays is the largest of all rows of the digest, so it is the largest of its own text.
    found = texts.join(hits.select("digest", F.col("keep").alias("located")), "digest")
    other = checkpointed(found.where(F.col("keep") != F.col("located")).select("digest").distinct())
    return checkpointed(texts.join(other, "digest"))


def marked(
    spark: SparkSession, path: str, state: str | None = None, files_per_batch: int = 1000, digest_bytes: int = 32
) -> DataFrame:
    """``doc`` (all columns of a row), ``place``, ``keep`` (place of the row that stays) and ``n`` of all rows at ``path``.

    ``path`` is a Parquet table and ``state`` the folder of the stream's state; without one a new folder in the shared one is
    taken. ``digest_bytes`` are how many bytes of the SHA-256 digest are the key. Files must not change once they are seen.
    """
    state = state or f"{shared_folder(spark)}/exact-dedup-{uuid.uuid4().hex}"
    hits = checkpointed(remember(spark, path, state, files_per_batch, digest_bytes).where(F.col("n") > 1))
    docs = _placed(spark.read.parquet(path), digest_bytes)
    others = _checked(docs, hits)
    if others.isEmpty():
        found = docs.join(hits, "digest", "left")
    else:
        apart = others.select("digest").distinct()
        found = docs.join(apart, "digest", "left_anti").join(hits, "digest", "left")
        own = docs.withColumn("text", _text("doc.text")).join(others, ["digest", "text"])
        found = found.unionByName(own.select(*found.columns))
    return found.select("doc", "place", F.coalesce("keep", "place").alias("keep"), F.coalesce("n", F.lit(1).cast("long")).alias("n"))


def unique_documents(spark: SparkSession, path: str, **options) -> DataFrame:
    """The rows that stay, with all their columns: of equal texts the one with the largest id.

    A null text equals an empty one. Of rows with equal text and id the last one by file and row stays; a null id is below all others.
    """
    return marked(spark, path, **options).where(F.col("keep").eqNullSafe(F.col("place"))).select("doc.*")


def dedup_report(spark: SparkSession, path: str, **options) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``, one row for each row of the table at ``path``.

    Equal texts are those of equal bytes, where null counts as empty; nothing is normalised and length does not matter. Of each
    group the row with the largest ``doc_id`` stays; repeated rows with that id count in ``group_size``, and
    one of them stays, the last by file and row. A null id is below all others, so ``keep_id`` is null only if
    all ids of the group are. An empty table gives no rows. Other columns are not read.
    """
    return marked(spark, path, **options).select(
        "doc.doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        F.col("keep").eqNullSafe(F.col("place")).alias("kept"),
        F.sha2(_text("doc.text"), 256).alias("text_sha256"),
    )
