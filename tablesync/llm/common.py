"""What several operators share: whole-table reads, the label split, and streamed sums."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablesync.sources.workspace import use_checkpoints

# Labels are learnt from documents outside this fold only.
FOLDS = 5
# Labelled documents a model is fitted on at most; everything else covers all documents.
FIT_ROWS = 10_000
# Rows of an Arrow batch: a few MB of text, as workers hold a batch in several forms at once.
BATCH_ROWS = 1000
# Bits of a bitmap of hashes at most: 16 MB.
BITMAP_BITS = 27


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows, written once to the folder that all executors share."""
    use_checkpoints(df.sparkSession)
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of results that were checkpointed: it does so once the driver has no reference to them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def give_back() -> None:
    """Memory that a task has freed goes back to the system: its worker stays, and goes on to other tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def held_out(doc_id: str = "doc_id") -> Column:
    """Is the document in the fold no label is learnt from? A null id is not."""
    crc = F.crc32(F.col(doc_id).cast("string"))
    return F.coalesce(crc % F.lit(FOLDS) == F.lit(0), F.lit(False))


def fit_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = FIT_ROWS) -> DataFrame:
    """``doc_id, text, label`` of at most ``rows`` labelled documents outside the held-out fold.

    The rows are those with the smallest hash of their id, so a document's place in the sample
    does not depend on the layout of the tables. The sample of ids is broadcast: its size is
    bounded by ``rows``.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    own = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return own.join(F.broadcast(chosen), "doc_id")


def map_batches(
    df: DataFrame,
    run: Callable[[Iterator[dict[str, list]]], Iterator[dict[str, object]]],
    schema: str | StructType,
) -> DataFrame:
    """``run`` over the batches of each partition, as columns by name.

    Workers on this machine find the package beside the driver's; a cluster is given it as usual. The session's
    Arrow batches are made smaller, where they are larger than ``BATCH_ROWS``, as rows here are whole texts.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)

    def values(column: pa.Array):
        """An array where the values are plain numbers, else a list."""
        plain = pa.types.is_integer(column.type) or pa.types.is_boolean(column.type)
        return column.to_numpy(zero_copy_only=False) if plain and not column.null_count else column.to_pylist()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ({n: values(b.column(n)) for n in b.schema.names} for b in batches)
        for out in run(columns):
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[f.name], type=f.type, from_pandas=False) for f in arrow], schema=arrow
            )
            del out
        give_back()

    conf, size = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(size)) <= BATCH_ROWS:
        conf.set(size, BATCH_ROWS)
    df.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return df.mapInArrow(task, schema)


def pieces(batches: Iterator[dict[str, list]], most: int = 4 << 20, by: str = "text") -> Iterator[dict[str, list]]:
    """The same rows in batches of about ``most`` bytes of text, one row at least."""
    for batch in batches:
        start, size = 0, 0
        for i, value in enumerate(batch[by]):
            size += len(value or b"")
            if size >= most:
                yield {k: v[start : i + 1] for k, v in batch.items()}
                start, size = i + 1, 0
        if start < len(batch[by]):
            yield {k: v[start:] for k, v in batch.items()}


def summed_table(
    df: DataFrame,
    add: Callable[[np.ndarray, dict[str, list]], None],
    shape: tuple[int, int],
    blocks: int = 32,
    dtype: str = "<i8",
) -> np.ndarray:
    """The sum over all partitions of a table of fixed shape that ``add`` fills from batches.

    Each task sends its own table in ``blocks`` pieces; the pieces of one block are added while
    they stream by, so that no task holds more than a block for each it has been dealt. What comes to the driver has
    the fixed size of the table.
    """
    rows, columns = shape
    step = -(-rows // blocks)

    def local(batches):
        total = np.zeros(shape, dtype)
        for batch in pieces(batches):
            add(total, batch)
        if total.any():
            for b in range(blocks):
                part = total[b * step : (b + 1) * step]
                if part.size:
                    yield {"block": [b], "data": [part.tobytes()]}

    def merge(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, data in zip(batch["block"], batch["data"]):
                part = np.frombuffer(data, dtype)
                sums[b] = sums[b] + part if b in sums else part
        for b, part in sums.items():
            yield {"block": [b], "data": [part.tobytes()]}

    sent = map_batches(df, local, "block int, data binary")
    added = map_batches(sent.repartition(blocks, "block"), merge, "block int, data binary")
    out = np.zeros(shape, dtype)
    for row in added.collect():
        part = np.frombuffer(row.data, dtype).reshape(-1, columns)
        out[row.block * step : row.block * step + len(part)] = part
    return out


def in_bitmap(bitmap: np.ndarray, h: int) -> bool:
    bit = h % (len(bitmap) * 8)
    return bool(bitmap[bit >> 3] >> (bit & 7) & 1)


def bitmap_of(df: DataFrame, h: Column) -> np.ndarray:
    """A bitmap of 64-bit hashes, of a fixed size at most. It lets others pass too, the more the fuller it is."""
    want = max(16 * df.count(), 1 << 15)
    bits = min(1 << (want - 1).bit_length(), 1 << BITMAP_BITS)
    place = df.select(F.pmod(h, F.lit(bits)).alias("p")).select(F.expr("p div 32768").alias("k"), F.expr("p % 32768").alias("p"))
    out = np.zeros(bits // 8, np.uint8)
    for row in place.groupBy("k").agg(F.expr("bitmap_construct_agg(p)").alias("data")).collect():
        data = np.frombuffer(row.data, np.uint8)
        out[row.k * 4096 : row.k * 4096 + len(data)] = data
    return out
