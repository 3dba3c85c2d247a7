"""Manifest files: a JSON array as people write it, or one object per line as Spark does."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablesync.schemas import MANIFEST
from tablesync.sources.workspace import share_package, shared_folder

# Spark reads the array of a file as a whole; files of more bytes than this are read element by element. Compressed
# ones are taken for files of as many times their bytes.
WHOLE_FILE, COMPRESSED = 32 << 20, 16
# Bytes of one element at most, and elements of a batch.
ELEMENT, BATCH = 16 << 20, 1000
# Ends a record: no JSON has it, while a blank or a new line may be part of a value that is read as text.
_END = "\x01"
_BLANK = b" \t\r\n"
_PACKED = r"\.(gz|gzip|bz2|zst|lz4|snappy|deflate|xz)$"
_TOKEN = re.compile(rb'\\.|["{}]', re.S)


class EmptyManifest(ValueError):
    """The file holds no manifest row."""


def read_manifest(spark: SparkSession, path: str, *, lines: bool = False) -> DataFrame:
    """Rows of a manifest: a JSON array per file, or with ``lines`` an object per line."""
    rows = spark.read.schema(MANIFEST).option("multiLine", not lines).json(path)
    if not lines and rows.columns == MANIFEST.fieldNames():
        rows = _arrays(spark, path, rows)
    if rows.where(F.col("table").isNotNull()).isEmpty():
        raise EmptyManifest(f"no manifest rows in {path}")
    return rows


def _arrays(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """``rows`` of the files of ``path``, where no task holds the array of a large file.

    A large file is cut at each ``}`` and its pieces are put in order again by a sort, so that a task reads them as a
    stream. Its objects are written to the shared folder, one to a record, as only then it is known that all of the file
    is an array of objects; one that is not is read by Spark, which decides what becomes of it.
    """

    def is_large(name: str, size: str) -> Column:
        times = F.when(F.lower(name).rlike(_PACKED), F.lit(COMPRESSED)).otherwise(F.lit(1))
        return F.col(size) * times > WHOLE_FILE

    large = spark.read.format("binaryFile").load(path).where(is_large("path", "length")).select("path").count()
    if not large:
        return rows
    in_pieces, file = is_large("_metadata.file_path", "_metadata.file_size"), F.xxhash64("_metadata.file_path")
    pieces = spark.read.option("lineSep", "}").text(path).where(in_pieces).select(
        file.alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").cast("binary").alias("value"),
    )
    share_package(spark)
    # Few files share a task that way.
    ordered = pieces.repartition(min(8 * large, 2000), "file").sortWithinPartitions("file", "block", "at")
    folder = f"{shared_folder(spark)}/manifests/{uuid.uuid4().hex}"
    records = ordered.select("file", "value").mapInArrow(_records, "value string")
    # Compressed files are not cut again, so they are kept short.
    records.write.option("lineSep", _END).option("maxRecordsPerFile", 200 * BATCH).text(folder, compression="lz4")
    schema = StructType().add("file", "long").add("row", MANIFEST)
    found = spark.read.schema(schema).option("lineSep", _END).json(folder)
    broken = [r["file"] for r in found.where("row IS NULL").select("file").distinct().collect()]
    if None in broken:  # Spark refuses a record that is JSON here
        return rows
    known, others = found.where(~F.col("file").isin(broken)), rows.where(~in_pieces | file.isin(broken))
    return known.select("row.*").unionByName(others.select(*MANIFEST.fieldNames()))


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The objects of each file's array, each next to its file, and a null where the file is no array of objects."""
    pieces = (p for b in batches for p in zip(b.column("file").to_pylist(), b.column("value").to_pylist()))
    found = (
        f'{{"file":{file},"row":{element or "null"}}}'
        for file, own in groupby(pieces, key=lambda p: p[0])
        for element in _objects(value for _, value in own)
    )
    while some := list(islice(found, BATCH)):
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.string())], ["value"])


def _objects(pieces: Iterator[bytes]) -> Iterator[str | None]:
    """The texts of the objects in an array that was cut at each ``}``; a last None where it is none, or JSON with extensions."""
    before, part, size, depth, quoted = b"[", [], 0, 0, False
    last = next(pieces, b"").removeprefix(b"\xef\xbb\xbf")
    for following in pieces:
        piece, last = last + b"}", following
        if not part:
            piece = piece.lstrip(_BLANK)
            if not piece.startswith(before):
                break
            piece, before = piece[1:].lstrip(_BLANK), b","
            element = _object(piece)
            if element is not None:
                yield element
                continue
            if not piece.startswith(b"{"):
                break
        part.append(piece)
        size += len(piece)
        # Nested, or with braces in its texts: it goes on to its own end.
        for token in _TOKEN.findall(piece):
            if token == b'"':
                quoted = not quoted
            elif not quoted:
                depth += {b"{": 1, b"}": -1}.get(token, 0)
        if depth == 0 and not quoted:
            element = _object(b"".join(part))
            if element is None:
                break
            yield element
            part, size = [], 0
        elif size > ELEMENT:
            break
    else:
        if not part and before == b"," and last.strip(_BLANK) == b"]":
            return
    yield None


def _object(text: bytes) -> str | None:
    try:
        shown = text.decode()
        return shown if isinstance(json.loads(shown), dict) else None
    except (ValueError, RecursionError):
        return None


def write_manifest(manifest: DataFrame, path: str) -> None:
    """One object per line, so that a large manifest is written and read in parallel."""
    manifest.select(*MANIFEST.fieldNames()).write.mode("errorifexists").json(path)
