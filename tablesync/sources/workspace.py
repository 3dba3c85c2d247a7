"""The shared folder for checkpoints and for schemas that only one run uses."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

from tablesync.functions.quoting import quote_part, quote_text

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a temporary folder.
    """
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tablesync-"))
    return sc.getCheckpointDir().rstrip("/")


def use_checkpoints(spark: SparkSession) -> None:
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)


def share_package(spark: SparkSession) -> None:
    """Python workers on this machine find the package beside the driver's; a cluster is given it as usual."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def scratch_schema(spark: SparkSession, label: str) -> str:
    """Create a schema in the shared folder under a name no other run has."""
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    location = f"{shared_folder(spark)}/schemas/{name}.db"
    spark.sql(f"CREATE SCHEMA {quote_part(name)} LOCATION {quote_text(location)}")
    return name
