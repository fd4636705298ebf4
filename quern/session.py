"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import re
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_local_scratch: str | None = None


def build_session(app_name: str = "quern", master: str | None = None,
                  shuffle_partitions: int | None = None, scan_partitions: int | None = None) -> SparkSession:
    """A session with the settings the operators are tuned for.

    Joins carry no broadcast hints unless a size bound is known, so Catalyst
    (static estimate) and AQE (measured size) decide, and skewed sort-merge
    joins are split at run time.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if scan_partitions:
        builder = builder.config("quern.scan.partitions", str(scan_partitions))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may run without the setting; it then gets a fresh
    temporary folder, which would be wrong on a cluster.
    """
    global _local_scratch
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="quern-")
    return _local_scratch


def new_folder(spark: SparkSession, label: str) -> str:
    """An unused path below the shared folder."""
    return f"{shared_folder(spark)}/quern/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    Used where several branches of a plan need the same costly intermediate:
    it is computed once, stays columnar (each branch reads only its columns)
    and survives the loss of any executor. ``codec`` is how to compress it, else as the session says.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt out by ``keys`` into as many partitions as the session has for shuffles, neither fewer nor more.

    For steps that hold what a task gets, or make many rows of one: Spark measures scans and exchanges in compressed
    bytes, and gives one task a table that is small on disk, however many rows it has.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


_shipped_to: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped_to:
        return
    package = Path(__file__).parent
    archive = shutil.make_archive(
        f"{tempfile.mkdtemp(prefix='quern-ship-')}/{package.name}", "zip", package.parent, package.name)
    context.addPyFile(archive)
    _shipped_to.add(context.applicationId)
