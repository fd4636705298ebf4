"""Incremental load: documents arrive in files, are transformed on arrival and become the current version of their key.

Every micro-batch writes its own folder ``stream=<id>/batch=<n>``. The id is that of the streaming query, kept in its
checkpoint: a replayed batch overwrites its own folder only, and another stream, or one that
starts anew with another checkpoint, never touches stored rows. Arrivals are numbered by a published log (see ``versions``), not by a clock:
a batch takes the next number before it is written, and keeps it when replayed. The current table is resolved on read (latest
arrival, then latest version per key), so the cost of a batch follows the batch and not the table. ``compact``
folds all batches into a new table when reads get slow.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from quern.sources.sinks import latest_by_key
from quern.sources.versions import VersionConflict, VersionLog

STREAM = "stream"
BATCH = "batch"
ARRIVED = "_arrived"


def json_stream(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder)


def parquet_stream(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet") -> DataFrame:
    """The Parquet files of a folder whose name fits ``pattern``."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).parquet(folder)


def table_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table that grows: the part files of its folder, or the one file that it is."""
    folder, _, name = path.rstrip("/").rpartition("/")
    # Spark takes a plain path for a folder; a pattern may fit either.
    return spark.readStream.schema(schema).parquet(f"{folder}/{{{name}}}")


def arrival(log: VersionLog, stream: str, batch: int) -> int:
    """The number of a batch among all arrivals at a table: the next one, or that which the batch took before."""
    while True:
        found = log.latest()
        number, streams = (found[0] + 1, found[1]["streams"]) if found else (1, {})
        if stream in streams and streams[stream][0] == batch:
            return streams[stream][1]
        try:
            log.publish(number, {"streams": {**streams, stream: [batch, number]}})
            return number
        except VersionConflict:
            continue


def incremental_load(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str,
                     checkpoint: str, keys: Sequence[str], version: Sequence[str]) -> StreamingQuery:
    """Load everything that has arrived, then stop; run again for what arrives later. Where nothing has, the table is empty."""
    log = VersionLog(stream.sparkSession, path)
    log.prepare()

    def write_batch(batch: DataFrame, batch_id: int, name: str) -> None:
        number = F.lit(arrival(log, name, batch_id)).cast("bigint")
        current = latest_by_key(transform(batch), keys, version).withColumn(ARRIVED, number)
        current.write.mode("overwrite").parquet(f"{path}/{STREAM}={name}/{BATCH}={batch_id}")
    return _named(stream, write_batch, checkpoint)


def _named(stream: DataFrame, work: Callable[[DataFrame, int, str], None], checkpoint: str) -> StreamingQuery:
    """Run ``work(batch, batch_id, id of the query)`` on all that has arrived, then stop. The id is kept in the checkpoint."""
    started, ids = threading.Event(), []

    def run(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        work(batch, batch_id, ids[0])
    query = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    ids.append(query.id)
    started.set()
    return query


def read_current(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str],
                 version: Sequence[str]) -> DataFrame:
    """The latest row of every key."""
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(ARRIVED, T.LongType())])).parquet(path)
    return latest_by_key(rows, keys, [ARRIVED, *version]).select(*schema.names)


def compact(spark: SparkSession, path: str, target: str, schema: T.StructType, keys: Sequence[str],
            version: Sequence[str]) -> None:
    """Write the current rows as the single oldest batch of a new table; the old one stays untouched.

    Batches that arrive at the old table meanwhile are not in the new one: switch readers and loads over, or compact again.
    """
    rows = read_current(spark, path, schema, keys, version).withColumn(ARRIVED, F.lit(0).cast("bigint"))
    rows.write.parquet(f"{target}/{STREAM}=compacted/{BATCH}=0")
