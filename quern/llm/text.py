"""Text expressions and helpers that several operators here share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.session import ship_package

# The white space and the upper-case letters that the contracts name.
WHITESPACE = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x20\x09-\x0D]+"


def fold(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII takes the faster built-in, which then does the same."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def word_count(text: Column) -> Column:
    """Words between white space; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def digest(*columns: Column) -> list[Column]:
    """Two independent 64-bit hashes, together a key for equality."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit(0x9E3779B9), *columns)]


def folded_words(text: str | None) -> list[bytes]:
    """UTF-8 words between ASCII white space, A-Z lower-cased (bytes methods know ASCII only)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def map_chunks(df: DataFrame, columns: list[str], size: Callable[[pa.RecordBatch], int], limit: int,
               work: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """Run ``work`` on chunks of whole rows whose summed ``size`` is about ``limit``.

    Memory of a task is bounded by one chunk; a row is never cut.
    """
    def run(batches):
        held, total = [], 0
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                stop = min(batch.num_rows, start + 512)
                part = batch.slice(start, stop - start)
                held.append(part)
                total += size(part)
                start = stop
                if total >= limit:
                    yield from work(pa.Table.from_batches(held))
                    held, total = [], 0
        if held:
            yield from work(pa.Table.from_batches(held))
    ship_package(df.sparkSession)
    return df.select(*columns).mapInArrow(run, schema)


def text_bytes(column: str) -> Callable[[pa.RecordBatch], int]:
    def size(batch: pa.RecordBatch) -> int:
        return batch.column(batch.schema.get_field_index(column)).nbytes
    return size


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until the table has no such column."""
    while name.lower() in map(str.lower, df.columns):
        name += "_"
    return name
