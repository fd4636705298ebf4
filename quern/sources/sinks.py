"""Keyed loads, table creation, reports and size estimates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.schemas import add_columns

MB_PER_PRODUCT_DOC = 2
KB_PER_PASSAGE = 1


def latest_by_key(rows: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """One row per key, the one with the highest version.

    Reduced with a partial aggregate: copies of a hot key collapse in every task
    before the exchange. Without a version order the result would depend on task
    timing, so one is required; rows of equal version are told apart by a hash of their values.
    """
    if not version:
        raise ValueError("an explicit version order is needed to pick a row per key")
    others = [c for c in rows.columns if c not in keys]
    if not others:
        return rows.distinct()
    digest = F.xxhash64(*(_hashable(F.col(c), rows.schema[c].dataType) for c in others))
    rest = [c for c in others if c not in version]
    plain = {*version} <= {*rows.columns} and "_digest" not in rows.columns and not any(_has_map(rows.schema[c].dataType) for c in rest)
    if plain and len(rest) < len(others):  # values that rows are ordered by need not move twice
        best = F.max(F.struct(*dict.fromkeys(version), digest.alias("_digest"), *rest)).alias("_row")
        return rows.groupBy(*keys).agg(best).select(*keys, *(F.col(f"_row.`{c}`") for c in others)).select(*rows.columns)
    best = F.max_by(F.struct(*others), F.struct(*version, digest)).alias("_row")
    return rows.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*rows.columns)


def _hashable(value: Column, kind: T.DataType) -> Column:
    """The value without maps, which Spark does not hash: these become sorted arrays of entries."""
    if isinstance(kind, T.MapType):
        entries = F.array_sort(F.map_keys(value))
        return F.transform(entries, lambda k: F.struct(_hashable(k, kind.keyType), _hashable(value[k], kind.valueType)))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _hashable(x, kind.elementType)) if _has_map(kind) else value
    if isinstance(kind, T.StructType):
        return F.struct(*(_hashable(value[f.name], f.dataType).alias(f.name) for f in kind.fields)) if _has_map(kind) else value
    return value


def _has_map(kind: T.DataType) -> bool:
    return "map<" in kind.simpleString()


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """The table after a keyed load: an incoming row replaces the row with its key (``existing`` has one row per key).

    Among incoming rows the highest version wins; columns new to the table are
    added and null for old rows. Only the incoming rows are reduced; stored rows are anti-joined with
    the incoming keys, which Spark sends to them while they are few.
    """
    current = latest_by_key(incoming, keys, version)
    kept = existing.join(current.select(*keys), list(keys), "left_anti").select(*existing.columns)
    return add_columns(kept, current)


def write_partitioned(docs: DataFrame, path: str, partition: str, mode: str = "overwrite") -> None:
    """Write by category; rows of one category are spread over tasks, not sent to one."""
    docs.write.mode(mode).partitionBy(partition).option("maxRecordsPerFile", 1_000_000).parquet(path)


def create_table(df: DataFrame, name: str, delete_existing: bool = False) -> None:
    """Create a table; an existing one is replaced when asked, else kept as it is."""
    df.write.mode("overwrite" if delete_existing else "ignore").saveAsTable(name)


UNIT_BYTES = {"b": 1, "kb": 1024, "mb": 1024**2, "gb": 1024**3}


def table_size(spark: SparkSession, path: str, unit: str = "mb") -> DataFrame:
    """Stored size of a table folder in whole units, from the file listing: one row ``size``.

    A folder that does not exist has size 0.
    """
    try:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .option("pathGlobFilter", "*.parquet").load(path))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.range(1).select(F.lit(0).cast("bigint").alias("size"))
    return files.agg(F.floor(F.coalesce(F.sum("length"), F.lit(0)) / UNIT_BYTES[unit]).cast("bigint").alias("size"))


def size_label(megabytes, digits: int):
    """``512 MB`` below 1024 MB, else ``1.5 GB``; ties round half-even."""
    small = F.concat(F.format_string(f"%.{digits}f", F.bround(megabytes, digits)), F.lit(" MB"))
    return F.when(megabytes < 1024, small).otherwise(
        F.concat(F.format_string("%.1f", F.bround(megabytes / 1024, 1)), F.lit(" GB")))


def size_estimate(docs: DataFrame, source: str) -> DataFrame:
    """Planned index size per source under both per-document constants."""
    counts = docs.groupBy(source).agg(F.count(F.lit(1)).alias("docs"))
    return counts.select(
        source, "docs",
        size_label((F.col("docs") * MB_PER_PRODUCT_DOC).cast("double"), 0).alias("product_estimate"),
        size_label(F.col("docs") * KB_PER_PASSAGE / 1024, 0).alias("passage_estimate"))


def load_report(docs: DataFrame, source: str) -> DataFrame:
    """Documents per source, with a total line whose source is ``TOTAL``."""
    return docs.rollup(source).agg(
        F.count(F.lit(1)).alias("docs"), F.grouping(source).alias("_total")).select(
        F.when(F.col("_total") == 1, "TOTAL").otherwise(F.col(source)).alias(source), "docs")
