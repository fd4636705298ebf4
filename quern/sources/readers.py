"""File scans with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.schemas import RAW_QUESTION
from quern.sources.quoted import ORDER, scan_quoted

BAD = "_bad"


def read_json_lines(spark: SparkSession, paths: str | list[str], schema: T.StructType = RAW_QUESTION,
                    on_error: str = "fail") -> DataFrame:
    """One JSON object per line, with ``file_name``.

    ``on_error="fail"`` stops at a malformed line; ``"quarantine"`` keeps it in
    the column ``_bad`` with the other columns null (see ``split_quarantine``).
    """
    reader = spark.read
    if on_error == "fail":
        reader = reader.schema(schema).option("mode", "FAILFAST")
    else:
        reader = (reader.schema(schema.add(BAD, T.StringType()) if BAD not in schema.names else schema)
                  .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD))
    return reader.json(paths).withColumn("file_name", F.col("_metadata.file_name"))


def split_quarantine(loaded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows and bad lines of a tolerant read."""
    return (loaded.where(F.col(BAD).isNull()).drop(BAD),
            loaded.where(F.col(BAD).isNotNull()).select("file_name", BAD))


def _tsv(spark: SparkSession, paths: str | list[str], columns: list[str]) -> DataFrame:
    """One record per line; quotes do not reach over line breaks."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, BAD]])
    return (
        spark.read.schema(schema)
        .option("sep", "\t").option("quote", '"').option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnPruning", "false")  # short rows are only recognised when all columns are parsed
        .option("columnNameOfCorruptRecord", BAD)
        .csv(paths)
    )


def read_passages(spark: SparkSession, paths: str | list[str], domain: str | None = None,
                  multi_line: bool = True, with_order: bool = False) -> DataFrame:
    """``pid, passage, domain, chunk_text`` from tab separated files.

    A row with one column is skipped, a row with more keeps its first two, an
    empty passage is kept. The domain is the folder name unless given.
    ``multi_line`` honours line breaks inside quotes; the files are split all the same (see
    ``quoted``), for another pass over them. ``with_order`` adds the
    columns that order rows as they stand in the files.
    """
    rows = _two_columns(spark, paths, "pid", "passage", multi_line)
    folder = F.element_at(F.split(F.col("_file"), "/"), -2)
    return rows.select("pid", "passage", (F.lit(domain) if domain else folder).alias("domain"), F.col("passage").alias("chunk_text"),
                       *(ORDER if with_order else []))


def _two_columns(spark: SparkSession, paths: str | list[str], first: str, second: str, multi_line: bool) -> DataFrame:
    """The first two columns of rows that have them, and the columns of ``in_file_order``."""
    if multi_line:
        fields = F.col("fields")
        return scan_quoted(spark, paths).where(F.size(fields) >= 2).select(
            fields[0].alias(first), fields[1].alias(second), *ORDER)
    rows = _tsv(spark, paths, [first, second])
    return rows.where(F.col(second).isNotNull() | F.col(BAD).isNull()).select(
        F.coalesce(first, F.lit("")).alias(first), F.coalesce(second, F.lit("")).alias(second), *in_file_order())


def in_file_order() -> list:
    """Columns that order rows as they stand in the files."""
    return [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_row")]


def last_wins(rows: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """One value per key: that of the last row in ``order``.

    A partial aggregate, so a key that repeats in a third of the rows is reduced
    inside every task before the exchange.
    """
    return rows.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(value))


def read_queries(spark: SparkSession, paths: str | list[str], multi_line: bool = True) -> DataFrame:
    """``query_id, query_text``; the last row of a repeated id wins."""
    return last_wins(_two_columns(spark, paths, "query_id", "query_text", multi_line), "query_id", "query_text", ORDER)


def read_qrels(spark: SparkSession, paths: str | list[str], last_only: bool = False, with_grade: bool = False) -> DataFrame:
    """``query_id, pid`` from four-column judgements, on request with ``grade``; rows with fewer columns are skipped.

    All pairs are kept unless ``last_only``, which keeps the last pid per query. A grade that is no number is null.
    """
    rows = _tsv(spark, paths, ["query_id", "iteration", "pid", "grade"])
    full = F.col(BAD).isNull() | F.col("grade").isNotNull()
    kept = rows.where(full).select("query_id", "pid", F.col("grade").try_cast("int").alias("grade"), *in_file_order())
    if last_only:
        return last_wins(kept, "query_id", "pid", ORDER)
    return kept.select("query_id", "pid", *(["grade"] if with_grade else []))


def source_sizes(spark: SparkSession, paths: str | list[str], with_folder: bool = False) -> DataFrame:
    """Bytes per source file from the file listing, on request with the folder; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("length").alias("bytes"),
                        *([F.element_at(F.split("path", "/"), -2).alias("folder")] if with_folder else []))
