"""Corpus pipeline: quality, repeated lines, near duplicates, test passages, mix.

Every stage works on what its predecessor kept; the result of each is a Parquet table in the shared
folder, so a lost executor costs a stage's task and not the pipeline.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import contamination, jaccard, line_dedup, mixing, quality
from quern.llm.text import unused
from quern.session import stage


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows a changed text."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from the labels of these documents, rejects go."""
    name = unused(docs, "score")
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model, name=name).filter(F.col(name) >= quality.ACCEPT).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand in at least 10 documents leave all of them; the documents stay."""
    report = (unused(docs, "n_lines"), unused(docs, "n_dropped"))
    return _counted(line_dedup.dedup_lines(docs, report=report).select(*docs.columns))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles, 80 % alike, the one of smallest id stays."""
    return jaccard.keep_one(docs, width=5, percent=80)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of test items are cut out of the texts; the documents stay."""
    return _counted(contamination.remove_spans(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with words in the mix, and ``taken``, how many (repeats counted). Rows that share id and text are one document."""
    key = F.xxhash64("doc_id", "text")
    taken = mixing.mix(docs.select(key.alias("key"), "text", "source"), id_col="key").filter("taken > 0").groupBy(
        F.col("doc_id").alias("key")).agg(F.max("taken").alias("mixed"))
    joined = docs.select(F.struct("*").alias("row"), key.alias("key")).join(taken, "key")
    return joined.select(*(F.col("row")[c].alias(c) for c in docs.columns if c != "taken"), F.col("mixed").alias("taken"))


STAGES = [("quality", keep_good), ("line dedup", drop_lines), ("near duplicates", drop_copies),
          ("decontamination", cut_passages), ("mix", mix_sources)]

#: The classifier is learned, which SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
