"""Views that give the driver tables the shape the operators expect.

All are row-local projections or small group-bys over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame) -> DataFrame:
    """Deal out a scan to as many partitions as the session asks for with ``quern.scan.partitions``; unset, it stays as it is.

    For tables of a single row group, such as the test tables, whose CPU-heavy tokenising would run in one task.
    """
    wanted = scan.sparkSession.conf.get("quern.scan.partitions", None)
    return scan.repartition(int(wanted)) if wanted else scan


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products as question-and-answer documents, with 0 to 3 answers each."""
    part = table(spark, sf_dir, "part")
    answers = F.array(*[
        F.struct(F.col(c).alias("answer_text")) for c in ("p_type", "p_brand", "p_name")])
    return part.select(
        F.col("p_partkey").alias("doc_id"),
        F.col("p_name").alias("item_name"),
        F.col("p_brand").alias("brand_name"),
        F.col("p_type").alias("category_name"),
        F.concat_ws(" ", "p_type", "p_name").alias("product_description"),
        F.concat_ws(" ", F.lit("is the"), "p_name", F.lit("sold as"), "p_type").alias("question_text"),
        F.col("p_brand").alias("bullet_point1"),
        F.col("p_type").alias("bullet_point2"),
        F.col("p_name").alias("bullet_point3"),
        F.col("p_size").cast("string").alias("bullet_point4"),
        F.lit(None).cast("string").alias("bullet_point5"),
        F.slice(answers, F.lit(1), (F.col("p_partkey") % 4).cast("int")).alias("answers"),
        F.col("p_size").alias("size"),
    )


def catalog_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct product name as a question, keyed by its first product."""
    part = table(spark, sf_dir, "part")
    return part.groupBy(F.col("p_name").alias("query_text")).agg(F.min("p_partkey").alias("query_id"))


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("doc_id").cast("string").alias("pid"), F.col("lang").alias("domain"),
        F.col("text").alias("passage"), "source")


def passage_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"), "embedding", F.col("label").alias("cell"))


def query_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vector of each benchmark question, matched by id."""
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"))
    vecs = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("query_id"), "embedding")
    return items.join(vecs, "query_id")


def memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages under the namespace ``(user_id, session_id)``."""
    return table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") % 10).alias("user_id"), F.col("conv_id").alias("session_id"),
        "turn", "role", "text")
