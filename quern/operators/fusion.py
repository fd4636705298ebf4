"""Hybrid search: normalise each leg per query, combine, rank again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.operators.ranking import rank_cut, rounded


def min_max(hits: DataFrame) -> DataFrame:
    """Scores of each query scaled to [0, 1]; a query whose scores are all equal gets 1.

    Works on candidate lists of at most ``k`` rows per query.
    """
    per_query = Window.partitionBy("query_id")
    low, high = F.min("score").over(per_query), F.max("score").over(per_query)
    scaled = F.when(high == low, F.lit(1.0)).otherwise((F.col("score") - low) / (high - low))
    return hits.withColumn("score", scaled)


def boosted(hits: DataFrame, boost: float) -> DataFrame:
    """Scores of one clause multiplied by its boost."""
    return hits.withColumn("score", rounded(F.col("score") * float(boost)))


def combine(first: DataFrame, second: DataFrame, weights: Sequence[float]) -> DataFrame:
    """Weighted arithmetic mean over two normalised legs: ``(query_id, doc_id, score)``.

    A document missing from a leg counts 0 there, with the weight still in the
    denominator.
    """
    w1, w2 = map(float, weights)
    a = first.select("query_id", "doc_id", F.col("score").alias("a"))
    b = second.select("query_id", "doc_id", F.col("score").alias("b"))
    mean = (w1 * F.coalesce("a", F.lit(0.0)) + w2 * F.coalesce("b", F.lit(0.0))) / (w1 + w2)
    return a.join(b, ["query_id", "doc_id"], "full_outer").select(
        "query_id", "doc_id", rounded(mean).alias("score"))


def hybrid(first: DataFrame, second: DataFrame, weights: Sequence[float], size: int) -> DataFrame:
    """Two legs of ``k`` candidates to one page of ``size`` hits."""
    return rank_cut(combine(min_max(first), min_max(second), weights), size)
