"""Ranking quality: hits against judgements, for many cut-offs in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.session import dealt

METRICS = ("recall", "reciprocal_rank", "ndcg")


def _gain(grade: Column) -> Column:
    return F.pow(F.lit(2.0), grade) - 1


def _discount(rank: Column) -> Column:
    return F.log2(rank + 1)


def per_query(hits: DataFrame, judged: DataFrame, cutoffs: Sequence[int]) -> DataFrame:
    """``(query_id, cutoff, recall, reciprocal_rank, ndcg)`` of every judged query.

    ``judged(query_id, doc_id[, grade])`` holds relevant documents; grades above 0 are relevant (1 where there is no column),
    a pair judged twice has its highest grade. A judged query without hits has zeros, hits of a query without relevant documents
    are not rated, and a document that comes twice in the hits counts at its first rank. Recall is out of all relevant documents.
    """
    if not cutoffs or min(cutoffs) < 1:
        raise ValueError("cut-offs are positive numbers")
    deepest = max(cutoffs)
    grade = F.col("grade").cast("double") if "grade" in judged.columns else F.lit(1.0)
    judged = dealt(judged.where(F.col("doc_id").isNotNull()).select("query_id", "doc_id", grade.alias("grade")), "query_id", "doc_id")
    relevant = (judged.groupBy("query_id", "doc_id").agg(F.max("grade").alias("grade")).where("grade > 0"))
    shown = hits.where(F.col("rank") <= deepest).groupBy("query_id", "doc_id").agg(F.min("rank").alias("rank"))
    found = shown.join(relevant, ["query_id", "doc_id"])
    best = Window.partitionBy("query_id").orderBy(F.desc("grade"))
    ideal = dealt(relevant, "query_id").withColumn("rank", F.row_number().over(best))
    within = lambda value, k: F.sum(F.when(F.col("rank") <= k, value).otherwise(0.0))
    gained = _gain(F.col("grade")) / _discount(F.col("rank"))
    got = found.groupBy("query_id").agg(F.min("rank").alias("first"), *(
        x for k in cutoffs for x in (within(F.lit(1.0), k).alias(f"found_{k}"), within(gained, k).alias(f"dcg_{k}"))))
    possible = ideal.groupBy("query_id").agg(F.count("*").alias("relevant"), *(within(gained, k).alias(f"ideal_{k}") for k in cutoffs))
    both = possible.join(got, "query_id", "left")
    zero = lambda value: F.coalesce(value, F.lit(0.0))
    rated = F.array(*(F.struct(
        F.lit(k).alias("cutoff"), zero(F.col(f"found_{k}") / F.col("relevant")).alias("recall"),
        zero(F.when(F.col("first") <= k, 1.0 / F.col("first"))).alias("reciprocal_rank"),
        zero(F.col(f"dcg_{k}") / F.col(f"ideal_{k}")).alias("ndcg")) for k in cutoffs))
    return both.select("query_id", F.inline(rated))


def summary(rated: DataFrame, digits: int = 6) -> DataFrame:
    """Means over the judged queries: ``(cutoff, queries, recall, reciprocal_rank, ndcg)``."""
    return rated.groupBy("cutoff").agg(F.count("*").alias("queries"), *(F.round(F.avg(m), digits).alias(m) for m in METRICS))
