"""Shared ranking pieces: the hits shape and the rank cut.

Every search operator returns ``hits(query_id, rank, doc_id, score)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCORE_DIGITS = 6


def rounded(score: Column) -> Column:
    """Scores are rounded before ranking so that equal scores tie exactly."""
    return F.round(score, SCORE_DIGITS)


def rank_cut(scored: DataFrame, k: int, by: str = "query_id") -> DataFrame:
    """The best ``k`` documents per query, ties by document id.

    ``row_number() <= k`` plans a WindowGroupLimit: every task keeps ``k`` rows
    per query before the exchange, so a hot query never moves all its rows.
    """
    order = Window.partitionBy(by).orderBy(F.desc("score"), F.asc("doc_id"))
    return (
        scored.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select(by, F.col("rank").cast("bigint").alias("rank"), "doc_id", "score")
    )
