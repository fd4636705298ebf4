"""Search in fields of many values, such as the answers of a question, and the value that matched best."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.text import tokens
from quern.operators import lexical
from quern.operators.ranking import SCORE_DIGITS
from quern.session import stage


def best_values(hits: DataFrame, docs: DataFrame, field: str, weights: DataFrame, stats: DataFrame, boost: float = 1.0,
                han: str = "run") -> DataFrame:
    """The hits with ``value_position`` (from 0), ``value`` and ``value_score`` of the value of ``field`` that matches best.

    A value is scored as a field of its own, by its own length and counts, with the idf and the mean length of the whole field; equal
    scores go to the earlier value. Hits that match in other fields only, null and empty arrays give nulls.
    Only documents among the hits are read, each cut into tokens once however many queries found it, and only
    tokens of the queries leave the scan.
    """
    hits = stage(hits, "hits")
    wanted = hits.select("doc_id").distinct()
    values = docs.select("doc_id", F.col(field).cast("array<string>").alias("values")).join(wanted, "doc_id", "left_semi").select(
        "doc_id", F.posexplode("values").alias("value_position", "value"))
    values = stage(values.where(F.col("value").isNotNull()), "values")
    here = weights.where(F.startswith("term", F.lit(f"{field}:"))).select(
        "query_id", F.substring("term", len(field) + 2, 2**31 - 1).alias("token"), (F.col("query_weight") / boost).alias("idf"))
    listed = tokens("value", han)
    occurrences = values.select("doc_id", "value_position", F.size(listed).alias("length"), F.explode(listed).alias("token"))
    counts = occurrences.join(here.select("token").distinct(), "token", "left_semi").groupBy(
        "doc_id", "value_position", "length", "token").agg(F.count(F.lit(1)).alias("tf"))
    mean = stats.where(F.col("field") == field).select("avg_length")
    matched = hits.select("query_id", "doc_id").distinct().join(counts, "doc_id").join(here, ["query_id", "token"]).join(
        F.broadcast(mean))  # one row
    norm = lexical.K1 * (1 - lexical.B + lexical.B * F.col("length") / F.col("avg_length"))
    scored = matched.groupBy("query_id", "doc_id", "value_position").agg(
        F.round(F.sum(F.col("idf") * F.col("tf") / (F.col("tf") + norm)), SCORE_DIGITS).alias("value_score"))
    first = F.max_by("value_position", F.struct("value_score", -F.col("value_position")))
    best = scored.groupBy("query_id", "doc_id").agg(first.alias("value_position"), F.max("value_score").alias("value_score"))
    best = best.join(values, ["doc_id", "value_position"])
    return hits.join(best, ["query_id", "doc_id"], "left")


def array_topk(queries: DataFrame, docs: DataFrame, boosts: Mapping[str, float], k: int, field: str, han: str = "run") -> DataFrame:
    """BM25 top-k over ``boosts``, of which ``field`` holds many values, with the best matching value of each hit."""
    if field not in boosts:
        raise ValueError(f"{field} is not among the searched fields {sorted(boosts)}")
    if not boosts[field] > 0:
        raise ValueError(f"the boost of {field} must be positive")
    hits, weights, stats = lexical.bm25_search(queries, docs, boosts, k, han)
    return best_values(hits, docs, field, weights, stats, boosts[field], han)
