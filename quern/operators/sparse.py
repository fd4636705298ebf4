"""Learned-sparse style search: token weights on both sides, scored by dot product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.text import tokens
from quern.operators.matching import count_known, dot_topk
from quern.session import stage


def encode_long(rows: DataFrame, key: str, text: str, weight: str, han: str = "run") -> DataFrame:
    """Default sparse encoder in long form: ``(key, term, weight = ln(1 + tf))``."""
    return (
        rows.select(key, F.explode(tokens(text, han)).alias("term"))
        .groupBy(key, "term")
        .agg(F.log1p(F.count(F.lit(1))).alias(weight))
    )


def to_map(long: DataFrame, key: str, weight: str, name: str = "chunk_sparse_embedding") -> DataFrame:
    """One ``map<term, weight>`` per key, the form kept at rest."""
    pairs = F.array_sort(F.collect_list(F.struct("term", F.col(weight).cast("float"))))
    return long.groupBy(key).agg(F.map_from_entries(pairs).alias(name))


def from_map(rows: DataFrame, key: str, weight: str, column: str = "chunk_sparse_embedding") -> DataFrame:
    return rows.select(key, F.explode(column).alias("term", weight))


def sparse_topk(query_terms: DataFrame, doc_terms: DataFrame, k: int) -> DataFrame:
    """Top-k by dot product over ``(query_id, term, query_weight)`` and ``(doc_id, term, doc_weight)``.

    Terms no query uses are dropped first; what remains is staged once.
    """
    used = doc_terms.join(query_terms.select("term").distinct(), "term", "left_semi")
    return dot_topk(query_terms, stage(used, "sparse"), k)


def sparse_text_topk(queries: DataFrame, docs: DataFrame, text: str, k: int, han: str = "run") -> DataFrame:
    """Encode both sides with the default encoder and search.

    Only document tokens of the query vocabulary are kept.
    """
    query_terms = encode_long(queries, "query_id", "query_text", "query_weight", han)
    n_terms = query_terms.count()
    occurrences = docs.select("doc_id", F.explode(tokens(text, han)).alias("term"))
    counted = count_known(occurrences, ["doc_id", "term"], query_terms.select("term").distinct(), ["term"])
    doc_terms = counted.select("doc_id", "term", F.log1p("tf").alias("doc_weight"))
    return dot_topk(query_terms, stage(doc_terms, "sparse"), k, n_terms)
