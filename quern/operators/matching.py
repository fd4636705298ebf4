"""Weighted term matching: the core of lexical and sparse search.

A query is a set of ``(term, query_weight)``, a document a set of
``(term, doc_weight)``, all weights positive; the score is the sum over shared
terms of the product.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.operators.blocks import TERMS_PER_BLOCK, best_of, hits_table, numbered, score_blocks
from quern.operators.ranking import SCORE_DIGITS, rank_cut, rounded

POSTINGS_PER_SLICE = 500_000


def count_known(occurrences: DataFrame, keys: Sequence[str], vocabulary: DataFrame, on: Sequence[str]) -> DataFrame:
    """Occurrences per key as ``tf``, of the terms in ``vocabulary`` only.

    Spark chooses the join by the vocabulary's bytes: a small one is sent to the scan, so that other terms
    never reach an exchange, and a hot term of a large one is split at run time.
    """
    return occurrences.join(vocabulary, list(on), "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("tf"))


def dot_scores(query_terms: DataFrame, doc_terms: DataFrame) -> DataFrame:
    """Score of every (query, document) pair that shares a term, as a plain join.

    Makes every pair a row; use it on small inputs and to check ``dot_topk``.
    """
    return (
        doc_terms.join(query_terms, "term")
        .groupBy("query_id", "doc_id")
        .agg(rounded(F.sum(F.col("query_weight") * F.col("doc_weight"))).alias("score"))
    )


class _Postings:
    """One slice of documents against the terms of one query block, as arrays sorted by term."""

    def __init__(self, queries: pa.Table, docs: pa.Table):
        vocabulary = pc.unique(queries["term"])
        known = pc.index_in(docs["term"], value_set=vocabulary)
        self.docs = docs.filter(pc.is_valid(known))
        term = known.drop_null().to_numpy()
        position, self.doc_ids = numbered(self.docs["doc_id"])
        self.first = np.zeros(len(self.doc_ids), dtype=np.int64)
        self.first[position[::-1]] = np.arange(len(position))[::-1]
        self.by_term = np.argsort(term, kind="stable")
        self.position = position[self.by_term]
        self.start = np.searchsorted(term[self.by_term], np.arange(len(vocabulary) + 1))
        self.vocabulary = vocabulary

    def column(self, name: str) -> np.ndarray:
        return self.docs[name].to_numpy()[self.by_term]

    def each_query(self, queries: pa.Table):
        """``(query number, term numbers, row range)`` per query of the sorted table."""
        numbers, start = np.unique(numbered(queries["query_id"])[0], return_index=True)
        term = pc.index_in(queries["term"], value_set=self.vocabulary).to_numpy()
        for q, lo, hi in zip(numbers, start, np.append(start[1:], queries.num_rows)):
            yield int(q), term[lo:hi], slice(lo, hi)

    def at(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the postings of some terms, and which of the terms each belongs to."""
        count = self.start[terms + 1] - self.start[terms]
        return np.arange(count.sum()) + np.repeat(self.start[terms] - (np.cumsum(count) - count), count), np.repeat(np.arange(len(terms)), count)


def _dot_kernel(k: int):
    def score(queries: pa.Table, docs: pa.Table) -> pa.Table:
        queries = queries.sort_by("query_id")
        postings = _Postings(queries, docs)
        weight, query_weight = postings.column("doc_weight"), queries["query_weight"].to_numpy()
        parts = []
        for q, terms, rows in postings.each_query(queries):
            at, which = postings.at(terms)
            # Only documents that hold a term are touched; repeated postings add up.
            hit, place = np.unique(postings.position[at], return_inverse=True)
            scores = np.round(np.bincount(place, query_weight[rows][which] * weight[at], len(hit)), SCORE_DIGITS)
            best = best_of(scores, hit, k)
            parts.append((q, hit[best], scores[best]))
        return hits_table(parts, numbered(queries["query_id"])[1], postings.doc_ids)
    return score


def dot_topk(query_terms: DataFrame, doc_terms: DataFrame, k: int, n_query_rows: int | None = None,
             n_postings: int | None = None) -> DataFrame:
    """Exact top-k of many queries over a table of weighted document terms.

    A term shared by most documents costs additions inside the slices, never rows
    in a join or an exchange. The two row counts size the blocks and slices; they
    are taken from the tables when the caller does not know them.
    """
    query_terms = query_terms.select("query_id", "term", F.col("query_weight").cast("double"))
    doc_terms = doc_terms.select("doc_id", "term", F.col("doc_weight").cast("double"))
    if n_query_rows is None:
        n_query_rows = query_terms.count()
    if n_postings is None:
        n_postings = doc_terms.count()
    return rank_cut(score_blocks(query_terms, doc_terms, _dot_kernel(k), n_query_rows, TERMS_PER_BLOCK,
                                 n_postings, POSTINGS_PER_SLICE), k)


def _count_kernel(queries: pa.Table, docs: pa.Table) -> pa.Table:
    queries = queries.sort_by("query_id")
    postings = _Postings(queries, docs)
    value = postings.docs["value"].combine_chunks().dictionary_encode()
    names, code = value.dictionary, value.indices.to_numpy()[postings.first]
    parts = []
    for q, terms, _ in postings.each_query(queries):
        hit = np.unique(postings.position[postings.at(terms)[0]])
        counts = np.bincount(code[hit], minlength=len(names))
        found = np.flatnonzero(counts)
        parts.append((np.full(len(found), q), found, counts[found]))
    ids, values, counts = (np.concatenate(c) for c in zip(*parts)) if parts else ([], [], [])
    query_ids = numbered(queries["query_id"])[1].take(pa.array(np.asarray(ids, dtype=np.int64)))
    return pa.table({"query_id": query_ids, "value": names.take(pa.array(values, pa.int64())),
                     "doc_count": pa.array(counts, pa.int64())})


def match_counts_by(query_terms: DataFrame, doc_terms: DataFrame, value: str | None,
                    n_query_rows: int, n_postings: int) -> DataFrame:
    """Documents per query that match any term, by ``value`` of the document when given.

    Each slice counts its matching documents per query and value, so only counts
    leave it: ``(query_id[, value], doc_count)``. A document without the value is in no bucket.
    """
    label = F.col(value).cast("string") if value else F.lit("")
    docs = doc_terms.select("doc_id", "term", label.alias("value")).where(F.col("value").isNotNull())
    counts = score_blocks(query_terms.select("query_id", "term"), docs, _count_kernel, n_query_rows,
                          TERMS_PER_BLOCK, n_postings, POSTINGS_PER_SLICE,
                          f"query_id {dict(query_terms.dtypes)['query_id']}, value string, doc_count bigint")
    keys = ["query_id", F.col("value").alias(value)] if value else ["query_id"]
    return counts.groupBy(*keys).agg(F.sum("doc_count").alias("doc_count"))
