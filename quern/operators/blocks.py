"""Blocked scoring: every task scores one slice of documents against one block of queries.

A search must in principle look at every (query, document) pair that could
match. Those pairs never become rows here: both sides are hashed into bounded
groups, a small numpy kernel scores a group, and only ``k`` rows per query and
group leave the task. Hot terms, hot lists and groups of copies are spread over
all slices because documents are placed by their id.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.session import ship_package

QUERIES_PER_BLOCK = 1024  # whole query rows, such as vectors
TERMS_PER_BLOCK = 50_000  # rows of queries that are one row per term


def group_count(rows: int, rows_per_group: int, parallelism: int) -> int:
    """Enough groups to bound each one, and to occupy the cores evenly on smaller data."""
    return max(1, math.ceil(rows / rows_per_group), min(2 * parallelism, rows // 500))


def fresh(df: DataFrame) -> DataFrame:
    """The same columns under new identities, so that both sides may stem from one table."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def bucket(col: str, n: int):
    return F.pmod(F.xxhash64(col), F.lit(n)).cast("int")


def hits_schema(queries: DataFrame, docs: DataFrame) -> str:
    """Rows ``(query_id, doc_id, score)`` with the id types of the inputs, numbers or text."""
    return f"query_id {dict(queries.dtypes)['query_id']}, doc_id {dict(docs.dtypes)['doc_id']}, score double"


def numbered(ids: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """Ids of any type as numbers in the order of the ids, and the ids by number."""
    coded = ids.combine_chunks().dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.arange(len(order))
    return number[coded.indices.to_numpy()], coded.dictionary.take(pa.array(order))


def score_blocks(queries: DataFrame, docs: DataFrame, kernel: Callable[[pa.Table, pa.Table], pa.Table],
                 n_query_rows: int, rows_per_block: int, n_doc_rows: int, rows_per_slice: int,
                 schema: str | None = None) -> DataFrame:
    """Run ``kernel(queries, docs)`` on every (document slice, query block).

    All rows of a query share a block and all rows of a document share a slice.

    Documents are copied once per query block and queries once per slice, so the
    exchange moves ``docs * blocks + queries * slices`` rows.
    """
    ship_package(docs.sparkSession)
    blocks = max(1, math.ceil(n_query_rows / rows_per_block))
    slices = group_count(n_doc_rows, rows_per_slice, docs.sparkSession.sparkContext.defaultParallelism)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries, docs = fresh(queries), fresh(docs)
    left = queries.withColumn("block", bucket("query_id", blocks)).withColumn("slice", every(slices))
    right = docs.withColumn("slice", bucket("doc_id", slices)).withColumn("block", every(blocks))
    return (
        left.groupBy("slice", "block")
        .cogroup(right.groupBy("slice", "block"))
        .applyInArrow(lambda q, d: kernel(q, d), schema or hits_schema(queries, docs))
    )


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best scores, ties by id; what is not a number ranks last."""
    scores = np.nan_to_num(scores, nan=-np.inf)
    if len(scores) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = np.flatnonzero(scores >= kth)
    else:
        keep = np.arange(len(scores))
    return keep[np.lexsort((ids[keep], -scores[keep]))[:k]]


def hits_table(parts: list[tuple[int, np.ndarray, np.ndarray]], queries: pa.Array, docs: pa.Array) -> pa.Table:
    """Hits of numbered queries and documents under their ids."""
    q = np.concatenate([np.full(len(d), n, dtype=np.int64) for n, d, _ in parts]) if parts else np.zeros(0, np.int64)
    d = np.concatenate([d for _, d, _ in parts]) if parts else np.zeros(0, np.int64)
    scores = np.concatenate([s for _, _, s in parts]) if parts else np.zeros(0)
    return pa.table({"query_id": queries.take(pa.array(q)), "doc_id": docs.take(pa.array(d)), "score": pa.array(scores, pa.float64())})
