"""Approximate nearest neighbours with a recall target: lists probed up to a distance bound, vectors compared by short codes.

Every vector is stored in the list of its nearest centre as a product code of its residual: the residual is cut
into ``parts`` pieces, each replaced by the nearest of up to 256 codewords. A query goes to every list whose centre is no farther than
``reach`` times its nearest centre; there it is compared with codes through a table of distances to codewords. The best ``rerank`` of them, over
all lists, fetch their vectors and are ranked by exact distance.

``reach`` is learned: over a sample of vectors asked as queries it is the ratio that covers the lists of a ``target`` share
of their true neighbours. Centres, codewords and reach are fitted on bounded samples, every vector is indexed. Measure the recall that results with
``evaluate.per_query`` against ``vector.knn_exact``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.operators.blocks import QUERIES_PER_BLOCK, best_of, fresh, hits_schema, hits_table, numbered
from quern.operators.ranking import SCORE_DIGITS, rank_cut
from quern.operators.vector import VECTORS_PER_SLICE, _matrix, dimension_of, knn_exact, sound
from quern.session import ship_package, stage

TRAIN_ROWS = 20_000
CALIBRATION_QUERIES = 200
WORDS = 256
ROUNDS = 12


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T), 0.0)


def _k_means(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Lloyd's rounds from distinct random rows; an empty cluster keeps its centre."""
    distinct = np.unique(x, axis=0)
    centres = distinct[rng.choice(len(distinct), min(k, len(distinct)), replace=False)].copy()
    for _ in range(ROUNDS):
        nearest = _squared(x, centres).argmin(1)
        counts = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


@dataclass
class Codec:
    """Centres of the lists, codewords of each piece of a residual, and how far a query reaches."""

    centres: np.ndarray
    words: list[np.ndarray]
    cuts: np.ndarray
    reach: float = 1.0

    def lists(self, x: np.ndarray) -> np.ndarray:
        return _squared(x, self.centres).argmin(1)

    def encode(self, x: np.ndarray, cells: np.ndarray) -> np.ndarray:
        residual = x - self.centres[cells]
        return np.stack([_squared(residual[:, lo:hi], w).argmin(1) for w, lo, hi in zip(self.words, self.cuts, self.cuts[1:])], 1).astype(np.uint8)

    def estimates(self, query: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Squared distances of a query to the vectors that the codes of one list stand for."""
        residual = query - self.centres[cell]
        total = np.zeros(len(codes))
        for part, (w, lo, hi) in enumerate(zip(self.words, self.cuts, self.cuts[1:])):
            total += ((residual[lo:hi] - w) ** 2).sum(1)[codes[:, part]]
        return total

    def probes(self, queries: np.ndarray) -> list[np.ndarray]:
        """The lists each query goes to, nearest first."""
        near = np.sqrt(_squared(queries, self.centres))
        limit = near.min(1) * self.reach + 1e-9
        return [np.flatnonzero(row <= far)[np.argsort(row[row <= far], kind="stable")] for row, far in zip(near, limit)]


def _sample(vectors: DataFrame, rows: int, salt: int) -> tuple[np.ndarray, list]:
    """At most ``rows`` vectors, those of smallest hash of the id, and their ids."""
    drawn = vectors.orderBy(F.xxhash64(F.lit(salt), "doc_id"), "doc_id").limit(rows).toArrow()
    return (_matrix(drawn.column("embedding")) if drawn.num_rows else np.zeros((0, 0))), drawn.column("doc_id").to_pylist()


def train(vectors: DataFrame, n_lists: int, parts: int = 16, target: float = 0.95, k: int = 10, seed: int = 0,
          train_rows: int = TRAIN_ROWS, calibration_queries: int = CALIBRATION_QUERIES) -> Codec:
    """Centres and codewords from at most ``train_rows`` vectors, reach from ``calibration_queries`` exact searches."""
    dim = dimension_of(vectors)
    vectors = sound(vectors.select("doc_id", "embedding"), dim)
    x, _ = _sample(vectors, train_rows, seed)
    if not len(x):
        raise ValueError("no vectors to train on")
    rng = np.random.default_rng(seed)
    centres = _k_means(x, n_lists, rng)
    residual = x - centres[_squared(x, centres).argmin(1)]
    cuts = np.unique(np.linspace(0, dim, min(parts, dim) + 1).astype(int))
    codec = Codec(centres, [_k_means(residual[:, lo:hi], WORDS, rng) for lo, hi in zip(cuts, cuts[1:])], cuts)
    asked, ids = _sample(vectors, calibration_queries, seed + 1)
    kind = dict(vectors.dtypes)["doc_id"]
    queries = vectors.sparkSession.createDataFrame([(i, [float(v) for v in q]) for i, q in zip(ids, asked)], f"query_id {kind}, embedding array<double>")
    truth = knn_exact(queries, vectors, k).join(vectors, "doc_id").select("query_id", "embedding").toArrow()
    rows = {i: n for n, i in enumerate(ids)}
    which = np.array([rows[i] for i in truth.column("query_id").to_pylist()])
    near = np.sqrt(_squared(asked, centres))
    ratio = near[which, codec.lists(_matrix(truth.column("embedding")))] / np.maximum(near.min(1)[which], 1e-9)
    codec.reach = max(1.0, float(np.quantile(ratio, target, method="higher")))
    return codec


def encode(vectors: DataFrame, codec: Codec) -> DataFrame:
    """``(doc_id, cell, code)`` of every sound vector; store it partitioned by ``cell``."""
    ship_package(vectors.sparkSession)
    shared = vectors.sparkSession.sparkContext.broadcast(codec)
    rows = sound(vectors.select("doc_id", "embedding"), codec.centres.shape[1])

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = _matrix(pa.chunked_array([batch.column("embedding")]))
                cells = shared.value.lists(x)
                codes = shared.value.encode(x, cells)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(cells, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary())],
                                                 names=["doc_id", "cell", "code"])
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, cell int, code binary")


def probes(queries: DataFrame, codec: Codec) -> DataFrame:
    """``(query_id, embedding, cell)``: every query with the lists in its reach."""
    ship_package(queries.sparkSession)
    shared = queries.sparkSession.sparkContext.broadcast(codec)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                found = shared.value.probes(_matrix(pa.chunked_array([batch.column("embedding")])))
                at = pa.array(np.repeat(np.arange(batch.num_rows), [len(f) for f in found]))
                yield pa.RecordBatch.from_arrays([batch.column("query_id").take(at), batch.column("embedding").take(at),
                                                  pa.array(np.concatenate(found), pa.int32())], names=["query_id", "embedding", "cell"])
    rows = sound(queries.select("query_id", F.col("embedding").cast("array<double>").alias("embedding")), codec.centres.shape[1])
    return rows.mapInArrow(run, f"query_id {dict(rows.dtypes)['query_id']}, embedding array<double>, cell int")


def search(queries: DataFrame, codes: DataFrame, vectors: DataFrame, codec: Codec, k: int, rerank: int | None = None) -> DataFrame:
    """``hits`` with ``candidates``, how many codes a query was compared with.

    Lists are cut into slices and their queries into blocks, so a list that holds a third of all vectors, or that all queries
    probe, is searched by many tasks; a group returns at most ``rerank`` (20 k) codes per query.
    """
    rerank = rerank or 20 * k
    ship_package(codes.sparkSession)
    shared = codes.sparkSession.sparkContext.broadcast(codec)
    asked = stage(probes(queries, codec), "probes")
    sizes = codes.groupBy("cell").agg(F.count("*").alias("held")).join(asked.groupBy("cell").agg(F.count("*").alias("probing")), "cell")
    cuts = stage(sizes.select("cell", "held", F.ceil(F.col("held") / VECTORS_PER_SLICE).cast("int").alias("slices"),
                              F.ceil(F.col("probing") / QUERIES_PER_BLOCK).cast("int").alias("blocks")), "list-sizes")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    place = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    left = fresh(asked).join(cuts, "cell").select("query_id", "embedding", "cell", each("slices").alias("slice"), place("query_id", "blocks").alias("block"))
    right = fresh(codes).join(cuts, "cell").select("doc_id", "code", "cell", place("doc_id", "slices").alias("slice"), each("blocks").alias("block"))

    def compare(q: pa.Table, d: pa.Table) -> pa.Table:
        query, query_ids = numbered(q["query_id"])
        doc, doc_ids = numbered(d["doc_id"])
        parts = []
        if len(query) and len(doc):
            held = np.frombuffer(b"".join(d["code"].to_pylist()), np.uint8).reshape(len(doc), -1)
            for number, row, cell in zip(query, _matrix(q["embedding"]), q["cell"].to_numpy()):
                scores = -shared.value.estimates(row, int(cell), held)
                best = best_of(scores, doc, rerank)
                parts.append((number, doc[best], scores[best]))
        return hits_table(parts, query_ids, doc_ids)
    keys = ["cell", "slice", "block"]
    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(lambda q, d: compare(q, d), hits_schema(asked, codes))
    chosen = stage(rank_cut(near, rerank).select("query_id", "doc_id"), "rerank")
    exact = (chosen.join(vectors.select("doc_id", F.col("embedding").cast("array<double>").alias("at")), "doc_id")
             .join(queries.select("query_id", F.col("embedding").cast("array<double>").alias("from")), "query_id"))
    distance = F.aggregate(F.zip_with("at", "from", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    hits = rank_cut(exact.select("query_id", "doc_id", F.round(1 / (1 + distance), SCORE_DIGITS).alias("score")), k)
    compared = asked.join(cuts, "cell").groupBy("query_id").agg(F.sum("held").alias("candidates"))
    return hits.join(compared, "query_id")
