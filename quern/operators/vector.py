"""Nearest-neighbour search: exact, and pruned by inverted lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions import encoders
from quern.operators.blocks import QUERIES_PER_BLOCK, best_of, fresh, hits_schema, hits_table, numbered, score_blocks
from quern.operators.ranking import SCORE_DIGITS, rank_cut
from quern.session import dealt, ship_package, stage
from quern.sources.encodings import EncodingStore

VECTORS_PER_SLICE = 16_384
NUMBERS_PER_BLOCK = 1 << 20  # of the vectors that a task holds of each side
PAIRS_PER_STEP = 1 << 22
CENTROID_DIGITS = 9
LISTS_PER_BLOCK = 16_384


def _sound(dim: int, column: str):
    """Whether a vector has ``dim`` numbers, none of them null or not a number."""
    holes = F.exists(column, lambda x: x.isNull() | F.isnan(x.cast("double")))
    return (F.coalesce(F.size(column), F.lit(-1)) == dim) & ~F.coalesce(holes, F.lit(False))


def sound(vectors: DataFrame, dim: int, column: str = "embedding") -> DataFrame:
    """The rows that can be searched; the others are in ``damaged``."""
    return vectors.where(_sound(dim, column))


def damaged(vectors: DataFrame, dim: int, column: str = "embedding") -> DataFrame:
    """Rows that no search can compare: null vectors, other sizes, null or not-a-number elements."""
    return vectors.where(~_sound(dim, column)).withColumn("found_dim", F.coalesce(F.size(column), F.lit(-1)).cast("bigint"))


def dimension_of(queries: DataFrame, column: str = "embedding") -> int:
    """The one dimension of the query vectors (null ones aside); 0 without any."""
    sizes = [r[0] for r in queries.where(F.col(column).isNotNull()).select(F.size(column)).distinct().limit(2).collect()]
    if len(sizes) > 1:
        raise ValueError(f"query vectors of several dimensions: {sorted(sizes)}")
    return sizes[0] if sizes else 0


def dimension_errors(vectors: DataFrame, dim: int, column: str = "embedding") -> DataFrame:
    """Rows whose vector is null or not of size ``dim``."""
    if dim <= 0:
        raise ValueError("dimension must be a positive integer")
    size = F.coalesce(F.size(column), F.lit(-1)).cast("bigint")
    return vectors.where(size != dim).withColumn("found_dim", size)


def require_dimension(vectors: DataFrame, dim: int, column: str = "embedding") -> DataFrame:
    """The same rows; the query fails when a vector has another size."""
    ok = F.coalesce(F.size(column), F.lit(-1)) == dim
    checked = F.when(ok, F.col(column)).otherwise(
        F.raise_error(F.concat(F.lit(f"expected dimension {dim}, found "), F.size(column).cast("string"))))
    return vectors.withColumn(column, checked.cast(vectors.schema[column].dataType))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), -1)


def _scores(q: np.ndarray, d: np.ndarray, digits: int) -> np.ndarray:
    """``1 / (1 + d^2)`` of every pair by one matrix product."""
    squared = (q * q).sum(1)[:, None] + (d * d).sum(1)[None, :] - 2.0 * (q @ d.T)
    return np.round(1.0 / (1.0 + np.maximum(squared, 0.0)), digits)


def _l2_kernel(k: int):
    """Best ``k`` documents per query within one group."""
    def score(queries: pa.Table, docs: pa.Table) -> pa.Table:
        query, query_ids = numbered(queries["query_id"])
        doc, doc_ids = numbered(docs["doc_id"])
        parts = []
        if len(query) and len(doc):
            for q, row in zip(query, _scores(_matrix(queries["embedding"]), _matrix(docs["embedding"]), SCORE_DIGITS)):
                best = best_of(row, doc, k)
                parts.append((q, doc[best], row[best]))
        return hits_table(parts, query_ids, doc_ids)
    return score


def _many_kernel(k: int):
    """As ``_l2_kernel``, for many queries: distances in steps of bounded size, and little work per pair beyond them.

    The ``k``-th least of the least distances of many strips of documents bounds that of all, so only the few pairs
    within it are scored and sorted.
    """
    def score(queries: pa.Table, docs: pa.Table) -> pa.Table:
        query, query_ids = numbered(queries["query_id"])
        doc, doc_ids = numbered(docs["doc_id"])
        parts = []
        if len(query) and len(doc):
            q, d = _matrix(queries["embedding"]), _matrix(docs["embedding"])
            q_norm, d_norm = (q * q).sum(1), (d * d).sum(1)
            strips = np.unique(np.linspace(0, len(d), min(len(d), max(16 * k, 256)), endpoint=False).astype(np.int64))
            rows = max(1, PAIRS_PER_STEP // len(d))
            for at in range(0, len(q), rows):
                dot = q[at:at + rows] @ d.T
                near = np.multiply(dot, -2.0)
                near += d_norm
                norm = q_norm[at:at + rows, None]
                least = np.minimum.reduceat(near, strips, axis=1) if len(strips) > k else near
                bound = np.partition(least, min(k, len(d)) - 1, axis=1)[:, min(k, len(d)) - 1:][:, :1]
                # Distances whose rounded score is that of the bound tie with it; far away, all of them may.
                worst = 1.0 / (1.0 + np.maximum(bound + norm, 0.0)) - 2.0 * 10.0 ** -SCORE_DIGITS
                limit = np.where(worst > 0.0, 1.0 / np.where(worst > 0.0, worst, 1.0) - 1.0 - norm, np.inf)
                row, col = np.nonzero(~(near > limit))
                squared = q_norm[at + row] + d_norm[col] - 2.0 * dot[row, col]
                scores = np.round(1.0 / (1.0 + np.maximum(squared, 0.0)), SCORE_DIGITS)
                order = np.lexsort((doc[col], -np.nan_to_num(scores, nan=-np.inf), row))
                row, col, scores = row[order], col[order], scores[order]
                best = np.arange(len(row)) - np.searchsorted(row, row) < k
                parts.append((query[at + row[best]], doc[col[best]], scores[best]))
        number, found, scores = (np.concatenate(c) for c in zip(*parts)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pa.table({"query_id": query_ids.take(pa.array(number)), "doc_id": doc_ids.take(pa.array(found)), "score": pa.array(scores, pa.float64())})
    return score


class _Best:
    """The best ``k`` documents of each query of a block over all batches of a task."""

    def __init__(self, n: int, k: int, ids: pa.DataType):
        self.k, self.ids = k, pa.array([], ids)
        self.found = [(np.zeros(0), np.zeros(0, np.int64))] * n

    def add(self, scores: np.ndarray, ids: pa.Array) -> None:
        number, values = numbered(pa.chunked_array([self.ids, ids]))
        old, new = number[:len(self.ids)], number[len(self.ids):]
        for q, (row, (best, docs)) in enumerate(zip(scores, self.found)):
            row, docs = np.concatenate([best, row]), np.concatenate([old[docs], new])
            top = best_of(row, docs, self.k)
            self.found[q] = row[top], docs[top]
        used, place = np.unique(np.concatenate([d for _, d in self.found]), return_inverse=True)
        ends = np.cumsum([len(d) for _, d in self.found])
        self.found = [(best, at) for (best, _), at in zip(self.found, np.split(place, ends[:-1]))]
        self.ids = values.take(pa.array(used))


def _row_blocks(rows: DataFrame, column: str, size: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and vectors of a table, ``size`` rows at a time."""
    kind = pa.string() if dict(rows.dtypes)[column] == "string" else pa.int64()
    held: list = []
    for row in rows.select(column, "embedding").toLocalIterator():
        held.append(row)
        if len(held) == size:
            yield pa.array([r[0] for r in held], kind), np.array([r[1] for r in held], dtype=np.float64)
            held = []
    if held:
        yield pa.array([r[0] for r in held], kind), np.array([r[1] for r in held], dtype=np.float64)


def _nearest_in_place(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """Score vectors where they lie: at most ``QUERIES_PER_BLOCK`` queries come to them, and a task gives ``k`` rows per query.

    The vectors are scanned once and never shuffled.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    schema = hits_schema(queries, vectors)
    blocks = list(_row_blocks(queries, "query_id", QUERIES_PER_BLOCK))
    if not blocks:
        return spark.createDataFrame([], schema)
    sent = spark.sparkContext.broadcast(blocks[0])

    def run(batches):
        ids, matrix = sent.value
        best = None
        for batch in batches:
            if batch.num_rows:
                best = best or _Best(len(ids), k, batch.column("doc_id").type)
                best.add(_scores(matrix, _matrix(pa.chunked_array([batch.column("embedding")])), SCORE_DIGITS), batch.column("doc_id"))
        if best:
            yield from hits_table([(q, docs, scores) for q, (scores, docs) in enumerate(best.found)], ids, best.ids).to_batches()
    return vectors.select("doc_id", "embedding").mapInArrow(run, schema)


def _nearest(queries: DataFrame, vectors: DataFrame, k: int, dim: int) -> DataFrame:
    """Best ``k`` vectors of every query, and more rows than that.

    One block of queries is sent to the vectors. More queries are a table like the vectors: equal ones are asked once, both are
    dealt into blocks and slices of ``NUMBERS_PER_BLOCK``, and each task scores one block against one slice, so nothing passes
    the driver and the plan is the same for any number of them. A vector then moves once per block, next to as many distances.
    """
    n = queries.count()
    if n <= QUERIES_PER_BLOCK:
        return _nearest_in_place(queries, vectors, k)
    asked = stage(dealt(queries.select("embedding"), "embedding").distinct().select(
        F.monotonically_increasing_id().alias("_asked"), "embedding"), "asked")
    size = max(QUERIES_PER_BLOCK, NUMBERS_PER_BLOCK // max(1, dim))
    found = score_blocks(asked.withColumnRenamed("_asked", "query_id"), vectors.select("doc_id", "embedding"), _many_kernel(k),
                         asked.count(), size, vectors.count(), size)
    best = rank_cut(found, k).withColumnRenamed("query_id", "_asked")
    same = queries.select("query_id", "embedding").join(asked, "embedding").select("query_id", "_asked")
    return same.join(best, "_asked").select("query_id", "doc_id", "score")


def knn_exact(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """The true ``k`` nearest vectors of every query.

    See ``_nearest`` for how they meet; a derived table of vectors should be stored before, as it is read twice. The work is queries x vectors by definition: beyond roughly 10^9 pairs use
    ``knn_ivf``; the choice is never made silently. Damaged vectors (see ``damaged``) have no distance and no rank.
    """
    dim = dimension_of(queries)
    queries, vectors = (sound(t.select(c, "embedding"), dim) for t, c in ((queries, "query_id"), (vectors, "doc_id")))
    return rank_cut(_nearest(queries, vectors, k, dim), k)


def neural_topk(queries: DataFrame, docs: DataFrame, text: str, k: int, dim: int,
                factory: encoders.DenseFactory | None = None, store: EncodingStore | None = None) -> DataFrame:
    """Nearest documents of query texts: ``docs[text]`` and ``query_text`` pass the encoder hook, then exact search.

    Both are encoded once per call and staged; with a ``store`` (then ``dim`` and ``factory`` are its own) only texts it does not hold
    are encoded, so further calls over the same corpus encode nothing.
    """
    def encoded(rows: DataFrame, key: str, column: str, label: str) -> DataFrame:
        rows = rows.select(key, column)
        rows = store.encode(rows, column, "embedding") if store else encoders.dense_encode(rows, {column: "embedding"}, dim, factory)
        return stage(rows.select(key, "embedding"), label)
    if store and store.dim != dim:
        raise ValueError(f"the store holds vectors of dimension {store.dim}, not {dim}")
    return knn_exact(encoded(queries, "query_id", "query_text", "query-vectors"), encoded(docs, "doc_id", text, "vectors"), k)


def mean_centroids(vectors: DataFrame, cell: str = "cell") -> DataFrame:
    """Mean vector of each list: ``(cell, embedding)``, from partial sums per dimension."""
    return (
        vectors.select(cell, F.posexplode("embedding").alias("position", "value"))
        .groupBy(cell, "position")
        .agg(F.avg(F.col("value").cast("double")).alias("value"))
        .groupBy(cell)
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "value"))),
                         lambda p: p["value"]).alias("embedding"))
    )


def train_centroids(vectors: DataFrame, n_lists: int, seed: int = 0, fraction: float = 1.0) -> DataFrame:
    """KMeans centroids ``(cell, embedding)`` of all vectors, or of the ``fraction`` that is asked for.

    Only the shape of the lists depends on the training rows, never which vectors are searchable.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    sample = vectors if fraction >= 1.0 else vectors.sample(fraction, seed=seed)
    train = sample.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    model = KMeans(k=n_lists, seed=seed, maxIter=20).fit(train)
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return vectors.sparkSession.createDataFrame(rows, "cell int, embedding array<double>")


def _nearest_lists(rows: DataFrame, centroids: DataFrame, k: int, keep: list[str]) -> DataFrame:
    """Each row with its ``k`` nearest lists. The centroids come to the rows in blocks, one map after the other in the same task,
    and a row carries its best lists so far.

    Distances are rounded before ranking, ties by list number.
    """
    spark = rows.sparkSession
    ship_package(spark)
    columns = list(dict.fromkeys([*keep, "embedding"]))
    schema = T.StructType([*(rows.schema[c] for c in columns), T.StructField("_cells", T.ArrayType(T.IntegerType())),
                           T.StructField("_near", T.ArrayType(T.DoubleType()))])
    carried = rows.select(*columns, F.array().cast("array<int>").alias("_cells"), F.array().cast("array<double>").alias("_near"))

    def nearer(sent):
        def run(batches):
            cells, centres = sent.value
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                scores = _scores(_matrix(pa.chunked_array([batch.column("embedding")])), centres, CENTROID_DIGITS)
                found = []
                for row, old, near in zip(scores, batch.column("_cells").to_pylist(), batch.column("_near").to_pylist()):
                    both, numbers = np.concatenate([near, row]), np.concatenate([np.array(old, np.int64), cells])
                    best = best_of(both, numbers, k)
                    found.append((numbers[best], both[best]))
                out = [batch.column(c) for c in columns] + [pa.array([c for c, _ in found], pa.list_(pa.int32())), pa.array([n for _, n in found], pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(out, names=[*columns, "_cells", "_near"])
        return run
    lists = centroids.select(F.col("cell").cast("int").alias("cell"), "embedding")
    for ids, centres in _row_blocks(lists, "cell", LISTS_PER_BLOCK):
        carried = carried.mapInArrow(nearer(spark.sparkContext.broadcast((ids.to_numpy(), centres))), schema)
    return carried.select(*keep, F.posexplode("_cells").alias("_at", "cell")).select(
        *keep, "cell", (F.col("_at") + 1).cast("bigint").alias("list_rank"))


def assign_lists(vectors: DataFrame, centroids: DataFrame) -> DataFrame:
    """Put every vector in the list of its nearest centroid: adds ``cell``. Store the result partitioned by it."""
    return _nearest_lists(vectors, centroids, 1, vectors.columns).drop("list_rank")


def rank_lists(queries: DataFrame, centroids: DataFrame, k: int) -> DataFrame:
    """The ``k`` lists nearest to every query: ``(query_id, cell, list_rank)``."""
    return _nearest_lists(queries.select("query_id", "embedding"), centroids, k, ["query_id"])


def choose_probes(ranked: DataFrame, sizes: DataFrame, n_probe: int, k: int) -> DataFrame:
    """The first ``n_probe`` lists, and further ones while fewer than ``k`` vectors are covered.

    So a query next to small lists still gets ``k`` results.
    """
    nearer = Window.partitionBy("query_id").orderBy("list_rank").rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranked.join(sizes, "cell")
        .withColumn("covered", F.coalesce(F.sum("vectors").over(nearer), F.lit(0)))
        .where((F.col("list_rank") <= n_probe) | (F.col("covered") < k))
        .select("query_id", "cell", "vectors")
    )


def _score_lists(pairs: DataFrame, vectors: DataFrame, probes: DataFrame, sizes: DataFrame, k: int) -> DataFrame:
    """Score (list, slice, query block) groups, each bounded on both sides."""
    per_list = (
        sizes.withColumn("slices", F.ceil(F.col("vectors") / VECTORS_PER_SLICE).cast("int"))
        .join(probes.groupBy("cell").agg(F.count(F.lit(1)).alias("probing")), "cell")
        .withColumn("blocks", F.ceil(F.col("probing") / QUERIES_PER_BLOCK).cast("int"))
        .select("cell", "slices", "blocks"))
    number = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    place = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    left = fresh(pairs).join(per_list, "cell").select(
        "query_id", "embedding", "cell", number("slices").alias("slice"), place("query_id", "blocks").alias("block"))
    right = fresh(vectors).join(per_list, "cell").select(
        "doc_id", "embedding", "cell", place("doc_id", "slices").alias("slice"), number("blocks").alias("block"))
    kernel, keys = _l2_kernel(k), ["cell", "slice", "block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        lambda q, d: kernel(q, d), hits_schema(pairs, vectors))


def knn_ivf(queries: DataFrame, vectors: DataFrame, centroids: DataFrame, k: int, n_probe: int,
            with_candidates: bool = False) -> DataFrame:
    """Approximate top-k: exact distances, but only in the lists nearest to each query.

    ``vectors`` carry their list in ``cell``; unprobed lists are skipped. Lists are cut into slices of bounded size,
    so a list holding a third of all vectors is searched by many tasks, and the probes of a query are copied to
    the slices of its lists. Vectors without a list, or of a list that has no centroid, are compared with every query,
    so they can be found; ``assign_lists`` gives them one. Damaged vectors (see ``damaged``) are not searched.
    With ``with_candidates`` the number of vectors compared is added, to be read beside recall.
    """
    ship_package(vectors.sparkSession)
    dim = dimension_of(queries)
    queries, vectors = sound(queries.select("query_id", "embedding"), dim), sound(vectors.select("doc_id", "embedding", "cell"), dim)
    listed = vectors.join(centroids.select("cell"), "cell", "left_semi")
    others = stage(vectors.join(centroids.select("cell"), "cell", "left_anti"), "unlisted")
    sizes = listed.groupBy("cell").agg(F.count(F.lit(1)).alias("vectors"))
    # Lists with vectors: k of them always cover k vectors, so no query needs more.
    filled = centroids.join(sizes, "cell", "left_semi")
    ranked = rank_lists(queries, filled, max(n_probe, k))
    probes = stage(choose_probes(ranked, sizes, n_probe, k), "probes")
    pairs = probes.select("query_id", "cell")
    found = _score_lists(pairs.join(queries, "query_id"), listed, probes, sizes, k)
    unlisted = others.count()
    if unlisted:
        found = found.unionByName(_nearest(queries, others, k, dim))
    hits = rank_cut(found, k)
    if with_candidates:
        compared = probes.groupBy("query_id").agg((F.sum("vectors") + unlisted).alias("candidates"))
        hits = hits.join(compared, "query_id")
    return hits


def page(candidates: DataFrame, size: int) -> DataFrame:
    """The page of ``size`` results out of the ``k`` ranked candidates."""
    return candidates.where(F.col("rank") <= size)
