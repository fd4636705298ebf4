"""Rank metrics by hand, and code search against exact search."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.operators import evaluate, quantised, vector


def by_hand(hits, judged, cutoffs):
    grades = {}
    for q, d, g in judged:
        if d is not None and g is not None:
            grades.setdefault(q, {})[d] = max(g, grades.get(q, {}).get(d, 0))
    out = []
    for q, docs in grades.items():
        docs = {d: g for d, g in docs.items() if g > 0}
        if not docs:
            continue
        first = {}
        for hq, d, r in hits:
            if hq == q:
                first[d] = min(r, first.get(d, r))
        for k in cutoffs:
            found = {d: r for d, r in first.items() if d in docs and r <= k}
            dcg = sum((2 ** docs[d] - 1) / math.log2(r + 1) for d, r in found.items())
            ideal = sum((2 ** g - 1) / math.log2(i + 2) for i, g in enumerate(sorted(docs.values(), reverse=True)[:k]))
            out.append((q, k, len(found) / len(docs), 1 / min(found.values()) if found else 0.0, dcg / ideal))
    return sorted(out)


def test_metrics_by_hand(spark):
    rng = random.Random(2)
    hits = [(q, rng.randint(0, 30), r) for q in range(20) for r in range(1, rng.randint(2, 15))] + [(77, 1, 1)]
    judged = [(q, rng.randint(0, 30), rng.randint(0, 3)) for q in range(5, 25) for _ in range(6)] + [(99, 1, 1), (98, 1, 0), (97, None, 2), (5, 1, None)]
    got = evaluate.per_query(spark.createDataFrame(hits, "query_id int, doc_id int, rank int"),
                             spark.createDataFrame(judged, "query_id int, doc_id int, grade int"), [1, 3, 10])
    want = by_hand(hits, judged, [1, 3, 10])
    found = sorted((r.query_id, r.cutoff, r.recall, r.reciprocal_rank, r.ndcg) for r in got.collect())
    assert [f[:2] for f in found] == [w[:2] for w in want] and np.allclose([f[2:] for f in found], [w[2:] for w in want])
    means = {r.cutoff: r for r in evaluate.summary(got).collect()}
    assert means[3].queries == len(want) // 3 and means[3].recall == pytest.approx(np.mean([w[2] for w in want if w[1] == 3]), abs=1e-6)
    plain = spark.createDataFrame([(1, 2), (1, 2)], "query_id int, doc_id int")
    assert [tuple(r) for r in evaluate.per_query(spark.createDataFrame([(1, 2, 2)], "query_id int, doc_id int, rank int"), plain, [2]).collect()] == [
        (1, 2, 1.0, 0.5, pytest.approx(1 / math.log2(3)))]
    with pytest.raises(ValueError):
        evaluate.per_query(plain, plain, [])


@pytest.fixture(scope="module")
def cloud(spark):
    """Clusters of many sizes, one of them a third of all vectors; copies, and rows that cannot be searched."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(12, 16)) * 2
    which = np.where(rng.random(1500) < 0.33, 0, rng.integers(0, 12, 1500))
    data = centres[which] + rng.normal(size=(1500, 16))
    data[1] = data[0]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)] + [(9000, None), (9001, [1.0]), (9002, [float("nan")] * 16)]
    vectors = spark.createDataFrame(rows, "doc_id bigint, embedding array<double>")
    return vectors.where("doc_id < 9000"), vectors, vectors.where("doc_id % 25 = 0 AND doc_id < 9000").select(F.col("doc_id").alias("query_id"), "embedding")


@pytest.mark.parametrize("parts,lists", [(8, 12), (16, 40)])
def test_recall_reaches_its_target(spark, cloud, parts, lists):
    sound, vectors, queries = cloud
    codec = quantised.train(sound, lists, parts, target=0.95)
    codes = quantised.encode(vectors, codec).cache()
    assert codes.count() == 1500 and codes.where(F.length("code") != len(codec.words)).count() == 0
    hits = quantised.search(queries, codes, sound, codec, 10).cache()
    exact = vector.knn_exact(queries, vectors, 10)
    assert evaluate.summary(evaluate.per_query(hits, exact, [10])).first().recall >= 0.9
    assert hits.agg(F.avg("candidates")).first()[0] < 1300  # and not by looking at everything
    scores = {(r.query_id, r.doc_id): r.score for r in exact.collect()}
    assert all(scores.get((r.query_id, r.doc_id), r.score) == r.score for r in hits.collect())


def test_whole_reach_and_rerank_are_exact(spark, cloud, monkeypatch):
    sound, vectors, queries = cloud
    codec = quantised.train(sound, 6, 8, train_rows=300, calibration_queries=20)
    codec.reach = 1e9
    monkeypatch.setattr(quantised, "VECTORS_PER_SLICE", 200)
    monkeypatch.setattr(quantised, "QUERIES_PER_BLOCK", 7)
    hits = quantised.search(queries, quantised.encode(vectors, codec), sound, codec, 5, rerank=1500)
    columns = ["query_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, hits.select(*columns).collect())) == sorted(map(tuple, vector.knn_exact(queries, vectors, 5).select(*columns).collect()))
    assert {r.candidates for r in hits.collect()} == {1500}


def test_codes_by_hand(spark, cloud):
    sound, _, queries = cloud
    codec = quantised.train(sound, 5, 4, train_rows=200, calibration_queries=10)
    x = np.array([r.embedding for r in sound.limit(30).collect()])
    cells = codec.lists(x)
    assert list(cells) == [int(((codec.centres - v) ** 2).sum(1).argmin()) for v in x]
    codes = codec.encode(x, cells)
    rebuilt = np.array([np.concatenate([codec.centres[c][lo:hi] + w[code[p]] for p, (w, lo, hi) in enumerate(zip(codec.words, codec.cuts, codec.cuts[1:]))])
                        for c, code in zip(cells, codes)])
    query = x[0] + 1
    for cell in set(cells):
        assert np.allclose(codec.estimates(query, cell, codes[cells == cell]), ((rebuilt[cells == cell] - query) ** 2).sum(1))
    with pytest.raises(ValueError):
        quantised.train(sound.limit(0), 3)


def test_judgements_are_rated_in_the_partitions_of_the_session(spark):
    """However small they are on disk; Spark would join partitions by their compressed bytes."""
    judged = spark.range(0, 100, 1, 1).selectExpr("id % 10 AS query_id", "id AS doc_id")
    rated = evaluate.per_query(judged.selectExpr("*", "1 + doc_id % 3 AS rank"), judged, [3])
    assert rated._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM") >= 2
    assert rated.count() == 10
