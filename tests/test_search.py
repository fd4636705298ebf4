import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quern.operators import fusion, lexical, matching, results, sparse, vector
from quern.operators.blocks import group_count
from quern.operators.ranking import rank_cut


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


HITS = ("query_id", "rank", "doc_id", "score")


@pytest.fixture(scope="module")
def skewed(spark):
    """A term in every third document, and a third of the documents being copies of one text."""
    rng = random.Random(5)
    docs = []
    for i in range(900):
        words = [f"w{int(rng.paretovariate(0.8)) % 60}" for _ in range(rng.randint(1, 25))]
        if i % 3 == 0:
            words.append("hot")
        if i % 3 == 1:
            words = ["hot", "copy", "w1", "w1", "rare"]
        docs.append((i, " ".join(words), rng.choice("abc")))
    queries = [(q, " ".join(f"w{rng.randint(0, 60)}" for _ in range(rng.randint(1, 6))) + " hot" * (q % 2)) for q in range(40)]
    queries += [(100, "copy rare hot"), (101, ""), (102, "unseen"), (103, "hot hot hot")]
    return (spark.createDataFrame(docs, "doc_id bigint, body string, kind string"),
            spark.createDataFrame(queries, "query_id bigint, query_text string"))


def brute_bm25(queries, docs, boosts, k):
    terms = lexical.query_terms(queries, boosts)
    index = lexical.build_index(docs, list(boosts))
    postings, stats = lexical.postings_of(index), lexical.field_stats(lexical.lengths_of(index))
    weights = lexical.saturation(postings, stats).withColumn("term", lexical.term_key())
    return rank_cut(matching.dot_scores(lexical.with_idf(terms, postings, stats), weights.select("doc_id", "term", "doc_weight")), k)


def test_bm25_equals_all_pairs(spark, skewed, monkeypatch):
    docs, queries = skewed
    for boosts in ({"body": 1.0}, {"body": 2.0, "kind": 1.5}):
        expected = rows(brute_bm25(queries, docs, boosts, 7), *HITS)
        assert rows(lexical.bm25_topk(queries, docs, boosts, 7), *HITS) == expected
        monkeypatch.setattr(matching, "TERMS_PER_BLOCK", 30)
        monkeypatch.setattr(matching, "POSTINGS_PER_SLICE", 300)
        assert rows(lexical.bm25_topk(queries, docs, boosts, 7), *HITS) == expected
        monkeypatch.undo()
    assert {r[0] for r in expected}.isdisjoint({101, 102})


def test_bm25_by_hand(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a a a b c d"), (3, "z")], "doc_id bigint, t string")
    q = spark.createDataFrame([(1, "A a!")], "query_id bigint, query_text string")
    idf, avg = np.log(1 + (3 - 2 + .5) / 2.5), 3.0
    score = lambda tf, dl: round(idf * tf / (tf + 1.2 * (.25 + .75 * dl / avg)), 6)
    assert rows(lexical.bm25_topk(q, docs, {"t": 1.0}, 5), "rank", "doc_id", "score") == [(1, 2, score(3, 6)), (2, 1, score(1, 2))]
    assert rows(lexical.bm25_topk(q, docs, {"t": 1.0, "absent": 9.0}, 1), "doc_id") == [(2,)]
    with pytest.raises(ValueError):
        lexical.build_index(docs, ["absent"])


def test_stored_index_gives_the_same_hits(spark, skewed, tmp_path):
    docs, queries = skewed
    lexical.build_index(docs, ["body", "kind"]).write.partitionBy("field").parquet(str(tmp_path / "i"))
    index = spark.read.parquet(str(tmp_path / "i"))
    assert rows(lexical.bm25_topk(queries, docs, {"body": 1.0}, 5, index=index), *HITS) == rows(lexical.bm25_topk(queries, docs, {"body": 1.0}, 5), *HITS)


def test_filter_keeps_corpus_statistics(spark, skewed):
    docs, queries = skewed
    allowed = docs.where("kind = 'a'")
    got = lexical.bm25_topk(queries, docs, {"body": 1.0}, 5, allowed=allowed)
    every = brute_bm25(queries, docs, {"body": 1.0}, 10_000).join(allowed.select("doc_id"), "doc_id").drop("rank")
    assert rows(got, *HITS) == rows(rank_cut(every, 5), *HITS)


def test_counts_and_facets_equal_all_pairs(spark, skewed):
    docs, queries = skewed
    terms = lexical.query_terms(queries, {"body": 1.0})
    counted = lexical.token_counts(docs, ["body"], ["kind"]).withColumn("term", lexical.term_key())
    pairs = terms.join(counted, "term").select("query_id", "doc_id", "kind").distinct()
    expected = rows(pairs.groupBy("query_id", "kind").agg(F.count("*").alias("n")), "query_id", "kind", "n")
    facets = results.facet(queries, docs, ["body", "absent"], "kind")
    assert rows(facets, "query_id", "kind", "doc_count") == expected
    totals = dict(rows(results.total_hits(queries, docs, ["body"]), "query_id", "total_hits"))
    assert totals[101] == totals[102] == 0 and totals[103] == 600
    assert {q: n for q, n in totals.items() if n} == dict(rows(pairs.groupBy("query_id").agg(F.count("*").alias("n")), "query_id", "n"))


def test_facet_order_and_size(spark):
    docs = spark.createDataFrame([(i, "x", f"c{i % 12:02}") for i in range(30)], "doc_id bigint, t string, cat string")
    q = spark.createDataFrame([(1, "x")], "query_id bigint, query_text string")
    got = rows(results.facet(q, docs, ["t"], "cat", 10), "position", "cat", "doc_count")
    assert got == [(i + 1, f"c{i:02}", 3 if i < 6 else 2) for i in range(10)]
    assert results.facet_lines(results.facet(q, docs, ["t"], "cat", 2), "cat").first().lines == "c00 (3)\nc01 (3)"
    assert results.facet_map(results.facet(q, docs, ["t"], "cat", 2), "cat").first().facet == {"c00": 3, "c01": 3}


@pytest.fixture(scope="module")
def cloud(spark):
    """Vectors with a list holding a third of them, a tie and a tiny list."""
    rng = np.random.default_rng(3)
    data = rng.normal(size=(600, 8))
    data[1] = data[0]
    cells = [0 if i % 3 == 0 else 1 + i % 7 for i in range(600)]
    cells[5], data[5] = 99, 50.0
    vectors = spark.createDataFrame([(i, [float(x) for x in v], c) for i, (v, c) in enumerate(zip(data, cells))],
                                    "doc_id bigint, embedding array<double>, cell int")
    queries = vectors.where("doc_id % 20 = 0 OR doc_id = 5").select(F.col("doc_id").alias("query_id"), "embedding")
    return data, vectors, queries


def test_exact_knn(spark, cloud, monkeypatch):
    data, vectors, queries = cloud
    got = rows(vector.knn_exact(queries, vectors, 6), *HITS)
    for q in {r[0] for r in got}:
        score = np.round(1 / (1 + ((data - data[q]) ** 2).sum(1)), 6)
        best = sorted(range(len(data)), key=lambda i: (-score[i], i))[:6]
        assert [(r[2], r[3]) for r in got if r[0] == q] == [(i, score[i]) for i in best]
    assert [r[2] for r in got if r[0] == 0][:2] == [0, 1]
    monkeypatch.setattr(vector, "QUERIES_PER_BLOCK", 7)
    monkeypatch.setattr(vector, "VECTORS_PER_SLICE", 40)
    assert rows(vector.knn_exact(queries, vectors, 6), *HITS) == got


def test_ivf(spark, cloud, monkeypatch):
    _, vectors, queries = cloud
    centroids = vector.mean_centroids(vectors)
    exact = rows(vector.knn_exact(queries, vectors, 5), *HITS)
    assert rows(vector.knn_ivf(queries, vectors, centroids, 5, 100), *HITS) == exact
    some = vector.knn_ivf(queries, vectors, centroids, 5, 2, with_candidates=True)
    got = rows(some, *HITS)
    assert len(got) == len(exact)  # the query beside the one-vector list is filled up from further lists
    true_score = {(r[0], r[2]): r[3] for r in rows(vector.knn_exact(queries, vectors, 600), *HITS)}
    assert all(true_score[q, doc] == s for q, _, doc, s in got)
    recall = len({(r[0], r[2]) for r in got} & {(r[0], r[2]) for r in exact}) / len(exact)
    share = some.select("query_id", "candidates").distinct().agg(F.avg("candidates")).first()[0] / 600
    print(f"recall {recall:.3f} with {share:.3f} of the vectors compared")
    assert recall > share
    monkeypatch.setattr(vector, "QUERIES_PER_BLOCK", 7)
    monkeypatch.setattr(vector, "VECTORS_PER_SLICE", 40)
    assert rows(vector.knn_ivf(queries, vectors, centroids, 5, 2), *HITS) == got


def test_trained_lists(spark, cloud):
    _, vectors, queries = cloud
    plain = vectors.drop("cell")
    centroids = vector.train_centroids(plain, 8, seed=1)
    listed = vector.assign_lists(plain, centroids)
    assert listed.count() == 600 and set(listed.columns) == {"doc_id", "embedding", "cell"}
    assert rows(vector.knn_ivf(queries, listed, centroids, 5, 8), *HITS) == rows(vector.knn_exact(queries, vectors, 5), *HITS)


def test_dimension_checks(spark):
    v = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0]), (3, None)], "doc_id int, embedding array<double>")
    assert rows(vector.dimension_errors(v, 2), "doc_id", "found_dim") == [(2, 1), (3, -1)]
    with pytest.raises(Exception, match="expected dimension 2"):
        vector.require_dimension(v.where("doc_id < 3"), 2).collect()
    with pytest.raises(ValueError):
        vector.dimension_errors(v, 0)


def test_sparse_maps_and_text_agree(spark, skewed, monkeypatch):
    docs, queries = skewed
    long = sparse.encode_long(docs, "doc_id", "body", "doc_weight")
    q = sparse.encode_long(queries, "query_id", "query_text", "query_weight")
    expected = rows(rank_cut(matching.dot_scores(q, long), 4), *HITS)
    assert rows(sparse.sparse_text_topk(queries, docs, "body", 4), *HITS) == expected
    assert rows(sparse.sparse_text_topk(queries, docs, "body", 4), *HITS) == expected
    assert rows(sparse.sparse_topk(q, long, 4), *HITS) == expected
    back = sparse.from_map(sparse.to_map(long, "doc_id", "doc_weight"), "doc_id", "doc_weight")
    assert back.count() == long.count()


def leg(spark, *hits):
    return spark.createDataFrame([(q, i + 1, d, float(s)) for i, (q, d, s) in enumerate(hits)],
                                 "query_id bigint, rank bigint, doc_id bigint, score double")


def test_fusion(spark):
    a = leg(spark, (1, 10, 4.0), (1, 11, 2.0), (1, 12, 3.0), (2, 20, 7.0))
    b = leg(spark, (1, 12, 0.5), (1, 13, 0.1), (3, 30, 1.0))
    assert rows(fusion.min_max(a), "doc_id", "score") == [(10, 1.0), (11, 0.0), (12, 0.5), (20, 1.0)]
    got = rows(fusion.hybrid(a, b, (0.4, 0.6), 10), *HITS)
    assert got == [(1, 1, 12, 0.8), (1, 2, 10, 0.4), (1, 3, 11, 0.0), (1, 4, 13, 0.0), (2, 1, 20, 0.4), (3, 1, 30, 0.6)]
    assert [r[2] for r in rows(fusion.hybrid(a, b, (0.4, 0.6), 1), *HITS)] == [12, 20, 30]
    assert rows(fusion.hybrid(a, b.limit(0), (1, 1), 9), "doc_id", "score") == [(10, 0.5), (11, 0.0), (12, 0.25), (20, 0.5)]


def test_compare_keeps_best_rank(spark):
    schema = "query_id bigint, rank bigint, t string"
    a = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (1, 3, "x"), (1, 4, "z")], schema)
    b = spark.createDataFrame([(1, 1, "y")], schema)
    assert rows(results.compare(a, b, "t", ("a", "b")), "position", "a", "b") == [(1, "x", "y"), (2, "y", None), (3, "z", None)]


def test_damaged_vectors_are_left_out_and_reported(spark):
    good = [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0])]
    bad = [(4, None), (5, [1.0]), (6, [1.0, 2.0, 3.0]), (7, [float("nan"), 0.0]), (8, [None, 1.0])]
    vectors = spark.createDataFrame(good + bad, "doc_id int, embedding array<double>")
    queries = spark.createDataFrame([(1, [0.0, 0.0]), (9, None)], "query_id bigint, embedding array<double>")
    assert [r[2] for r in rows(vector.knn_exact(queries, vectors, 5), *HITS)] == [1, 2, 3]
    assert rows(vector.damaged(vectors, 2), "doc_id", "found_dim") == [(4, -1), (5, 1), (6, 3), (7, 2), (8, 2)]
    listed = vectors.withColumn("cell", F.lit(0))
    assert [r[2] for r in rows(vector.knn_ivf(queries, listed, vector.mean_centroids(listed.where("doc_id < 4")), 5, 1), *HITS)] == [1, 2, 3]
    mixed = spark.createDataFrame([(1, [0.0]), (2, [0.0, 1.0])], "query_id bigint, embedding array<double>")
    with pytest.raises(ValueError, match="several dimensions"):
        vector.knn_exact(mixed, vectors, 1)
    assert vector.knn_exact(queries.limit(0), vectors, 3).count() == 0


def test_vectors_without_a_list_are_found(spark):
    vectors = spark.createDataFrame([(1, [0.0, 0.0], 0), (2, [0.1, 0.0], None), (3, [0.2, 0.0], 77), (4, [5.0, 5.0], 1)],
                                    "doc_id bigint, embedding array<double>, cell int")
    queries = spark.createDataFrame([(1, [0.0, 0.0])], "query_id bigint, embedding array<double>")
    centroids = vector.mean_centroids(vectors.where("cell < 2"))
    found = vector.knn_ivf(queries, vectors, centroids, 4, 2, with_candidates=True)
    assert [r[2] for r in rows(found, *HITS)] == [1, 2, 3, 4] and found.first()["candidates"] == 4


def test_lists_come_in_blocks(spark, cloud, monkeypatch):
    _, vectors, _ = cloud
    plain, centroids = vectors.drop("cell"), vector.mean_centroids(vectors)
    expected = rows(vector.assign_lists(plain, centroids), "doc_id", "cell")
    monkeypatch.setattr(vector, "LISTS_PER_BLOCK", 3)
    assert rows(vector.assign_lists(plain, centroids), "doc_id", "cell") == expected


def test_not_a_number_ranks_last():
    from quern.operators.blocks import best_of
    assert list(best_of(np.array([np.nan, 1.0, 2.0, np.nan]), np.arange(4), 3)) == [2, 1, 0]


def test_repeated_and_zero_postings_count(spark):
    terms = spark.createDataFrame([("q", "a", 1.0), ("q", "b", 0.0)], "query_id string, term string, query_weight double")
    docs = spark.createDataFrame([("x", "a", 1.0), ("x", "a", 1.0), ("y", "a", 1.5), ("z", "b", 3.0)], "doc_id string, term string, doc_weight double")
    expected = rows(rank_cut(matching.dot_scores(terms, docs), 5), *HITS)
    assert [r[2:] for r in expected] == [("x", 2.0), ("y", 1.5), ("z", 0.0)]
    assert rows(matching.dot_topk(terms, docs, 5), *HITS) == expected


def test_text_ids_end_to_end(spark):
    docs = spark.createDataFrame([("d2", "red shoe", "a"), ("d10", "red shoe", None), ("d1", "blue hat", "")], "doc_id string, t string, c string")
    queries = spark.createDataFrame([("a1", "red"), ("b", "hat shoe")], "query_id string, query_text string")
    found = rows(lexical.bm25_topk(queries, docs, {"t": 1.0}, 2), *HITS)
    assert [(r[0], r[2]) for r in found] == [("a1", "d10"), ("a1", "d2"), ("b", "d1"), ("b", "d10")]
    assert rows(results.facet(queries, docs, ["t"], "c"), "query_id", "c", "doc_count") == [("a1", "a", 1), ("b", "", 1), ("b", "a", 1)]
    vectors = spark.createDataFrame([("v2", [0.0, 1.0]), ("v10", [0.0, 1.0]), ("v", [9.0, 9.0])], "doc_id string, embedding array<double>")
    asked = vectors.where("doc_id = 'v2'").select(F.col("doc_id").alias("query_id"), "embedding")
    assert [r[2] for r in rows(vector.knn_exact(asked, vectors, 2), *HITS)] == ["v10", "v2"]


def test_unknown_fields_are_reported(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id bigint, t string")
    queries = spark.createDataFrame([(1, "x")], "query_id bigint, query_text string")
    with pytest.warns(UserWarning, match="missing"):
        assert lexical.bm25_topk(queries, docs, {"t": 1.0, "missing": 2.0}, 3).count() == 1


def test_no_posting_is_joined_by_its_token(spark, skewed):
    docs, queries = skewed
    plan = lexical.bm25_topk(queries, docs, {"body": 1.0}, 3)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert not any("tf" in line for line in joins)


def test_equal_questions_are_asked_once_in_blocks(spark, monkeypatch):
    sizes = []
    blocks = vector.score_blocks
    monkeypatch.setattr(vector, "score_blocks", lambda *a: (sizes.append((a[3], a[4])), blocks(*a))[1])
    docs = spark.createDataFrame([(i, [float(i % 40), 0.5]) for i in range(120)], "doc_id long, embedding array<float>")
    asked = spark.range(1500).selectExpr("id AS query_id", "array(float(id % 50), float(0)) AS embedding")
    found = {}
    for r in vector.knn_exact(asked, docs, 3).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.doc_id, r.score))
    assert sizes == [(50, vector.NUMBERS_PER_BLOCK // 2)]
    for q in range(1500):
        score = [(-round(1 / (1 + (q % 50 - i % 40) ** 2 + 0.25), 6), i) for i in range(120)]
        assert sorted(found[q]) == [(n, i, -s) for n, (s, i) in enumerate(sorted(score)[:3], 1)]


def test_many_kernel_equals_the_plain_one():
    r = np.random.default_rng(5)
    for n, m, dim, k, far in ((200, 400, 3, 5, 1.0), (30, 4, 2, 10, 1.0), (40, 700, 4, 3, 3000.0)):
        docs = r.integers(-3, 4, (m, dim)).astype(np.float32) * far
        q = pa.table({"query_id": list(range(n)), "embedding": list(r.integers(-3, 4, (n, dim)).astype(np.float32) * far)})
        d = pa.table({"doc_id": [f"d{i}" for i in r.permutation(m)], "embedding": list(docs)})
        order = [("query_id", "ascending"), ("score", "descending"), ("doc_id", "ascending")]
        assert vector._many_kernel(k)(q, d).sort_by(order).equals(vector._l2_kernel(k)(q, d).sort_by(order))


def test_tokens_are_counted_after_documents_are_dealt_out(spark):
    """One task of a scan would otherwise count all tokens of a table that is small on disk."""
    docs = spark.range(0, 50, 1, 1).selectExpr("id % 40 AS doc_id", "concat('red box ', id, ' red') AS t", "'unused' AS other")
    counted = lexical.token_counts(docs, ["t"])
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Exchange") and plan.count("Exchange") == 1 and "other" not in plan
    assert {(r.doc_id, r.token): r.tf for r in counted.collect()}[3, "red"] == 4


def test_slices_of_postings_are_small_enough_for_a_worker():
    assert group_count(50_000_000, matching.POSTINGS_PER_SLICE, 12) >= 100
