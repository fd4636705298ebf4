"""Search over segments against search over the documents as they are."""

import random

import pytest
from pyspark.sql import functions as F

from quern.operators import lexical, segments
from quern.operators.segments import SearchIndex
from quern.sources.versions import VersionConflict

HITS = ("query_id", "rank", "doc_id", "score")
SCHEMA = "doc_id bigint, body string, title string, kind string, ver bigint"


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def batch(rng, ids, ver):
    def text(n):
        return " ".join(f"w{int(rng.paretovariate(0.8)) % 50}" for _ in range(n))
    return [(i, text(rng.randint(0, 20)) + " hot" * (i % 3 > 0), text(3) if i % 4 else None, "ab"[i % 2], ver) for i in ids]


@pytest.fixture(scope="module")
def queries(spark):
    rng = random.Random(1)
    asked = [(q, " ".join(f"w{rng.randint(0, 50)}" for _ in range(rng.randint(1, 6))) + " hot" * (q % 2)) for q in range(15)]
    return spark.createDataFrame([*asked, (90, ""), (91, "unseen"), (92, "hot")], "query_id bigint, query_text string")


def same_hits(spark, index, live, queries, boosts, k=6):
    docs = spark.createDataFrame(list(live.values()), SCHEMA)
    assert rows(index.search(queries, boosts, k), *HITS) == rows(lexical.bm25_topk(queries, docs, boosts, k), *HITS)


def test_segments_equal_a_rebuilt_index(spark, queries, tmp_path, monkeypatch):
    monkeypatch.setattr(segments, "HOT", 25)  # so that some terms are cut into slices
    rng, live = random.Random(4), {}
    boosts = {"body": 1.0, "title": 2.0}
    index = SearchIndex.create(spark, str(tmp_path / "i"), spark.createDataFrame([], SCHEMA), ["body", "title"], keep=["kind"], buckets=3)
    assert index.search(queries, boosts, 3).count() == 0
    for ver, ids in enumerate([range(60), range(40, 90), [5, 6, 7, 200]]):
        docs = batch(rng, ids, ver)
        index.add(spark.createDataFrame(docs + [(docs[0][0], "older version", None, "a", -1)], SCHEMA), ["ver"])
        live |= {d[0]: d for d in docs}
    same_hits(spark, index, live, queries, boosts)
    index.delete(spark.createDataFrame([(0,), (5,), (50,), (999,), (None,)], "doc_id int"))
    for gone in (0, 5, 50):
        del live[gone]
    docs = spark.createDataFrame(list(live.values()), SCHEMA)
    whole = lexical.build_index(docs, ["body", "title"])
    assert rows(index.term_stats(), "term", "df") == rows(
        lexical.document_frequency(lexical.postings_of(whole)).withColumn("term", lexical.term_key()), "term", "df")
    assert rows(index.field_stats(), "field", "n_docs", "avg_length") == rows(lexical.field_stats(lexical.lengths_of(whole)), "field", "n_docs", "avg_length")
    got = index.search(queries, boosts, 4, allowed=F.col("kind") == "a")
    assert rows(got, *HITS) == rows(lexical.bm25_topk(queries, docs, boosts, 4, allowed=F.col("kind") == "a"), *HITS)

    before = rows(index.search(queries, boosts, 6), *HITS)
    assert before == rows(lexical.bm25_topk(queries, docs, boosts, 6), *HITS) and len(index.segments()) == 4
    index._fold(*index._at(), 2)  # the two newest only: older segments still need to know what is gone
    assert len(index.segments()) == 3 and rows(index.search(queries, boosts, 6), *HITS) == before
    index.fold_all()
    assert len(index.segments()) == 1 and rows(index.search(queries, boosts, 6), *HITS) == before
    assert index.segments()[0][1] == lexical.postings_of(whole).count()
    assert index.vacuum() == 5 and rows(index.search(queries, boosts, 6), *HITS) == before
    index.add(spark.createDataFrame(batch(rng, [1, 300], 9), SCHEMA), ["ver"])
    assert len(index.segments()) == 2


def test_merges_keep_segments_few(spark, queries, tmp_path):
    rng, live = random.Random(8), {}
    index = SearchIndex.create(spark, str(tmp_path / "i"), spark.createDataFrame([], SCHEMA), ["body"], buckets=2)
    made = 0
    for ver in range(4):
        docs = batch(rng, range(ver * 10, ver * 10 + 12), ver)
        live |= {d[0]: d for d in docs}
        index.add(spark.createDataFrame(docs, SCHEMA), ["ver"])
        made += index.merge(fanout=2)
    assert made >= 1 and len(index.segments()) <= 3
    same_hits(spark, index, live, queries, {"body": 1.0})


def test_batches_once_and_writers_cut_short(spark, queries, tmp_path, monkeypatch):
    rng = random.Random(9)
    index = SearchIndex.create(spark, str(tmp_path / "i"), spark.createDataFrame([], SCHEMA), ["body"], buckets=2)
    first, second, third = (batch(rng, ids, ver) for ver, ids in enumerate([range(20), range(10, 25), range(15, 30)]))
    assert index.add(spark.createDataFrame(first, SCHEMA), ["ver"], "s", 0) == 1
    assert index.add(spark.createDataFrame(second, SCHEMA), ["ver"], "s", 0) == 1  # the same batch again
    live = {d[0]: d for d in first}

    def broken(*_):
        raise OSError("lost")
    with monkeypatch.context() as m:  # the documents are stored, the segment is not published
        m.setattr(SearchIndex, "_write", broken)
        with pytest.raises(OSError):
            index.add(spark.createDataFrame(second, SCHEMA), ["ver"], "s", 1)
    same_hits(spark, index, live, queries, {"body": 1.0})
    index.add(spark.createDataFrame(third, SCHEMA), ["ver"], "s", 1)
    live |= {d[0]: d for d in third}
    same_hits(spark, index, live, queries, {"body": 1.0})
    assert {r.doc_id for r in index.docs.read().collect()} == set(live)
    with pytest.raises(FileExistsError):
        SearchIndex.create(spark, index.path, spark.createDataFrame([], SCHEMA), ["body"])
    with pytest.raises(ValueError, match="not indexed"):
        index.search(queries, {"title": 1.0}, 3)
    with pytest.raises(FileNotFoundError):
        SearchIndex(spark, str(tmp_path / "none")).segments()
    with monkeypatch.context() as m:
        m.setattr(SearchIndex, "_at", lambda self, held=index._at(): (held[0] - 1, held[1]))
        with pytest.raises(VersionConflict):
            index.add(spark.createDataFrame(first, SCHEMA), ["ver"])


def test_text_ids(spark, tmp_path):
    docs = spark.createDataFrame([("a", "one two"), ("b", "two three")], "doc_id string, t string")
    index = SearchIndex.create(spark, str(tmp_path / "i"), docs, ["t"], buckets=2)
    index.add(docs, ["t"])
    asked = spark.createDataFrame([(1, "two three")], "query_id bigint, query_text string")
    assert rows(index.search(asked, {"t": 1.0}, 5), *HITS) == rows(lexical.bm25_topk(asked, docs, {"t": 1.0}, 5), *HITS)


def test_the_index_is_not_moved(spark, tmp_path):
    """Query terms meet the postings without an exchange on the side of the index."""
    docs = spark.createDataFrame([(i, f"w{i % 7} w{i % 5}", None, "a", 0) for i in range(50)], SCHEMA)
    index = SearchIndex.create(spark, str(tmp_path / "i"), docs, ["body"], buckets=4)
    index.add(docs, ["ver"])
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        terms = spark.createDataFrame([("body:w1",), ("body:w2",)], "term string")
        found = index.touched(terms)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == docs.where("body LIKE '%w1%'").count() + docs.where("body LIKE '%w2%'").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    lines = plan.split("\n")
    scans = [i for i, line in enumerate(lines) if "FileScan parquet" in line and "tf#" in line]
    assert len(scans) == 1 and "Bucketed: true" in lines[scans[0]]
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    above, level = [], depth(lines[scans[0]])
    for line in lines[scans[0] - 1::-1]:
        if depth(line) < level:
            above.append(line)
            level = depth(line)
    first_join = next(i for i, line in enumerate(above) if "SortMergeJoin" in line)
    assert not any("Exchange" in line for line in above[:first_join + 1])


def test_postings_move_as_lists(spark, tmp_path):
    """A task packs its postings before they move: one row per term and task, a list of equal values kept once."""
    docs = spark.createDataFrame([(i, "hot hot" + f" w{i % 7}" * (i % 3), None, "ab"[i % 2] if i % 5 else None, 0) for i in range(200)], SCHEMA).coalesce(1)
    index = SearchIndex.create(spark, str(tmp_path / "i"), docs, ["body"], keep=["kind"], buckets=4)
    index.add(docs, ["ver"])
    _, manifest = index._at()
    stored = index._rows(manifest.parts[0], manifest, segments.ROWS, False)
    tasks = spark.read.parquet(f"{index.path}/{manifest.parts[0].folder}/{segments.ROWS}").where("term = 'body:hot'").count()
    postings = sum(n for _, n in index.segments())
    assert stored.count() <= 9 * tasks < postings and stored.agg(F.sum("n")).first()[0] == postings + 200
    assert {len(r.tf) for r in stored.where("term = 'body:hot'").collect()} == {1}
    found = index.touched(spark.createDataFrame([("body:hot",)], "term string"))
    assert rows(found.na.fill("none", ["kind"]), "doc_id", "kind", "field_length", "tf") == sorted(
        (i, "ab"[i % 2] if i % 5 else "none", 2 + i % 3, 2) for i in range(200))


def test_added_texts_are_stored_once_beside_the_documents(spark, tmp_path, monkeypatch):
    """The reduced batch is staged; neither loading nor counting stages or deals out its texts again."""
    from quern.sources import keyed
    labels = []
    for module in (segments, keyed):
        monkeypatch.setattr(module, "stage", lambda df, label, *codec, held=module.stage: labels.append((label, "body" in df.columns)) or held(df, label, *codec))
    docs = spark.createDataFrame([(i, f"w{i}", None, "a", 0) for i in range(20)], SCHEMA)
    index = SearchIndex.create(spark, str(tmp_path / "i"), docs, ["body"], buckets=2)
    index.add(docs, ["ver"])
    assert [label for label, texts in labels if texts] == ["segment-docs"]
    assert {r.doc_id for r in index.docs.read().collect()} == set(range(20))
