import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.functions import encoders, text
from quern.operators import prepare


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "t string").select(expr(F.col("t")).alias("x")).first().x


@pytest.mark.parametrize("value", [
    "", "   ", None, " a  b ", "a b", "a\tb\nc\x1cd", "　x y", " ".join(map(str, range(500))),
    " ".join(map(str, range(501))), "  " + " ".join(map(str, range(600))), "没有空格的中文"])
def test_words_match_python_split(spark, value):
    expected = (value or "").split()
    assert one(spark, value, text.words) == expected
    assert one(spark, value, text.first_words) == " ".join(expected[:500])


def test_tokens(spark):
    assert one(spark, "Hello, WORLD-2 été!", text.tokens) == ["hello", "world", "2", "été"]
    assert one(spark, "", text.tokens) == [] and one(spark, None, text.tokens) == []
    assert one(spark, "无线耳机 x1", text.tokens) == ["无线耳机", "x1"]
    assert one(spark, "无线耳机 x1", lambda c: text.tokens(c, "unigram")) == ["无", "线", "耳", "机", "x1"]
    assert sorted(one(spark, "无线耳 x1 好", lambda c: text.tokens(c, "bigram"))) == sorted(["无线", "线耳", "x1", "好"])
    with pytest.raises(ValueError):
        text.tokens("t", "other")


def test_keyword_limit(spark):
    assert one(spark, "a" * 256, text.keyword) == "a" * 256
    assert one(spark, "a" * 257, text.keyword) is None


def test_bullets(spark):
    row = [("a", None, "c", "", "e")]
    df = prepare.concat_bullets(spark.createDataFrame(row, ", ".join(f"bullet_point{i} string" for i in range(1, 6))))
    assert df.columns == ["bullets"] and df.first().bullets == "a  c  e"


@pytest.mark.parametrize("u,expected", [(0.0, "male"), (0.475, "male"), (0.4751, "female"), (0.95, "female"), (0.951, "other")])
def test_gender_thresholds(spark, u, expected):
    assert spark.range(1).select(prepare.gender_of(F.lit(u)).alias("g")).first().g == expected


def test_enrichment_ranges_and_repeatability(spark):
    docs = spark.range(3000).select(F.col("id").alias("k"), F.expr(
        "slice(array(named_struct('answer_text','a'), named_struct('answer_text','b')), 1, cast(id % 3 as int))").alias("answers"))
    rich = prepare.enrich_answers(docs, F.col("k"))
    flat = rich.select("k", F.explode("answers").alias("a")).select("k", "a.*")
    low = flat.agg(F.min("product_rating"), F.max("product_rating"), F.min("age"), F.max("age"),
                   F.min("user_lat"), F.max("user_lat"), F.count_distinct("gender")).first()
    assert low[0] == 1 and low[1] == 5 and 0 <= low[2] and low[3] <= 100 and -90 <= low[4] and low[5] <= 90 and low[6] == 3
    assert rich.where("k % 3 = 0").where(F.size("answers") != 0).count() == 0
    assert rich.exceptAll(prepare.enrich_answers(docs.repartition(7), F.col("k"))).count() == 0


def test_chunk_is_built_cut_then_tested(spark):
    rows = [(1, None, "b", "xyz"), (2, "", None, "abcd"), (3, " a  b ", "c", " d "), (4, " ".join(["w"] * 600), "b", "i"), (5, None, None, None)]
    docs = spark.createDataFrame(rows, "id int, product_description string, brand_name string, item_name string")
    kept = {r.id: r.chunk_text for r in prepare.drop_short_chunks(prepare.question_chunk(docs)).collect()}
    assert kept == {1: "b xyz", 3: "a b c d", 4: " ".join(["w"] * 500)}


def test_blank_passages(spark):
    docs = spark.createDataFrame([("a",), ("  \n",), ("",), (None,)], "passage string")
    assert [r.passage for r in prepare.drop_blank_passages(docs).collect()] == ["a"]


def test_per_source_limit(spark):
    docs = spark.createDataFrame([("x", i, "" if i < 2 else "long enough") for i in range(5)] + [("y", 9, "long enough")],
                                 "source string, n int, chunk_text string")
    kept = prepare.per_source_limit(docs, "source", ["n"], 3)
    assert sorted((r.source, r.n) for r in kept.collect()) == [("x", 0), ("x", 1), ("x", 2), ("y", 9)]
    assert sorted(r.n for r in prepare.drop_short_chunks(kept).collect()) == [2, 9]  # short rows used up the limit
    for unlimited in (0, -1):
        assert prepare.per_source_limit(docs, "source", ["n"], unlimited).count() == 6


def test_per_source_limit_cuts_before_the_exchange(spark):
    docs = spark.range(100).select((F.col("id") % 2).alias("source"), F.col("id").alias("n"))
    plan = prepare.per_source_limit(docs, "source", ["n"], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_category_filter(spark):
    docs = spark.createDataFrame([("a",), ("b",), ("c",)], "c string")
    pick = lambda wanted: sorted(r.c for r in prepare.filter_categories(docs, wanted, "c", ["a", "b", "c"]).collect())
    assert pick(["a"]) == ["a"] and pick(None) == ["a", "b", "c"] and pick(["a", "nope"]) == ["a", "b", "c"]
    assert prepare.category_names(docs.union(docs), "c").first().names == "'a', 'b', 'c'"


def test_dotted_keys(spark):
    docs = spark.createDataFrame([(1, {"a.b": 1.0, "c": 1.0}), (2, {"x": 1.0}), (3, None)], "id int, m map<string,double>")
    assert [tuple(r) for r in prepare.dotted_keys(docs, "m", "id").collect()] == [(1, "a.b")]


def test_enrichment_attributes_are_independent(spark):
    docs = spark.range(4000).select((F.col("id") * 3 + 10**17).alias("k"), F.array(F.struct(F.lit("t").alias("answer_text"), F.col("id").alias("kept"))).alias("answers"))
    rich = prepare.enrich_answers(docs, F.col("k")).select(F.inline("answers")).toPandas()
    assert rich["kept"].tolist() == list(range(4000))
    assert rich.groupby("age")["product_rating"].nunique().mean() > 4.5
    for a, b in (("age", "product_rating"), ("age", "user_lat"), ("user_lat", "user_lon")):
        assert abs(rich[a].corr(rich[b])) < 0.06


def test_an_empty_list_of_categories_means_all(spark):
    docs = spark.createDataFrame([("a",), ("b",)], "c string")
    assert prepare.filter_categories(docs, [], "c").count() == 2


@pytest.mark.parametrize("n", [30, 200, 1000])
def test_attributes_of_small_keys_are_independent(spark, n):
    keys = spark.range(1, n + 1)
    drawn = keys.select(*(prepare.uniform(F.col("id"), F.lit(0), s).alias(str(s)) for s in prepare.MODULI)).toPandas()
    apart = drawn.corr().to_numpy() - np.eye(len(prepare.MODULI))
    assert abs(apart).max() < 1.5 / n ** 0.5


def test_encoders_get_bounded_pieces_of_a_batch(spark):
    def dense():
        def run(texts):
            assert len(texts) <= encoders.ROWS_AT_ONCE
            return np.array([[float(len(t)), 1.0] for t in texts])
        return run

    def sparse():
        def run(texts):
            assert len(texts) <= encoders.ROWS_AT_ONCE
            return [{t: 1.0} for t in texts]
        return run
    docs = spark.range(0, 2 * encoders.ROWS_AT_ONCE + 7, 1, 1).selectExpr("id", "if(id % 100 = 3, null, repeat('a', int(id % 50))) AS t")
    both = encoders.sparse_encode(encoders.dense_encode(docs, {"t": "d"}, 2, dense), {"t": "s"}, sparse).collect()
    assert len(both) == 2 * encoders.ROWS_AT_ONCE + 7
    assert all(r.d == [float(len(r.t or "")), 1.0] and r.s == {r.t or "": 1.0} for r in both)
