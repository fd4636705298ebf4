import csv

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern import schemas
from quern.session import stage
from quern.sources import names, readers, sinks

GOOD = '{"question_id":"q1","bullet_point1":"b","answers":[]}'


def write(path, content):
    path.write_text(content, encoding="utf-8")
    return str(path)


def test_json_lines(spark, tmp_path):
    path = write(tmp_path / "amazon_pqa_jeans.json", GOOD + '\n{"question_id":"q2","answers":[{"answer_text":"x","extra":1}],"product_description":null}\n')
    rows = {r.question_id: r for r in readers.read_json_lines(spark, path).collect()}
    assert rows["q1"].answers == [] and rows["q1"].bullet_point2 is None and rows["q1"].file_name == "amazon_pqa_jeans.json"
    assert rows["q2"].answers[0].answer_text == "x" and rows["q2"].product_description is None


def test_malformed_json_raises_or_is_quarantined(spark, tmp_path):
    path = write(tmp_path / "f.json", GOOD + "\n{broken\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_json_lines(spark, path).collect()
    good, bad = readers.split_quarantine(stage(readers.read_json_lines(spark, path, on_error="quarantine"), "t"))
    assert [r.question_id for r in good.collect()] == ["q1"]
    assert [tuple(r) for r in bad.collect()] == [("f.json", "{broken")]


def test_missing_file_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        readers.read_json_lines(spark, str(tmp_path / "nothing.json"))


def test_passages_equal_python_csv(spark, tmp_path):
    content = ('p1\tplain\np2\nonly\np3\ta\tb\np4\t\np5\t"line one\nline two"\np6\tin "ner" quotes\n'
               'p7\t"doubled ""quotes"""\np8\tback\\slash\np9\t""\np10\t lead\n')
    folder = tmp_path / "medical"
    folder.mkdir()
    path = write(folder / "corpus.tsv", content)
    with open(path, encoding="utf-8", newline="") as f:
        expected = sorted((r[0], r[1]) for r in csv.reader(f, delimiter="\t") if len(r) >= 2)
    got = readers.read_passages(spark, path).collect()
    assert sorted((r.pid, r.passage) for r in got) == expected
    assert {r.domain for r in got} == {"medical"} and all(r.chunk_text == r.passage for r in got)


def test_queries_last_row_wins(spark, tmp_path):
    path = write(tmp_path / "dev.query.txt", "1\tfirst\n2\tother\n1\tlast\n3\n")
    assert sorted(tuple(r) for r in readers.read_queries(spark, path).collect()) == [("1", "last"), ("2", "other")]


def test_qrels(spark, tmp_path):
    path = write(tmp_path / "qrels.dev.tsv", "1\t0\ta\t1\n1\t0\tb\t1\n2\t0\tc\n3\t0\td\t1\textra\n")
    assert sorted(tuple(r) for r in readers.read_qrels(spark, path).collect()) == [("1", "a"), ("1", "b"), ("3", "d")]
    assert sorted(tuple(r) for r in readers.read_qrels(spark, path, last_only=True).collect()) == [("1", "b"), ("3", "d")]


@pytest.mark.parametrize("file,constant,value", [
    ("./amazon_pqa_jeans.json", "AMAZON_PQA_JEANS", "jeans"),
    ("amazon_pqa_headlight_&_tail_light.json", "AMAZON_PQA_HEADLIGHT_AND_TAIL_LIGHT", "headlight and tail light"),
    ("amazon_pqa_in-dash_navigation.json", "AMAZON_PQA_IN_DASH_NAVIGATION", "in-dash navigation")])
def test_source_names(spark, file, constant, value):
    row = names.category_dimension(spark.createDataFrame([(file,)], "file_name string")).first()
    assert (row.constant, row.category_name) == (constant, value)


def test_category_lookup(spark):
    assert len(names.CATEGORY_FILES) == len(set(names.CATEGORY_FILES)) == 100
    dimension = names.category_dimension(spark.createDataFrame([(f,) for f in names.CATEGORY_FILES], "file_name string"))
    docs = spark.createDataFrame([("jeans",), ("t-shirts",)], "category_name string")
    assert {r.constant for r in names.lookup_category(docs, dimension).collect()} == {"AMAZON_PQA_JEANS", "AMAZON_PQA_T_SHIRTS"}
    unknown = spark.createDataFrame([("hats",)], "category_name string")
    with pytest.raises(Exception, match="Unknown category name hats"):
        names.lookup_category(unknown, dimension).collect()
    with pytest.raises(Exception, match="Valid names: .*'jeans', .*'t-shirts'"):
        names.lookup_category(unknown, dimension).collect()
    assert names.lookup_category(unknown, dimension, on_unknown="null").first().constant is None
    constants = spark.createDataFrame([("AMAZON_PQA_T_SHIRTS",), ("X",)], "constant string")
    assert {r.category_name for r in names.category_of_constant(constants, dimension).collect()} == {"t-shirts", None}


def test_source_sizes(spark, tmp_path):
    path = write(tmp_path / "a.json", "12345")
    assert tuple(readers.source_sizes(spark, path).first()) == ("a.json", 5)


def test_merge_schema():
    base = T.StructType().add("a", "string").add("s", T.StructType().add("x", "integer").add("y", "integer")).add("l", T.ArrayType(T.StructType().add("p", "integer")))
    new = T.StructType().add("s", T.StructType().add("y", "string").add("z", "integer")).add("l", T.ArrayType(T.StructType().add("q", "integer"))).add("n", "integer")
    merged = schemas.merge_schema(base, new)
    assert merged.names == ["a", "s", "l", "n"]
    assert merged["s"].dataType == T.StructType().add("x", "integer").add("y", "string").add("z", "integer")
    assert merged["l"].dataType == new["l"].dataType  # lists are replaced, not merged
    assert base["s"].dataType.names == ["x", "y"]
    assert schemas.dotted_names(T.StructType().add("a.b", "integer").add("s", T.StructType().add("c.d", "integer"))) == ["a.b", "s/c.d"]


def test_upsert_is_idempotent_and_needs_an_order(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, ver int")
    new = spark.createDataFrame([(2, "c", 0), (2, "d", 5), (3, "e", 1)], "k int, v string, ver int")
    once = sinks.upsert(old, new, ["k"], ["ver"])
    assert sorted((r.k, r.v) for r in once.collect()) == [(1, "a"), (2, "d"), (3, "e")]
    assert sinks.upsert(once, new, ["k"], ["ver"]).exceptAll(once).count() == 0
    with pytest.raises(ValueError):
        sinks.latest_by_key(old, ["k"], [])


def test_upsert_reduces_a_hot_key_before_the_exchange(spark):
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("ver"), F.col("id").cast("string").alias("v"))
    got = sinks.latest_by_key(rows, ["k"], ["ver"])
    assert got.count() == 6001 and got.where("k = -1").first().ver == 8997
    assert "partial_max_by" in got._jdf.queryExecution().executedPlan().toString()


def test_create_table_modes(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS scratch LOCATION '{tmp_path}/db'")
    read = lambda: [r.x for r in spark.table("scratch.t").collect()]
    frame = lambda x: spark.createDataFrame([(x,)], "x int")
    sinks.create_table(frame(1), "scratch.t")
    sinks.create_table(frame(2), "scratch.t")
    assert read() == [1]
    sinks.create_table(frame(3), "scratch.t", delete_existing=True)
    assert read() == [3]
    spark.sql("DROP DATABASE scratch CASCADE")


def test_partitioned_write_report_and_size(spark, tmp_path):
    docs = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "category_name string, n int")
    path = str(tmp_path / "t")
    sinks.write_partitioned(docs, path, "category_name")
    assert spark.read.parquet(path).where("category_name = 'a'").count() == 2
    stored = sinks.table_size(spark, path, "b").first().size
    assert stored > 0 and sinks.table_size(spark, path, "kb").first().size == stored // 1024
    assert sinks.table_size(spark, path + "-absent").first().size == 0
    assert sorted(tuple(r) for r in sinks.load_report(docs, "category_name").collect()) == [("TOTAL", 3), ("a", 2), ("b", 1)]


@pytest.mark.parametrize("docs,product,passage", [(1, "2 MB", "0 MB"), (511, "1022 MB", "0 MB"), (512, "1.0 GB", "0 MB"), (640, "1.2 GB", "1 MB"), (1536, "3.0 GB", "2 MB")])
def test_size_labels_follow_python_rounding(spark, docs, product, passage):
    row = sinks.size_estimate(spark.range(docs).select(F.lit("s").alias("s")), "s").first()
    mb = docs * 2
    assert row.product_estimate == product == (f"{mb} MB" if mb < 1024 else f"{mb / 1024:.1f} GB")
    assert row.passage_estimate == passage == f"{docs / 1024:.0f} MB"
