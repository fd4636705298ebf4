import json

import pytest
from pyspark.sql import functions as F

from quern.plans import ingest


@pytest.fixture
def corpus(tmp_path):
    for stem, n in (("jeans", 5), ("t-shirts", 2), ("led_&_lcd_tvs", 1)):
        lines = [json.dumps({"question_id": f"{stem}-{i}", "item_name": f"item {i}", "brand_name": None if i else "",
                             "product_description": "" if i == 1 else "a fine thing", "bullet_point1": "b",
                             "answers": [{"answer_text": "yes"}] * (i % 2)}) for i in range(n)]
        (tmp_path / f"amazon_pqa_{stem}.json").write_text("\n".join(lines))
    for domain in ("ecom", "video", "medical"):
        (tmp_path / domain).mkdir()
        (tmp_path / domain / "corpus.tsv").write_text(f"1\t{domain} one\n2\t  \nshort\n3\t{domain} three\n1\t{domain} again\n")
    return str(tmp_path)


def test_questions_to_table(spark, corpus, tmp_path):
    docs = ingest.questions(spark, corpus, ["jeans", "led and lcd tvs"], limit=3)
    rows = {r._id: r for r in docs.collect()}
    assert sorted(rows) == ["jeans-0", "jeans-1", "jeans-2", "led_&_lcd_tvs-0"]
    assert rows["jeans-0"].chunk_text == "a fine thing item 0" and rows["jeans-1"].chunk_text == "item 1"
    assert rows["led_&_lcd_tvs-0"].category_name == "led and lcd tvs" and rows["jeans-0"].bullets == "b    "
    assert rows["jeans-0"].answers == [] and 1 <= rows["jeans-1"].answers[0].product_rating <= 5
    both = ingest.encode(docs, dense_dim=8, sparse=True)
    report = ingest.load(both, str(tmp_path / "out"), "category_name", ["question_id"])
    assert sorted(tuple(r) for r in report.collect()) == [("TOTAL", 4), ("jeans", 3), ("led and lcd tvs", 1)]
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert stored.where(F.size("chunk_embedding") != 8).count() == 0
    assert stored.where("_id = 'jeans-1'").first().chunk_sparse_embedding.keys() == {"item", "1"}


def test_unknown_category(spark, corpus):
    with pytest.raises(ValueError, match="Unknown category name hats"):
        ingest.question_files(corpus, ["hats"])
    assert len(ingest.question_files(corpus)) == 100


def test_passages_to_table(spark, corpus, tmp_path):
    docs = ingest.passages(spark, corpus, ["ecom", "video"], limit=3)
    assert sorted((r._id, r.chunk_text) for r in docs.collect()) == [
        ("ecom_1", "ecom one"), ("ecom_3", "ecom three"), ("video_1", "video one"), ("video_3", "video three")]
    every = ingest.passages(spark, corpus, ["ecom", "nope"])
    assert {r.domain for r in every.collect()} == {"ecom", "video", "medical"}
    report = ingest.load(every, str(tmp_path / "out"), "domain", ["chunk_text"])
    assert ("TOTAL", 6) in [tuple(r) for r in report.collect()]
