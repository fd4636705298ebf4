from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.plans import corpus
from quern.streaming import incremental

SCHEMA = T.StructType().add("id", "string").add("text", "string").add("version", "long")


def test_incremental_load(spark, tmp_path):
    inbox, table, progress = (str(tmp_path / n) for n in ("in", "table", "progress"))
    (tmp_path / "in").mkdir()

    def arrive(name, *docs):
        (tmp_path / "in" / name).write_text("\n".join(docs))

    def load():
        stream = incremental.json_stream(spark, inbox, SCHEMA, files_per_batch=1)
        query = incremental.incremental_load(stream, lambda df: df.withColumn("text", F.upper("text")), table, progress, ["id"], ["version"])
        query.awaitTermination()
        rows = incremental.read_current(spark, table, SCHEMA, ["id"], ["version"]).collect()
        return {r.id: r.text for r in rows}

    arrive("1.json", '{"id":"a","text":"one","version":1}', '{"id":"a","text":"two","version":2}', '{"id":"b","text":"x","version":1}')
    assert load() == {"a": "TWO", "b": "X"}
    assert load() == {"a": "TWO", "b": "X"}  # restart from the checkpoint, nothing new
    arrive("2.json", '{"id":"a","text":"two","version":2}')  # the same content again
    arrive("3.json", '{"id":"b","text":"y","version":1}', '{"id":"c","text":"z","version":1}')
    assert load() == {"a": "TWO", "b": "Y", "c": "Z"}

    folded = str(tmp_path / "folded")
    incremental.compact(spark, table, folded, SCHEMA, ["id"], ["version"])
    rows = incremental.read_current(spark, folded, SCHEMA, ["id"], ["version"]).collect()
    assert {r.id: r.text for r in rows} == {"a": "TWO", "b": "Y", "c": "Z"}


def test_a_new_checkpoint_or_stream_keeps_stored_rows(spark, tmp_path):
    inbox, table = tmp_path / "in", str(tmp_path / "table")
    inbox.mkdir()

    def load(progress):
        stream = incremental.json_stream(spark, str(inbox), SCHEMA)
        incremental.incremental_load(stream, lambda df: df, table, str(tmp_path / progress), ["id"], ["version"]).awaitTermination()
        return {r.id: r.text for r in incremental.read_current(spark, table, SCHEMA, ["id"], ["version"]).collect()}

    (inbox / "1.json").write_text('{"id":"a","text":"one","version":1}')
    assert load("p0") == {"a": "one"}
    assert load("p1") == {"a": "one"}  # the checkpoint is lost and the file loaded again
    (inbox / "1.json").unlink()  # archived
    (inbox / "2.json").write_text('{"id":"b","text":"two","version":1}')
    assert load("p2") == {"a": "one", "b": "two"}
    (inbox / "3.json").write_text('{"id":"a","text":"new","version":1}')
    assert load("p0") == {"a": "new", "b": "two"}


def test_a_table_streams_as_one_file_or_as_many(spark, tmp_path):
    schema = T.StructType().add("doc_id", "long").add("text", "string").add("lang", "string").add("source", "string").add("n_chars", "long")
    rows = [(i, f"some text number {i}", "en", "web", 18) for i in range(20)]
    for name, some in (("parts", rows), ("one", rows), ("none", [])):
        (tmp_path / name).mkdir()
        docs = spark.createDataFrame(some, schema)
        if name == "one":
            docs.toPandas().to_parquet(tmp_path / name / "documents.parquet", index=False)
        elif name == "parts":
            docs.repartition(3).write.parquet(str(tmp_path / name / "documents.parquet"))
        else:
            docs.coalesce(1).write.parquet(str(tmp_path / name / "documents.parquet"))
        found = corpus.stream_incremental_load(spark, str(tmp_path / name)).collect()
        assert {r.doc_id: r.chunk_text for r in found} == {i: t for i, t, *_ in some}


def test_a_load_of_an_empty_folder_is_an_empty_table(spark, tmp_path):
    (tmp_path / "in").mkdir()
    table = str(tmp_path / "table")
    stream = incremental.json_stream(spark, str(tmp_path / "in"), SCHEMA)
    incremental.incremental_load(stream, lambda df: df, table, str(tmp_path / "p"), ["id"], ["version"]).awaitTermination()
    assert incremental.read_current(spark, table, SCHEMA, ["id"], ["version"]).collect() == []


def test_arrivals_are_numbered_by_the_log(spark, tmp_path):
    log = incremental.VersionLog(spark, str(tmp_path))
    taken = [incremental.arrival(log, *b) for b in [("s", 0), ("t", 0), ("s", 1), ("s", 1), ("t", 0), ("t", 1), ("u", 0)]]
    assert taken == [1, 2, 3, 3, 2, 4, 5]


def test_arrivals_of_two_writers_differ(spark, tmp_path, monkeypatch):
    log, publish, raced = incremental.VersionLog(spark, str(tmp_path)), incremental.VersionLog.publish, []

    def late(self, version, entry):
        if not raced:
            raced.append(1)
            assert incremental.arrival(log, "other", 0) == 1
        publish(self, version, entry)
    monkeypatch.setattr(incremental.VersionLog, "publish", late)
    assert incremental.arrival(log, "slow", 0) == 2
