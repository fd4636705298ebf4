"""The stored table with one row per key: versions, conflicts, evolution."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quern import schemas
from quern.plans import ingest
from quern.sources import sinks
from quern.sources.keyed import KeyedTable
from quern.sources.versions import VersionConflict, VersionLog

SCHEMA = "k bigint, g string, v string, ver bigint"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable.create(spark, str(tmp_path / "t"), frame(spark, []).schema, ["k", "g"], buckets=4, sort=["v"])


def test_upsert_keeps_what_is_not_replaced(spark, table):
    assert rows(table.read()) == [] and table.version == 0
    table.load(frame(spark, [(i, "a", f"old{i}", 1) for i in range(20)] + [(None, None, "null key", 1)]), ["ver"])
    table.load(frame(spark, [(3, "a", "new", 1), (3, "a", "newer", 2), (3, "b", "other", 1), (None, None, "null again", 1)]), ["ver"])
    want = [(i, "a", f"old{i}", 1) for i in range(20) if i != 3] + [(3, "a", "newer", 2), (3, "b", "other", 1), (None, None, "null again", 1)]
    assert rows(table.read()) == sorted(want, key=repr)
    assert len(rows(table.read(version=1))) == 21 and table.version == 2
    assert rows(KeyedTable(spark, table.path).read()) == sorted(want, key=repr)


def test_only_touched_buckets_are_rewritten(spark, table):
    table.load(frame(spark, [(i, "a", "x", 1) for i in range(40)]), ["ver"])
    before = dict(table._at()[1].live)
    table.load(frame(spark, [(1, "a", "y", 1)]), ["ver"])
    after, (touched,) = table._at()[1].live, table.changed_buckets(2)
    assert len(before) == 4 and [b for b in before if before[b] != after[b]] == [str(touched)]


def test_failed_load_changes_nothing(spark, table):
    table.load(frame(spark, [(1, "a", "x", 1)]), ["ver"])
    bad = frame(spark, [(1, "a", "y", 1), (2, "a", "z", 1)]).withColumn("v", F.when(F.col("k") == 2, F.raise_error(F.lit("broken row"))).otherwise(F.col("v")))
    with pytest.raises(PySparkException, match="broken row"):
        table.load(bad, ["ver"])
    with pytest.raises(schemas.SchemaConflict, match="ver: bigint stored, string incoming"):
        table.load(frame(spark, [(1, "a", "y", "1")], "k bigint, g string, v string, ver string"), ["ver"])
    with pytest.raises(schemas.SchemaConflict, match="k: bigint stored, double incoming"):
        table.load(frame(spark, [(1.0, "a", "y", 1)], "k double, g string, v string, ver bigint"), ["ver"])
    with pytest.raises(ValueError, match="without the keys"):
        table.load(frame(spark, [(1,)], "k bigint"), ["k"])
    assert rows(table.read()) == [(1, "a", "x", 1)] and table.version == 1


def test_ties_of_the_version_do_not_depend_on_order(spark):
    many = [(1, "a", f"v{i}", 7) for i in range(50)]
    got = {rows(sinks.latest_by_key(frame(spark, some).repartition(n), ["k", "g"], ["ver"]))[0] for some in (many, many[::-1]) for n in (1, 5)}
    assert len(got) == 1
    nested = spark.createDataFrame([(1, {"b": [1.0], "a": [2.0]}, 1), (1, {"a": [2.0], "b": [1.0]}, 1)], "k int, m map<string,array<double>>, ver int")
    assert sinks.latest_by_key(nested, ["k"], ["ver"]).count() == 1


def test_batches_are_applied_once(spark, table):
    assert table.load(frame(spark, [(1, "a", "x", 1)]), ["ver"], source="s", batch=0) == 1
    assert table.load(frame(spark, [(1, "a", "replayed", 1)]), ["ver"], source="s", batch=0) == 1
    assert table.load(frame(spark, [(1, "a", "y", 1)]), ["ver"], source="other", batch=0) == 2
    assert rows(table.read()) == [(1, "a", "y", 1)]


def test_delete(spark, table):
    table.load(frame(spark, [(i, "a", "x", 1) for i in range(6)] + [(None, "a", "n", 1)]), ["ver"])
    table.delete(frame(spark, [(0, "a"), (1, "b"), (99, "a"), (None, "a")], "k int, g string"))
    assert [r[0] for r in rows(table.read())] == [1, 2, 3, 4, 5]
    table.delete(table.read())
    assert table.read().count() == 0
    table.load(frame(spark, [(7, "a", "back", 1)]), ["ver"])
    assert rows(table.read()) == [(7, "a", "back", 1)]


def test_writers_side_by_side(spark, table, monkeypatch):
    table.load(frame(spark, [(i, "a", "x", 1) for i in range(40)]), ["ver"])
    other, publish, raced = KeyedTable(spark, table.path), VersionLog.publish, []

    def second(log, version, entry):
        """Another load publishes just before this one, the first two times."""
        if len(raced) < 2:
            raced.append(version)
            monkeypatch.setattr(VersionLog, "publish", publish)
            other.load(frame(spark, [(len(raced), "a", "theirs", 2)]), ["ver"])
            monkeypatch.setattr(VersionLog, "publish", second)
        publish(log, version, entry)
    monkeypatch.setattr(VersionLog, "publish", second)
    assert table.load(frame(spark, [(i, "a", "ours", 3) for i in range(2, 5)]), ["ver"]) == 4
    found = {r[0]: r[2] for r in rows(table.read())}
    assert len(found) == 40 and [found[i] for i in range(1, 6)] == ["theirs", "ours", "ours", "ours", "x"]


def test_a_version_is_published_once(spark, tmp_path):
    log = VersionLog(spark, str(tmp_path))
    assert log.latest() is None and log.versions() == []
    log.publish(0, {"a": "é"})
    with pytest.raises(VersionConflict):
        log.publish(0, {"a": 2})
    log.publish(1, {"b": [1]})
    assert log.read(0) == {"a": "é"} and log.latest() == (1, {"b": [1]}) and log.children(log.folder + "/none") == []
    assert sorted(log.children(log.folder)) == ["000000000000.json", "000000000001.json"]


def test_create_modes(spark, tmp_path, table):
    table.load(frame(spark, [(1, "a", "x", 1)]), ["ver"])
    schema = frame(spark, []).schema
    with pytest.raises(FileExistsError):
        KeyedTable.create(spark, table.path, schema, ["k"])
    kept = KeyedTable.create(spark, table.path, schema, ["k"], if_exists="keep")
    assert rows(kept.read()) == [(1, "a", "x", 1)]
    replaced = KeyedTable.create(spark, table.path, schema, ["v"], if_exists="replace")
    assert rows(replaced.read()) == [] and rows(replaced.read(version=1)) == [(1, "a", "x", 1)]
    with pytest.raises(FileNotFoundError):
        KeyedTable(spark, str(tmp_path / "absent")).read()
    assert not KeyedTable(spark, str(tmp_path / "absent")).exists()
    for wrong in ({"keys": []}, {"keys": ["zz"]}, {"keys": ["k"], "if_exists": "maybe"}):
        with pytest.raises(ValueError):
            KeyedTable.create(spark, str(tmp_path / "n"), schema, **wrong)


def test_vacuum_keeps_the_newest_versions(spark, table):
    for i in range(5):
        table.load(frame(spark, [(j, "a", f"v{i}", i) for j in range(0, 20, i + 1)]), ["ver"])
    want, before = rows(table.read()), rows(table.read(version=4))
    assert table.vacuum(keep=2) > 0
    assert rows(table.read()) == want and rows(table.read(version=4)) == before and table.log.versions() == [4, 5]
    assert table.vacuum(keep=2) == 0


def test_nested_evolution(spark, tmp_path):
    first = spark.createDataFrame([(1, [("a", 1)], {"x": (1,)}, (True,))], "k int, s array<struct<t:string,n:int>>, m map<string,struct<q:int>>, o struct<b:boolean>")
    second = spark.createDataFrame([(2, [(2.5, "b", "new")], {"y": (1, "w")}, (False, [("deep",)])), (3, None, None, None)],
                                   "k int, s array<struct<n:double,t:string,extra:string>>, m map<string,struct<q:int,r:string>>, o struct<b:boolean,c:array<struct<d:string>>>")
    table = KeyedTable.create(spark, str(tmp_path / "n"), first.schema, ["k"], buckets=2)
    table.load(first, ["k"])
    table.load(second, ["k"])
    got = {r.k: r.asDict(recursive=True) for r in table.read().collect()}
    assert got[1] == {"k": 1, "s": [{"t": "a", "n": 1.0, "extra": None}], "m": {"x": {"q": 1, "r": None}}, "o": {"b": True, "c": None}}
    assert got[2] == {"k": 2, "s": [{"t": "b", "n": 2.5, "extra": "new"}], "m": {"y": {"q": 1, "r": "w"}}, "o": {"b": False, "c": [{"d": "deep"}]}}
    assert got[3] == {"k": 3, "s": None, "m": None, "o": None}
    wrong = spark.createDataFrame([], "k int, s array<struct<t:int,n:string>>, m map<string,int>, o string")
    with pytest.raises(schemas.SchemaConflict) as found:
        table.load(wrong, ["k"])
    assert found.value.conflicts == [("s[].t", "string", "int"), ("s[].n", "double", "string"),
                                     ("m{}", "struct<q:int,r:string>", "int"), ("o", "struct<b:boolean,c:array<struct<d:string>>>", "string")]


def test_two_categories_loaded_one_after_the_other(spark, tmp_path):
    for stem in ("jeans", "wigs"):
        lines = [json.dumps({"question_id": f"{stem}{i}", "item_name": f"{stem} number {i}"}) for i in range(3)]
        (tmp_path / f"amazon_pqa_{stem}.json").write_text("\n".join(lines))
    path = str(tmp_path / "out")
    ingest.load(ingest.questions(spark, str(tmp_path), ["jeans"]), path, "category_name", ["question_id"], buckets=2)
    report = ingest.load(ingest.questions(spark, str(tmp_path), ["wigs"]), path, "category_name", ["question_id"])
    assert rows(report) == [("TOTAL", 6), ("jeans", 3), ("wigs", 3)]
    again = ingest.load(ingest.questions(spark, str(tmp_path), ["wigs"], limit=1), path, "category_name", ["question_id"])
    assert rows(again) == [("TOTAL", 6), ("jeans", 3), ("wigs", 3)]
    anew = ingest.load(ingest.questions(spark, str(tmp_path), ["wigs"], limit=1), path, "category_name", ["question_id"], mode="replace")
    assert rows(anew) == [("TOTAL", 1), ("wigs", 1)]
    with pytest.raises(ValueError, match="upsert or replace"):
        ingest.load(ingest.questions(spark, str(tmp_path), ["wigs"]), path, "category_name", ["question_id"], mode="append")


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(0, 40_000, 1, 8).selectExpr("id", "id % 7 AS v", "sha2(string(id), 256) AS t")
    table = KeyedTable.create(spark, str(tmp_path / "t"), rows.schema, ["id"], buckets=2)
    kept = {n: spark.conf.get(n) for n in ("spark.sql.adaptive.advisoryPartitionSizeInBytes",)}
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "300k")
        table.load(rows, ["v"])
    finally:
        for n, value in kept.items():
            spark.conf.set(n, value)
    files = [len(list(b.glob("*.parquet"))) for b in (tmp_path / "t" / "data").glob("*/*=*")]
    assert len(files) == 2 and min(files) > 1
    assert table.read().exceptAll(rows).count() == 0 and table.read().count() == 40_000
