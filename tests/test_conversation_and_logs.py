import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.functions import encoders
from quern.operators import conversation, jsonlog, results

SCHEMA = "user_id int, session_id int, turn bigint, role string, text string"


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_next_message_crosses_chunks_and_gaps(spark):
    turns = [0, 1, 999, 1000, 1001, 5000, 9999, 10000]
    memory = spark.createDataFrame([(1, 1, t, "user" if i % 2 == 0 else "assistant", f"m{t}") for i, t in enumerate(turns)]
                                   + [(1, 2, 3, "user", "alone")], SCHEMA)
    got = rows(conversation.next_message(memory).select("session_id", "turn", F.col("next.text").alias("n")), "session_id", "turn", "n")
    assert got == [(1, t, f"m{n}" if n is not None else None) for t, n in zip(turns, turns[1:] + [None])] + [(2, 3, None)]
    assert rows(conversation.turn_pairs(memory), "user_text", "assistant_text") == [
        ("m0", "m1"), ("m1001", "m5000"), ("m999", "m1000"), ("m9999", "m10000")]


def test_recent_and_enhanced_queries(spark):
    memory = spark.createDataFrame([(1, 1, t, "user" if t % 2 == 0 else "assistant", f"m{t}") for t in range(14)]
                                   + [(1, 2, 0, "assistant", "hi"), (1, 3, 0, "user", "only")], SCHEMA)
    latest = rows(conversation.recent(memory, 10).where("session_id = 1"), "position", "turn")
    assert latest == [(i + 1, 13 - i) for i in range(10)]
    queries = spark.createDataFrame([(q, 1, s, "q") for q, s in enumerate([1, 2, 3, 4])], "query_id int, user_id int, session_id int, query_text string")
    assert [r[1] for r in rows(conversation.enhance_queries(queries, memory), "query_id", "enhanced")] == [
        "q (Context: Previous: m12; Previous: m10)", "q", "q (Context: Previous: only)", "q"]
    assert conversation.history(memory, 2).where("session_id = 1").first().history == "user: m12\nassistant: m13"


def test_namespaces_are_kept_apart(spark):
    memory = spark.createDataFrame([(1, 1, 0, "user", "mine"), (2, 1, 1, "user", "theirs")], SCHEMA)
    assert conversation.recent(memory).count() == 2
    assert {r.position for r in conversation.recent(memory).collect()} == {1}


def test_summaries_and_appended_memory(spark, tmp_path):
    queries = spark.createDataFrame([(1,), (2,)], "query_id int")
    totals = spark.createDataFrame([(1, 40)], "query_id int, total_hits bigint")
    hits = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, None), (1, 4, "d")], "query_id int, rank bigint, item_name string")
    got = conversation.summarise(queries, totals, hits)
    assert rows(got, "query_id", "summary") == [(1, "Found 40 results. Top items: a, Unknown, c"), (2, "No results found (0 hits)")]
    done = got.select(F.lit(7).alias("user_id"), F.col("query_id").alias("session_id"), F.lit(0).alias("turn"), F.lit("q").alias("query_text"), "summary")
    for _ in range(2):
        conversation.append_interactions(done, str(tmp_path / "m"))
    assert rows(spark.read.parquet(str(tmp_path / "m")).where("session_id = 2 AND user_id = 7"), "turn", "role", "text") == [
        (0, "user", "q"), (1, "assistant", "No results found (0 hits)")]
    memory = spark.read.parquet(str(tmp_path / "m"))
    asked = spark.createDataFrame([(7, 2), (8, 2)], "user_id int, session_id int")
    assert rows(conversation.with_next_turn(asked, memory), "user_id", "turn") == [(7, 2), (8, 0)]


def test_messages_of_unknown_sessions_stay(spark):
    memory = spark.createDataFrame([(None, 1, 0, "user", "a"), (None, 1, 1, "assistant", "b"), (2, None, None, "user", "c")],
                                   "user_id int, session_id int, turn int, role string, text string")
    found = {r.text: r.next for r in conversation.next_message(memory).collect()}
    assert found["a"].text == "b" and found["b"] is None and found["c"] is None


def test_context_and_answer_text(spark):
    hits = spark.createDataFrame([(1, 2, "b", None), (1, 1, "a", "x"), (1, 11, "z", "z")], "query_id int, rank bigint, f string, g string")
    assert conversation.context(hits, ["f", "g"], 10).first().context == "f: a\ng: x\n\nf: b\ng: "
    docs = spark.createDataFrame([("q", [("a",), ("b",)]), ("r", []), (None, None)], "question_text string, answers array<struct<answer_text: string>>")
    assert [r.c for r in docs.select(results.answer_content().alias("c")).collect()] == ["Q: q\nA: a", "Q: r\nA: ", "Q: \nA: "]


def as_json(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "t string")


@pytest.mark.parametrize("raw,decoded", [
    ("5 stars", "5 stars"), ("5", "5"), ('{"a":1} x', '{"a":1} x'), ("", "[]"), ("  ", "[]"), ('{"a":\n1}', '{"a":1}'),
    ('{"a":1}\n\n{"b":2}\n', '[{"a":1},{"b":2}]'), ("1, 2", "1, 2"), ('"q"', "q"), ('{"a":1}\nplain', '{"a":1}\nplain')])
def test_decode(spark, raw, decoded):
    assert as_json(spark, raw).select(jsonlog.decode(F.col("t")).cast("string").alias("d")).first().d == decoded


def test_safe_access(spark):
    v = jsonlog.decode(F.col("t"))
    row = as_json(spark, '{"a":{"b":3},"s":"{\\"c\\":\\"d\\"}"}').select(
        jsonlog.get_or(v, "$.a.b", "int", -1).alias("b"), jsonlog.get_or(v, "$.a.x.y", "int", -1).alias("missing"),
        jsonlog.get_or(jsonlog.at(v, "$.s"), "$.c", "string", "").alias("inner")).first()
    assert tuple(row) == (3, -1, "d")


def response(*results_, name="response"):
    return json.dumps({"inference_results": [{"output": [{"name": name, "result": r} for r in results_]}]})


@pytest.mark.parametrize("text,expected", [
    (response({"output": {"message": {"content": [{"text": "hi"}]}}}), [("text", "hi")]),
    (response(json.dumps({"output": {"message": {"content": [{"other": 1}]}}})), [("text", "")]),
    (response({"output": {"message": {"content": []}}}), []),
    (response({"aggregations": {"categories": {"buckets": [{"key": "a", "doc_count": 2}, {"key": "b", "doc_count": 1}]}}}),
     [("category_aggregation", "a (2)\nb (1)")]),
    (response('{"_source":{"item_name":"i"}}\n{"_source":{}}\n{"x":1}'), [("search_results", "i\n")]),
    (response([{"x": 1}]), []),
    (response("plain text", "{broken", "", "123"), [("final_response", "plain text")]),
    (response("plain text", name="memory_id"), []),
    ("not json", []), ("{}", []), (None, [])])
def test_agent_logs(spark, text, expected):
    got = jsonlog.classify_outputs(as_json(spark, text), "t").orderBy("step", "position").collect()
    assert [(r.type, r.content) for r in got] == expected


def test_encoders(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, None), (3, "")], "id int, chunk_text string")
    dense = {r.id: r.v for r in encoders.dense_encode(docs, {"chunk_text": "v"}, 16).collect()}
    assert all(len(v) == 16 for v in dense.values()) and np.isclose(np.linalg.norm(dense[1]), 1) and not any(dense[2])
    sparse = {r.id: r.s for r in encoders.sparse_encode(docs, {"chunk_text": "s"}).collect()}
    assert np.isclose(sparse[1]["a"], np.log(3)) and sparse[2] == {} == sparse[3]
    wrong = encoders.dense_encode(docs, {"chunk_text": "v"}, 4, lambda: lambda texts: np.zeros((len(texts), 3)))
    with pytest.raises(Exception, match="expected"):
        wrong.collect()


def test_filters_on_a_vector_do_not_run_the_encoder_again(spark):
    docs = spark.createDataFrame([(1, "a b")], "id int, chunk_text string").repartition(2)
    used = encoders.dense_encode(docs, {"chunk_text": "v"}, 16).select("id", F.explode("v").alias("x")).where("x <> 0")
    assert used._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert used.count() == 2


def test_answers_come_from_the_injected_client(spark):
    prompts = spark.createDataFrame([(1, "x"), (2, None)], "query_id int, prompt string")
    got = encoders.generate_answers(prompts, lambda: lambda batch: [p.upper() for p in batch])
    assert rows(got, "query_id", "answer") == [(1, "X"), (2, "")]


def test_answer_turn_is_remembered_once(spark, tmp_path):
    memory = spark.createDataFrame([("u", "s", 0, "user", "red shoes"), ("u", "s", 1, "assistant", "Found"), (None, "s", 0, "user", "hats")],
                                   "user_id string, session_id string, turn bigint, role string, text string")
    asked = spark.createDataFrame([(1, "u", "s", "in blue"), (2, None, "s", "or caps"), (3, "v", None, "nothing")],
                                  "query_id bigint, user_id string, session_id string, query_text string")
    seen, path = [], str(tmp_path / "m")

    def search(queries):
        seen.append(dict(map(tuple, queries.collect())))
        return queries.where("query_id < 3").selectExpr("query_id", "1 AS rank", "7 AS doc_id", "0.5 AS score", "query_text AS item_name")
    for _ in range(2):
        answered = conversation.answer_turn(asked, memory, search, path)
    assert seen[0] == {1: "in blue (Context: Previous: red shoes)", 2: "or caps", 3: "nothing"}
    assert {r.query_id: r.turn for r in answered.collect()} == {1: 2, 2: 0, 3: 0}
    stored = sorted(map(tuple, spark.read.parquet(path).select("user_id", "session_id", "turn", "role", "text").collect()), key=repr)
    assert stored == sorted([("u", "s", 2, "user", "in blue"),
                             ("u", "s", 3, "assistant", "Found 1 results. Top items: in blue (Context: Previous: red shoes)"),
                             (None, "s", 0, "user", "or caps"), (None, "s", 1, "assistant", "Found 1 results. Top items: or caps"),
                             ("v", None, 0, "user", "nothing"), ("v", None, 1, "assistant", "No results found (0 hits)")], key=repr)
