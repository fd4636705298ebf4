import numpy as np
import pytest

from quern.operators import lexical, multivalued, results


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.fixture(scope="module")
def asked(spark):
    docs = spark.createDataFrame(
        [(1, "boots", [("red boots",), ("they are warm warm",)]), (2, "warm hat", []), (3, "scarf", None),
         (4, "socks", [(None,), ("",), ("warm",), ("warm",)]), (5, "gloves", [("cold red cold",), ("warm red",)])],
        "doc_id bigint, name string, answers array<struct<answer_text: string>>")
    queries = spark.createDataFrame([(1, "warm"), (2, "red boots"), (3, "none such"), (4, "red warm")], "query_id bigint, query_text string")
    return docs, queries


FIELD = "answers.answer_text"


def test_all_values_are_one_field(spark, asked):
    docs, queries = asked
    counted = rows(lexical.token_counts(docs, [FIELD]), "doc_id", "field_length", "token", "tf")
    assert (1, 6, "warm", 2) in counted and (4, 2, "warm", 2) in counted and {r[0] for r in counted} == {1, 4, 5}
    joined = docs.selectExpr("doc_id", "name", "array_join(answers.answer_text, ' ') AS text")
    for boost in (1.0, 3.0):
        expected = rows(lexical.bm25_topk(queries, joined, {"text": boost, "name": 1.0}, 3), "query_id", "rank", "doc_id", "score")
        assert rows(lexical.bm25_topk(queries, docs, {FIELD: boost, "name": 1.0}, 3), "query_id", "rank", "doc_id", "score") == expected
    assert dict(rows(results.total_hits(queries, docs, [FIELD]), "query_id", "total_hits")) == {1: 3, 2: 2, 3: 0, 4: 3}


def test_best_value_of_each_hit(spark, asked):
    docs, queries = asked
    got = {(r.query_id, r.doc_id): (r.value_position, r.value, r.value_score)
           for r in multivalued.array_topk(queries, docs, {FIELD: 2.0, "name": 1.0}, 5, FIELD).collect()}
    lengths = [6, 2, 5]
    idf = np.log(1 + (3 - 3 + .5) / 3.5)
    score = lambda tf, n: round(idf * tf / (tf + 1.2 * (.25 + .75 * n / np.mean(lengths))), 6)
    assert got[1, 1] == (1, "they are warm warm", score(2, 4))
    assert got[1, 4] == (2, "warm", score(1, 1))  # equal values: the earlier one
    assert got[1, 2] == (None, None, None)  # found by its name only
    assert got[2, 1][:2] == (0, "red boots") and got[4, 5][:2] == (1, "warm red")
    assert not [q for q, _ in got if q == 3]


def test_fields_that_cannot_be_searched(spark, asked):
    docs, queries = asked
    with pytest.raises(ValueError):
        multivalued.array_topk(queries, docs, {"name": 1.0}, 5, FIELD)
    with pytest.raises(ValueError):
        lexical.build_index(docs, ["answers.absent"])
    nested = docs.selectExpr("doc_id", "array(answers.answer_text, array('deep')) AS lists")
    assert (3, 1, "deep", 1) in rows(lexical.token_counts(nested, ["lists"]), "doc_id", "field_length", "token", "tf")
