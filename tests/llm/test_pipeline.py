"""The pipeline, stage by stage, against brute force on what its predecessor kept."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quern.llm import quality
from quern.session import stage
from test_llm_operators import components_by_hand, folded, words4

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\f\r"


@pytest.fixture(scope="module")
def kept(spark):
    """The table after each stage, run on the driver's documents with nulls, repeated rows, and a column whose name clashes."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(None, "no id " * 30, "en", None, 1), (5000, None, None, None, None), (5000, None, None, None, None), (5001, "", "en", "src0", 0)],
                                  "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = docs.unionByName(extra).unionByName(docs.limit(2)).withColumn("score", F.lit("s")).withColumn("size", F.lit(3))
    tables = [stage(docs, "input")]
    for name, function in corpus_pipeline.STAGES:
        tables.append(stage(function(spark, tables[-1], SF), "test-stage"))
    return [t.collect() for t in tables], [t.columns for t in tables]


def test_columns(kept):
    _, columns = kept
    assert all(c == columns[0] for c in columns[:5]) and columns[5] == [*columns[0], "taken"]


def test_rejected_documents_go(spark, kept):
    (docs, good, *_), _ = kept
    assert len(good) < len(docs) and not Counter(good) - Counter(docs)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if not r.toxic}
    stayed = {r.doc_id for r in good}
    known = [(i, labels[i]) for i in {r.doc_id for r in docs} if i in labels]
    assert sum((i in stayed) == bool(q) for i, q in known) / len(known) > 0.95
    assert quality.ACCEPT == 0.3


def test_frequent_lines_go(kept):
    (_, before, after, *_), _ = kept
    seen = Counter()
    for r in before:
        seen.update({folded(x.strip(SPACE)) for x in (r.text or "").split("\n")})
    want = Counter()
    for r in before:
        lines = [x for x in (r.text or "").split("\n") if not (folded(x.strip(SPACE)) and seen[folded(x.strip(SPACE))] >= 10)]
        want[r.doc_id, None if r.text is None else "\n".join(lines), r.source] += 1
    assert Counter((r.doc_id, r.text, r.source) for r in after) == want
    assert all(r.n_chars is None if r.text is None else r.n_chars == len(r.text) for r in after)


def test_one_of_each_component_stays(kept):
    (_, _, before, after, *_), _ = kept
    rows = sorted(before, key=lambda r: (r.doc_id is None, r.doc_id or 0))
    sets, comps = components_by_hand([r.text for r in rows], 5, 80)
    want = Counter((r.doc_id, r.text) for i, r in enumerate(rows) if not sets[i] or comps[i] == i)
    assert Counter((r.doc_id, r.text) for r in after) == want and len(after) < len(before)


def test_test_passages_go(spark, kept):
    (*_, before, after, _), _ = kept
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words4(r.text)
        windows |= {tuple(w[a:a + 10]) for a in range(max(1, len(w) - 9) if w else 0)}
    want, cut = Counter(), 0
    for r in before:
        w, hit = words4(r.text), set()
        for n in {len(x) for x in windows}:
            for a in range(len(w) - n + 1):
                if tuple(w[a:a + n]) in windows:
                    hit.update(range(a, a + n))
        cut += bool(hit)
        want[r.doc_id, tuple(x for i, x in enumerate(w) if i not in hit)] += 1
    assert cut and Counter((r.doc_id, tuple(words4(r.text))) for r in after) == want
    untouched = Counter((r.doc_id, r.text) for r in before) & Counter((r.doc_id, r.text) for r in after)
    assert untouched.total() == len(before) - cut


def test_mix(kept):
    (*_, before, after), _ = kept
    words = {(r.doc_id, r.text): len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in before}
    assert all(0 < r.taken <= 3 * words[r.doc_id, r.text] for r in after)
    assert sum(r.taken for r in after) == pytest.approx(sum(words.values()), rel=0.02)


def test_mix_tells_documents_without_id_apart(spark):
    """Forty texts of one size without an id: each has its own share, not the largest of all."""
    docs = spark.createDataFrame([(None, f"{i} " + "word " * 29, "en", "a", 150) for i in range(40)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    mixed = corpus_pipeline.mix_sources(spark, docs, SF).collect()
    assert sum(r.taken for r in mixed) == pytest.approx(1200, rel=0.02) and len({r.text for r in mixed}) == len(mixed)


def test_run_is_registered(spark):
    import __spark_entry__ as entry
    assert entry.queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in entry.oracle_sql()
    assert corpus_pipeline.run(spark, SF).count() > 100


def test_llm_queries_equal_their_sql(spark):
    from oracle_check import connect, difference, kinds

    import __spark_entry__ as entry
    from quern.llm import ORACLES
    con = connect(SF)
    for name in ORACLES:
        df = entry.queries()[name](spark, SF)
        assert difference(df.toPandas(), con.execute(ORACLES[name]).df()) is None, name
        assert kinds(df, con, ORACLES[name]) is None, name
