"""Queries for lexical, vector, sparse and hybrid search."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quern.functions.text import first_words
from quern.operators import evaluate, fusion, lexical, multivalued, prepare, quantised, results, sparse, vector
from quern.operators.segments import SearchIndex
from quern.plans import fixtures as fx
from quern.plans import sql
from quern.plans.registry import query
from quern.session import dealt, new_folder, stage
from quern.sources import readers
from quern.sources.encodings import EncodingStore
from quern.sources.keyed import KeyedTable
from quern.streaming import questions

PASSAGE = {"passage": 1.0}
PASSAGE_FIELDS = {"passage": 2.0, "chunk_text": 1.0}
PRODUCT_FIELDS = {"item_name": 2.0, "product_description": 1.0, "brand_name": 1.0, "bullets": 1.0}
QUESTION_FIELDS = {"question_text": 4.0, "item_name": 1.0, "product_description": 1.0, "brand_name": 1.0}

_PASSAGE_BASE = (sql.PASSAGES, sql.PASSAGE_QUERIES)
_VECTOR_BASE = (sql.VECTORS, sql.QUERY_VECTORS)
_CATALOG_BASE = (sql.CATALOG, sql.CATALOG_QUERIES)


def lexical_hits(spark, d, k):
    return lexical.bm25_topk(fx.passage_queries(spark, d), fx.passages(spark, d), PASSAGE, k)


def dense_hits(spark, d, k):
    return vector.knn_exact(fx.query_vectors(spark, d), fx.vectors(spark, d), k)


def sparse_hits(spark, d, k):
    return sparse.sparse_text_topk(fx.passage_queries(spark, d), fx.passages(spark, d), "passage", k)


@query(f"""
SELECT doc_id, 'passage' AS field, token, count(*) AS tf
FROM (SELECT doc_id, unnest({sql.tokens('text')}) AS token FROM documents) GROUP BY ALL""")
def tokenise_counts(spark, d):
    return lexical.token_counts(fx.passages(spark, d), ["passage"]).select("doc_id", "field", "token", "tf")


@query(sql.with_(*_PASSAGE_BASE, sql.postings("p", "passages", ["passage"])) + """
SELECT token, count(*) AS df, sum(tf)::BIGINT AS total_tf, (SELECT count(*) FROM p_len) AS n_docs,
  (SELECT round(avg(dl), 6) FROM p_len) AS avg_length
FROM p_post GROUP BY token""")
def term_stats(spark, d):
    index = stage(lexical.build_index(fx.passages(spark, d), ["passage"]), "index")
    corpus = lexical.field_stats(lexical.lengths_of(index))
    return lexical.term_stats(index).join(F.broadcast(corpus), "field").select(
        "token", "df", "total_tf", "n_docs", F.round("avg_length", 6).alias("avg_length"))


@query(sql.with_(*_PASSAGE_BASE, sql.bm25("p", "passages", PASSAGE, "passage_queries", 5)) + "SELECT * FROM p_hits")
def bm25_match_topk(spark, d):
    return lexical_hits(spark, d, 5)


@query(sql.with_(*_CATALOG_BASE, sql.bm25("c", "catalog", PRODUCT_FIELDS, "catalog_queries", 3)) + """
SELECT query_id, rank, doc_id, score, item_name, brand_name FROM c_hits JOIN catalog USING (doc_id)""")
def bm25_multifield_topk(spark, d):
    docs = prepare.concat_bullets(fx.catalog(spark, d))
    hits = lexical.bm25_topk(fx.catalog_queries(spark, d), docs, PRODUCT_FIELDS, 3)
    return results.attach(hits, docs, "item_name", "brand_name")


@query(sql.with_(*_CATALOG_BASE, sql.bm25("c", "catalog", QUESTION_FIELDS, "catalog_queries", 5)) + """
SELECT query_id, rank, doc_id, score, 'Q: ' || question_text || chr(10) || 'A: ' || coalesce(answers[1], '') AS content
FROM c_hits JOIN catalog USING (doc_id)""")
def qna_search_topk(spark, d):
    docs = fx.catalog(spark, d)
    hits = lexical.bm25_topk(fx.catalog_queries(spark, d), docs, QUESTION_FIELDS, 5)
    return results.attach(hits, docs, "question_text", "answers").select(
        "query_id", "rank", "doc_id", "score", results.answer_content().alias("content"))


ANSWER_FIELDS = {"answers.answer_text": 2.0, "item_name": 1.0}
_ANSWERED = [sql.CATALOG, "answered AS (SELECT doc_id, item_name, answers, array_to_string(answers, chr(10)) AS answer_text FROM catalog)",
             """answer_queries AS (
  SELECT min(p_partkey) AS query_id, p_type || ' ' || p_name AS query_text FROM part GROUP BY p_type || ' ' || p_name)"""]


@query(sql.with_(*_ANSWERED, sql.bm25("c", "answered", {"answer_text": 2.0, "item_name": 1.0}, "answer_queries", 3), f"""
given AS (SELECT doc_id, unnest(answers) AS value, generate_subscripts(answers, 1) - 1 AS value_position FROM answered)""", f"""
cut AS (SELECT doc_id, value_position, value, {sql.tokens('value')} AS toks FROM given)""", """
counted AS (SELECT doc_id, value_position, value, length, token, count(*) AS tf FROM (
  SELECT doc_id, value_position, value, len(toks) AS length, unnest(toks) AS token FROM cut) GROUP BY ALL)""", """
valued AS (
  SELECT query_id, doc_id, value_position, value, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5))
    * tf / (tf + 1.2 * (1 - 0.75 + 0.75 * length / avgdl))), 6) AS value_score
  FROM c_hits JOIN c_q USING (query_id) JOIN counted USING (doc_id, token) JOIN c_df USING (token) JOIN c_stats USING (field)
  WHERE field = 'answer_text' GROUP BY ALL)""", """
best AS (SELECT * FROM valued QUALIFY row_number() OVER (PARTITION BY query_id, doc_id ORDER BY value_score DESC, value_position) = 1)""") + """
SELECT query_id, rank, doc_id, score, value_position::INT AS value_position, value, value_score
FROM c_hits LEFT JOIN best USING (query_id, doc_id)""")
def answers_search_topk(spark, d):
    """Products by what is said in any of their answers, with the answer that matches best."""
    docs = fx.catalog(spark, d)
    asked = fx.table(spark, d, "part").groupBy(F.concat_ws(" ", "p_type", "p_name").alias("query_text")).agg(F.min("p_partkey").alias("query_id"))
    return multivalued.array_topk(asked, docs, ANSWER_FIELDS, 3, "answers.answer_text")


@query(sql.with_(*_PASSAGE_BASE, sql.bm25("p", "passages", PASSAGE_FIELDS, "passage_queries", 5)) + """
SELECT query_id, rank, doc_id, score, domain, pid FROM p_hits JOIN passages USING (doc_id)""")
def passage_multifield_topk(spark, d):
    docs = prepare.passage_chunk(fx.passages(spark, d))
    hits = lexical.bm25_topk(fx.passage_queries(spark, d), docs, PASSAGE_FIELDS, 5)
    return results.attach(hits, docs, "domain", "pid")


@query(sql.with_(*_PASSAGE_BASE, sql.bm25(
    "p", "passages", PASSAGE, "passage_queries", 5,
    "doc_id IN (SELECT doc_id FROM passages WHERE domain IN ('fr', 'de'))")) + "SELECT * FROM p_hits")
def filtered_bm25_topk(spark, d):
    return lexical.bm25_topk(fx.passage_queries(spark, d), fx.passages(spark, d), PASSAGE, 5, allowed=F.col("domain").isin("fr", "de"))


@query(sql.with_(*_PASSAGE_BASE, sql.bm25(
    "p", "passages", PASSAGE, "passage_queries", 5,
    "doc_id IN (SELECT doc_id FROM passages WHERE domain IN ('fr', 'de'))")) + "SELECT * FROM p_hits")
def bm25_indexed_topk(spark, d):
    """The same search over a stored index that keeps the domain."""
    docs = fx.passages(spark, d)
    index = stage(lexical.build_index(docs, ["passage"], ["domain"]), "index")
    return lexical.bm25_topk(fx.passage_queries(spark, d), docs, PASSAGE, 5, index=index, allowed=F.col("domain").isin("fr", "de"))


@query(sql.with_("passages AS (SELECT doc_id, lang AS domain, text AS passage FROM documents WHERE lang <> 'es')", sql.PASSAGE_QUERIES,
                 sql.bm25("p", "passages", PASSAGE, "passage_queries", 5)) + "SELECT * FROM p_hits")
def segmented_search_topk(spark, d):
    """An index that grew by segments: shortened texts first, then all texts as they are, then one language removed."""
    docs = fx.passages(spark, d).select("doc_id", "domain", "passage")
    index = SearchIndex.create(spark, new_folder(spark, "segments"), docs, ["passage"], keep=["domain"], buckets=8)
    index.add(docs.where("domain <> 'fr'").withColumn("passage", first_words("passage", 40)), ["passage"])
    index.add(docs, ["passage"])
    index.delete(docs.where("domain = 'es'"))
    return index.search(fx.passage_queries(spark, d), PASSAGE, 5)


@query(sql.with_(*_VECTOR_BASE, sql.knn("v", 10)) + "SELECT * FROM v_hits")
def knn_exact_l2_topk(spark, d):
    return dense_hits(spark, d, 10)


@query(sql.with_(*_VECTOR_BASE, """sizes AS (SELECT cell, count(*) AS vectors FROM vectors GROUP BY cell)""", """
centroids AS (
  SELECT cell, list(m ORDER BY i) AS c FROM (
    SELECT cell, i, avg(e[i]) AS m FROM (SELECT cell, e, unnest(range(1, len(e) + 1)) AS i FROM vectors) GROUP BY ALL)
  GROUP BY cell)""", """
lists AS (
  SELECT query_id, cell, vectors, row_number() OVER (
    PARTITION BY query_id ORDER BY round(1 / (1 + list_distance(e, c) ** 2), 9) DESC, cell) AS list_rank
  FROM query_vectors CROSS JOIN centroids JOIN sizes USING (cell))""", """
probes AS (
  SELECT query_id, cell, vectors FROM (
    SELECT *, coalesce(sum(vectors) OVER (PARTITION BY query_id ORDER BY list_rank
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS covered FROM lists)
  WHERE list_rank <= 3 OR covered < 10)""", """
i_score AS (
  SELECT query_id, doc_id, round(1 / (1 + list_distance(q.e, v.e) ** 2), 6) AS score
  FROM probes JOIN query_vectors q USING (query_id) JOIN vectors v USING (cell))""", sql.ranked("i_hits", "i_score", 10)) + """
SELECT query_id, rank, doc_id, score, candidates FROM i_hits
JOIN (SELECT query_id, sum(vectors)::BIGINT AS candidates FROM probes GROUP BY query_id) USING (query_id)""")
def knn_ivf_topk(spark, d):
    """Lists are the labels and their centroids the label means, so that SQL can follow."""
    vectors = fx.vectors(spark, d)
    return vector.knn_ivf(fx.query_vectors(spark, d), vectors, vector.mean_centroids(vectors), 10, 3, with_candidates=True)


@query("SELECT 10 AS cutoff, count(*) AS queries, true AS reached FROM embeddings WHERE vec_id % 50 = 0")
def knn_quantised_recall(spark, d):
    """Every fiftieth vector asked of all, by codes and by exact distance; the recall between the two must reach 0.9."""
    vectors = fx.vectors(spark, d).select("doc_id", "embedding")
    asked = vectors.where("doc_id % 50 = 0").select(F.col("doc_id").alias("query_id"), "embedding")
    codec = quantised.train(vectors, n_lists=16)
    codes = stage(quantised.encode(vectors, codec), "codes")
    hits = quantised.search(asked, codes, vectors, codec, 10)
    rated = evaluate.summary(evaluate.per_query(hits, vector.knn_exact(asked, vectors, 10), [10]))
    return rated.select("cutoff", "queries", (F.col("recall") >= 0.9).alias("reached"))


@query("""
WITH hits AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS line FROM lineitem),
first AS (SELECT l_orderkey, l_partkey, min(line) AS rank FROM hits GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY rank) AS place FROM first),
judged AS (SELECT l_orderkey, l_partkey, max(CASE l_returnflag WHEN 'R' THEN 2 WHEN 'A' THEN 1 ELSE 0 END) AS grade FROM lineitem GROUP BY ALL),
relevant AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY grade DESC) AS best FROM judged WHERE grade > 0),
cutoffs(cutoff) AS (VALUES (1), (3), (5)),
possible AS (SELECT cutoff, l_orderkey, count(*) AS n, sum(CASE WHEN best <= cutoff THEN (2 ** grade - 1) / log2(best + 1) ELSE 0 END) AS ideal
  FROM relevant, cutoffs GROUP BY ALL),
found AS (SELECT cutoff, l_orderkey, count(*) AS n, min(place) AS first, sum((2 ** grade - 1) / log2(place + 1)) AS dcg
  FROM ranked JOIN relevant USING (l_orderkey, l_partkey), cutoffs WHERE place <= cutoff GROUP BY ALL)
SELECT cutoff, count(*) AS queries, round(avg(coalesce(f.n, 0) / p.n), 6) AS recall, round(avg(coalesce(1 / first, 0)), 6) AS reciprocal_rank,
  round(avg(coalesce(dcg / ideal, 0)), 6) AS ndcg
FROM possible p LEFT JOIN found f USING (cutoff, l_orderkey) GROUP BY cutoff""")
def eval_recall_mrr(spark, d):
    """Parts of each order ranked by price, against a judgement file that grades returned ones."""
    lines, path = fx.table(spark, d, "lineitem"), new_folder(spark, "judged")
    grade = F.when(F.col("l_returnflag") == "R", "2").when(F.col("l_returnflag") == "A", "1").otherwise("0")
    lines.select(F.concat_ws("\t", F.col("l_orderkey").cast("string"), F.lit("0"), F.col("l_partkey").cast("string"), grade)).write.text(path)
    judged = readers.read_qrels(spark, path, with_grade=True).select("query_id", F.col("pid").alias("doc_id"), "grade")
    lines = dealt(lines.select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice"), "l_orderkey")
    price = Window.partitionBy("l_orderkey").orderBy(F.desc("l_extendedprice"), "l_linenumber")
    first = lines.withColumn("line", F.row_number().over(price)).groupBy("l_orderkey", "l_partkey").agg(F.min("line").alias("line"))
    hits = first.select(F.col("l_orderkey").cast("string").alias("query_id"), F.col("l_partkey").cast("string").alias("doc_id"),
                        F.row_number().over(Window.partitionBy("l_orderkey").orderBy("line")).alias("rank"))
    return evaluate.summary(evaluate.per_query(hits, judged, [1, 3, 5]))


@query(sql.with_(*_VECTOR_BASE, sql.knn("v", 10)) + "SELECT * FROM v_hits WHERE rank <= 5")
def knn_candidates_then_size(spark, d):
    return vector.page(dense_hits(spark, d, 10), 5)


@query(sql.with_(*_PASSAGE_BASE, sql.neural("n", 5, 64)) + "SELECT * FROM n_hits")
def neural_topk(spark, d):
    """Texts to vectors to hits: the corpus and the questions pass the same encoder."""
    docs = prepare.passage_chunk(fx.passages(spark, d))
    return vector.neural_topk(fx.passage_queries(spark, d), docs, "chunk_text", 5, 64)


@query(sql.with_(*_PASSAGE_BASE, sql.neural("n", 5, 64)) + "SELECT * FROM n_hits")
def neural_stored_topk(spark, d):
    """The same hits over stored encodings, of which the corpus of other languages was loaded before."""
    docs = prepare.passage_chunk(fx.passages(spark, d))
    store = EncodingStore(spark, new_folder(spark, "encodings"), "hashed", 64)
    store.add(docs.where("domain <> 'fr'"), "chunk_text")
    return vector.neural_topk(fx.passage_queries(spark, d), docs, "chunk_text", 5, 64, store=store)


@query("""
WITH loads AS (
  SELECT 1 AS load, text FROM documents WHERE lang <> 'fr' UNION ALL SELECT 2, text FROM documents UNION ALL SELECT 3, text FROM documents),
firsts AS (SELECT coalesce(text, '') AS text, min(load) AS load FROM loads GROUP BY ALL)
SELECT l.load, count(*) AS texts, (SELECT count(*) FROM firsts f WHERE f.load = l.load) AS encoded, 0::BIGINT AS missing
FROM loads l GROUP BY l.load""")
def encode_once(spark, d):
    """Three loads, the last one of rows already loaded: texts, those that passed the encoder, and rows without a vector after."""
    docs = fx.passages(spark, d).select("domain", "passage")
    store, rows = EncodingStore(spark, new_folder(spark, "encodings"), "hashed", 64), []
    for load, part in enumerate((docs.where("domain <> 'fr'"), docs, docs), 1):
        added = store.add(part, "passage")
        found = store.lookup(part, "passage", "embedding").agg(
            F.count(F.lit(1)).alias("texts"), F.count_if(~F.coalesce(F.size("embedding") == 64, F.lit(False))).alias("missing"))
        rows.append(found.select(F.lit(load).alias("load"), "texts", F.lit(added).cast("bigint").alias("encoded"), "missing"))
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query(sql.with_(*_VECTOR_BASE, """
asked AS (SELECT c_custkey AS query_id, v.e FROM customer JOIN vectors v ON v.doc_id = c_custkey % (SELECT count(*) FROM vectors))""", """
a_score AS (SELECT query_id, doc_id, round(1 / (1 + list_distance(q.e, v.e) ** 2), 6) AS score FROM asked q CROSS JOIN vectors v)""",
                 sql.ranked("a_hits", "a_score", 3)) + "SELECT * FROM a_hits")
def knn_many_queries_topk(spark, d):
    """More queries than one block holds (one per customer, from 1,024 customers on)."""
    vectors = stage(fx.vectors(spark, d), "vectors")
    count = vectors.agg(F.count(F.lit(1)).alias("n"))
    asked = fx.table(spark, d, "customer").join(F.broadcast(count)).select("c_custkey", (F.col("c_custkey") % F.col("n")).alias("doc_id"))
    asked = asked.join(vectors, "doc_id").select(F.col("c_custkey").alias("query_id"), "embedding")
    return vector.knn_exact(stage(asked, "asked"), vectors, 3)


@query(sql.with_(*_PASSAGE_BASE, sql.neural("n", 10, 64), sql.bm25("p", "passages", PASSAGE, "passage_queries", 10),
                 sql.normalised("pn", "p_hits"), sql.normalised("nn", "n_hits"), sql.combined("c", "pn", "nn", 0.4, 0.6),
                 sql.ranked("h", "c", 5)) + "SELECT * FROM h")
def hybrid_text_topk(spark, d):
    """Both legs from the text of the question: its terms, and its encoding."""
    passages, asked = prepare.passage_chunk(fx.passages(spark, d)), fx.passage_queries(spark, d)
    return fusion.hybrid(lexical_hits(spark, d, 10), vector.neural_topk(asked, passages, "chunk_text", 10, 64), (0.4, 0.6), 5)


AGENT_FIELDS = {"item_name": 2.0, "product_description": 1.0, "brand_name": 1.0}


@query(sql.with_(*_CATALOG_BASE, sql.bm25("c", "catalog", AGENT_FIELDS, "catalog_queries", 5)) + """
SELECT query_id, rank, doc_id, score, item_name, question_text, brand_name FROM c_hits JOIN catalog USING (doc_id)""")
def bm25_agent_topk(spark, d):
    """The form an agent asks: three fields, five results with the fields it shows."""
    docs = fx.catalog(spark, d)
    return results.attach(lexical.bm25_topk(fx.catalog_queries(spark, d), docs, AGENT_FIELDS, 5), docs, "item_name", "question_text", "brand_name")


@query(sql.with_(*_PASSAGE_BASE, sql.bm25("p", "passages", PASSAGE, "passage_queries", 5)) + "SELECT * FROM p_hits")
def stream_questions(spark, d):
    """Questions that arrive as a file stream, in two batches, answered over a stored index."""
    docs = fx.passages(spark, d).select("doc_id", "passage")
    index = SearchIndex.create(spark, new_folder(spark, "asked-index"), docs, ["passage"], buckets=8)
    index.add(docs, ["passage"])
    inbox, answers = new_folder(spark, "questions-in"), new_folder(spark, "answers")
    asked = fx.passage_queries(spark, d)
    asked.repartition(2, "query_id").write.parquet(inbox)
    stream = spark.readStream.schema(asked.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
    questions.answer_stream(stream, index, PASSAGE, 5, answers, new_folder(spark, "questions-progress"), buckets=4).awaitTermination()
    return questions.read_answers(KeyedTable(spark, answers))


@query(sql.with_(*_PASSAGE_BASE, sql.sparse("s", 3)) + "SELECT * FROM s_hits")
def sparse_dot_topk(spark, d):
    return sparse_hits(spark, d, 3)


@query(sql.with_(*_VECTOR_BASE, sql.knn("v", 10), sql.normalised("n", "v_hits")) + """
SELECT query_id, rank, doc_id, round(score, 6) AS score FROM n""")
def minmax_normalise(spark, d):
    return fusion.min_max(dense_hits(spark, d, 10)).withColumn("score", F.round("score", 6))


@query(sql.with_(*_VECTOR_BASE, *_PASSAGE_BASE, sql.knn("v", 10), sql.sparse("s", 10), sql.combined("c", "v_hits", "s_hits", 0.4, 0.6)) + """
SELECT * FROM c""")
def weighted_combine(spark, d):
    """The combination alone, on raw scores of both legs."""
    return fusion.combine(dense_hits(spark, d, 10), sparse_hits(spark, d, 10), (0.4, 0.6))


@query(sql.with_(*_VECTOR_BASE, *_PASSAGE_BASE, sql.knn("v", 10), sql.sparse("s", 10),
                 sql.normalised("vn", "v_hits"), sql.normalised("sn", "s_hits"), sql.combined("c", "vn", "sn", 0.5, 0.5),
                 sql.ranked("h", "c", 5)) + "SELECT * FROM h")
def hybrid_dense_sparse(spark, d):
    return fusion.hybrid(dense_hits(spark, d, 10), sparse_hits(spark, d, 10), (0.5, 0.5), 5)


@query(sql.with_(*_VECTOR_BASE, *_PASSAGE_BASE, sql.knn("v", 10), sql.bm25("p", "passages", PASSAGE, "passage_queries", 10),
                 sql.normalised("pn", "p_hits"), sql.normalised("vn", "v_hits"), sql.combined("c", "pn", "vn", 0.4, 0.6),
                 sql.ranked("h", "c", 5)) + "SELECT * FROM h")
def hybrid_lexical_dense(spark, d):
    clauses = [fusion.boosted(hits, 1.0) for hits in (lexical_hits(spark, d, 10), dense_hits(spark, d, 10))]
    return fusion.hybrid(*clauses, (0.4, 0.6), 5)
