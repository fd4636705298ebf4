"""Queries for facets, comparison, formatting, conversation memory and prompt tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import encoders
from quern.functions.text import preview
from quern.operators import conversation, lexical, prepare, results, vector
from quern.plans import fixtures as fx
from quern.plans import search, sql
from quern.plans.registry import query
from quern.session import new_folder, stage

FACET_FIELDS = ["item_name", "question", "product_description", "brand_name"]
PASSAGE_FACET_FIELDS = ["passage", "chunk_text"]
SYSTEM_PROMPT = "You answer questions about products and passages."
INSTRUCTIONS = "Answer from the context below in a few sentences. Say so when the context does not tell."


def _matches(p: str, docs: str, fields: list[str], queries: str) -> str:
    """Distinct matching (query, document) pairs as CTE ``{p}_match``."""
    return f"""{sql.postings(p, docs, fields)},
{sql.query_tokens(p + '_q', queries)},
{p}_match AS (SELECT DISTINCT query_id, doc_id FROM {p}_q JOIN {p}_post USING (token))"""


def _facet(p: str, docs: str, key: str) -> str:
    return f"""{p}_facet AS (
  SELECT query_id, position, {key}, doc_count FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY doc_count DESC, {key}) AS position FROM (
      SELECT query_id, {key}, count(*) AS doc_count FROM {p}_match JOIN {docs} USING (doc_id) GROUP BY ALL))
  WHERE position <= 10)"""


_CATALOG_FACET = sql.with_(sql.CATALOG, sql.CATALOG_QUERIES, _matches(
    "c", "catalog", ["item_name", "product_description", "brand_name"], "catalog_queries"), _facet("c", "catalog", "category_name"))
_PASSAGE_MATCH = _matches("p", "passages", PASSAGE_FACET_FIELDS, "passage_queries")


def _category_facet(spark, d):
    return results.facet(fx.catalog_queries(spark, d), fx.catalog(spark, d), FACET_FIELDS, "category_name")


@query(_CATALOG_FACET + "SELECT * FROM c_facet")
def facet_category_top10(spark, d):
    return _category_facet(spark, d)


@query(sql.with_(sql.PASSAGES, sql.PASSAGE_QUERIES, _PASSAGE_MATCH, _facet("p", "passages", "domain")) + "SELECT * FROM p_facet")
def facet_domain(spark, d):
    return results.facet(fx.passage_queries(spark, d), prepare.passage_chunk(fx.passages(spark, d)), PASSAGE_FACET_FIELDS, "domain")


@query(_CATALOG_FACET + """
SELECT query_id, string_agg(category_name || ' (' || doc_count || ')', chr(10) ORDER BY position) AS lines
FROM c_facet GROUP BY query_id""")
def facet_lines(spark, d):
    return results.facet_lines(_category_facet(spark, d), "category_name")


@query(_CATALOG_FACET + """
SELECT query_id, string_agg(category_name || '=' || doc_count, ',' ORDER BY position) AS entries
FROM c_facet GROUP BY query_id""")
def facet_as_map(spark, d):
    facets = results.facet_map(_category_facet(spark, d), "category_name")
    entries = F.transform(F.map_entries("facet"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return facets.select("query_id", F.array_join(entries, ",").alias("entries"))


@query(sql.with_(sql.PASSAGES, sql.PASSAGE_QUERIES, _matches("p", "passages", ["passage"], "passage_queries")) + """
SELECT query_id, count(doc_id) AS total_hits FROM passage_queries LEFT JOIN p_match USING (query_id) GROUP BY query_id""")
def total_hits(spark, d):
    return results.total_hits(fx.passage_queries(spark, d), fx.passages(spark, d), ["passage"])


def _distinct(p: str, hits: str, name: str) -> str:
    return f"""{p}_texts AS (
  SELECT query_id, position, passage AS {name} FROM (
    SELECT query_id, passage, row_number() OVER (PARTITION BY query_id ORDER BY min(rank)) AS position
    FROM {hits} JOIN passages USING (doc_id) GROUP BY query_id, passage) WHERE position <= 10)"""


@query(sql.with_(sql.VECTORS, sql.QUERY_VECTORS, sql.PASSAGES, sql.PASSAGE_QUERIES, sql.knn("v", 50),
                 sql.bm25("p", "passages", search.PASSAGE, "passage_queries", 50),
                 _distinct("v", "v_hits", "dense"), _distinct("p", "p_hits", "lexical")) + """
SELECT query_id, position, dense, lexical FROM v_texts FULL OUTER JOIN p_texts USING (query_id, position)""")
def compare_dense_lexical(spark, d):
    passages = fx.passages(spark, d)
    return results.compare_hits(stage(search.dense_hits(spark, d, 50), "dense-leg"), stage(search.lexical_hits(spark, d, 50), "lexical-leg"),
                                passages, "passage", ("dense", "lexical"))


@query(sql.with_(sql.VECTORS, sql.QUERY_VECTORS, sql.PASSAGES, sql.PASSAGE_QUERIES, sql.CATALOG, sql.CATALOG_QUERIES,
                 sql.knn("v", 5), sql.bm25("p", "passages", search.PASSAGE, "passage_queries", 5),
                 sql.bm25("c", "catalog", search.QUESTION_FIELDS, "catalog_queries", 5)) + """
SELECT query_id, rank, doc_id, chunk_text AS content, score, domain AS name, doc_id::VARCHAR AS id, 'semantic_search' AS source
FROM v_hits JOIN passages USING (doc_id)
UNION ALL SELECT query_id, rank, doc_id, chunk_text, score, domain, doc_id::VARCHAR, 'lexical_search'
FROM p_hits JOIN passages USING (doc_id)
UNION ALL SELECT query_id, rank, doc_id, 'Q: ' || question_text || chr(10) || 'A: ' || coalesce(answers[1], ''), score,
  item_name, doc_id::VARCHAR, 'qna_search' FROM c_hits JOIN catalog USING (doc_id)""")
def union_tool_results(spark, d):
    passages, catalog = fx.passages(spark, d), fx.catalog(spark, d)
    about = {"name": F.col("domain"), "id": F.col("doc_id")}
    with_chunk = lambda hits: prepare.passage_chunk(results.attach(hits, passages, "passage", "domain"))
    semantic = results.tag(with_chunk(search.dense_hits(spark, d, 5)), "semantic_search", F.col("chunk_text"), about)
    lexical_side = results.tag(with_chunk(search.lexical_hits(spark, d, 5)), "lexical_search", F.col("chunk_text"), about)
    qna = results.attach(lexical.bm25_topk(fx.catalog_queries(spark, d), catalog, search.QUESTION_FIELDS, 5),
                         catalog, "question_text", "answers", "item_name")
    qna = results.tag(qna, "qna_search", results.answer_content(), {"name": F.col("item_name"), "id": F.col("doc_id")})
    return results.union_results(semantic, lexical_side, qna).select(
        "query_id", "rank", "doc_id", "content", "score", F.col("metadata")["name"].alias("name"),
        F.col("metadata")["id"].alias("id"), "source")


@query(sql.with_(sql.CATALOG, sql.CATALOG_QUERIES, sql.PASSAGES, sql.VECTORS, sql.QUERY_VECTORS,
                 sql.bm25("c", "catalog", search.PRODUCT_FIELDS, "catalog_queries", 3), sql.knn("v", 3)) + """
SELECT query_id, rank, 'product' AS kind, 'Score: ' || round(score::DECIMAL(20, 6), 4)::VARCHAR || chr(10) || 'Category: ' || category_name
  || chr(10) || 'Product: ' || item_name || chr(10) || 'Brand: ' || brand_name || chr(10) || 'Text: '
  || substr(chunk_text, 1, 200) || '...' || chr(10) || '---' AS block, substr(chunk_text, 1, 100) || '...' AS preview
FROM c_hits JOIN catalog USING (doc_id)
UNION ALL SELECT query_id, rank, 'passage', 'Score: ' || round(score::DECIMAL(20, 6), 4)::VARCHAR || chr(10) || 'Domain: '
  || coalesce(domain, 'N/A') || chr(10) || 'PID: ' || coalesce(pid, 'N/A') || chr(10) || 'Passage: '
  || substr(coalesce(passage, 'N/A'), 1, 300) || chr(10) || '---', substr(coalesce(passage, ''), 1, 100) || '...'
FROM v_hits LEFT JOIN (SELECT * FROM passages WHERE domain <> 'fr') USING (doc_id)""")
def result_format(spark, d):
    """Display blocks; the fields of French passages are made null, so they read N/A."""
    docs = prepare.concat_bullets(fx.catalog(spark, d))
    products = prepare.question_chunk(results.attach(
        lexical.bm25_topk(fx.catalog_queries(spark, d), docs, search.PRODUCT_FIELDS, 3),
        docs, "category_name", "item_name", "brand_name", "product_description"))
    passages = fx.passages(spark, d).withColumns({c: F.when(F.col("domain") != "fr", F.col(c)) for c in ("domain", "pid", "passage")})
    near = results.attach(search.dense_hits(spark, d, 3), passages, "domain", "pid", "passage", how="left")
    shown = lambda df, kind, text: df.select(
        "query_id", "rank", F.lit(kind).alias("kind"), "block", preview(text).alias("preview"))
    return shown(results.format_product(products), "product", "chunk_text").unionByName(
        shown(results.format_passage(near), "passage", "passage"))


@query(sql.with_(sql.MEMORY) + """
SELECT user_id, session_id, turn, text AS user_text, next_text AS assistant_text FROM (
  SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text FROM memory
  WINDOW w AS (PARTITION BY user_id, session_id ORDER BY turn)) WHERE role = 'user' AND next_role = 'assistant'""")
def memory_turn_pairs(spark, d):
    return conversation.turn_pairs(fx.memory(spark, d))


@query(sql.with_(sql.MEMORY) + """
SELECT user_id, session_id, turn, role, text, position FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, session_id ORDER BY turn DESC) AS position FROM memory)
WHERE position <= 10""")
def memory_recent10(spark, d):
    return conversation.recent(fx.memory(spark, d), 10)


_SESSION_QUERIES = """session_queries AS (
  SELECT item_id AS query_id, item_id % 10 AS user_id, item_id AS session_id, text AS query_text FROM benchmark)"""


def _session_queries(spark, d):
    """Benchmark questions, each asked in the session of the same number."""
    return fx.passage_queries(spark, d).select(
        "query_id", (F.col("query_id") % 10).alias("user_id"), F.col("query_id").alias("session_id"), "query_text")


@query(sql.with_(sql.MEMORY, _SESSION_QUERIES, """
ctx AS (
  SELECT user_id, session_id, string_agg('Previous: ' || text, '; ' ORDER BY position) AS c FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, session_id ORDER BY turn DESC) AS position
    FROM memory WHERE role = 'user') WHERE position <= 2 GROUP BY ALL)""") + """
SELECT query_id, user_id, session_id, query_text, coalesce(query_text || ' (Context: ' || c || ')', query_text) AS enhanced
FROM session_queries LEFT JOIN ctx USING (user_id, session_id)""")
def query_with_memory(spark, d):
    return conversation.enhance_queries(_session_queries(spark, d), fx.memory(spark, d))


_ALL_QUERIES = """all_queries AS (
  SELECT query_id, query_text FROM catalog_queries UNION ALL SELECT item_id + 1000000000, text FROM benchmark)"""
_SUMMARY = sql.with_(sql.CATALOG, sql.CATALOG_QUERIES, _ALL_QUERIES, sql.bm25("c", "catalog", search.PRODUCT_FIELDS, "all_queries", 5), """
totals AS (SELECT query_id, count(DISTINCT doc_id) AS n FROM c_q JOIN c_post USING (token) GROUP BY query_id)""", """
summaries AS (
  SELECT query_id, coalesce('Found ' || n || ' results. Top items: ' || names, 'No results found (0 hits)') AS summary
  FROM all_queries LEFT JOIN totals USING (query_id) LEFT JOIN (
    SELECT query_id, string_agg(coalesce(item_name, 'Unknown'), ', ' ORDER BY rank) AS names
    FROM c_hits JOIN catalog USING (doc_id) WHERE rank <= 3 GROUP BY query_id) USING (query_id))""")


def _summaries(spark, d):
    """Product questions, and passage questions most of which match no product."""
    docs = prepare.concat_bullets(fx.catalog(spark, d))
    passage_side = fx.passage_queries(spark, d).select((F.col("query_id") + 1000000000).alias("query_id"), "query_text")
    asked = fx.catalog_queries(spark, d).unionByName(passage_side)
    hits = results.attach(lexical.bm25_topk(asked, docs, search.PRODUCT_FIELDS, 5), docs, "item_name")
    return asked, conversation.summarise(asked, results.total_hits(asked, docs, list(search.PRODUCT_FIELDS)), hits)


@query(_SUMMARY + "SELECT * FROM summaries")
def result_summary(spark, d):
    return _summaries(spark, d)[1]


@query(_SUMMARY + """
SELECT user_id, session_id, turn + n AS turn, ['user', 'assistant'][n + 1] AS role, [query_text, summary][n + 1] AS text FROM (
  SELECT query_id % 10 AS user_id, query_id AS session_id, coalesce(next, 0) AS turn, unnest([0, 1]) AS n, query_text, summary
  FROM all_queries JOIN summaries USING (query_id)
  LEFT JOIN (SELECT conv_id, max(turn) + 1 AS next FROM conversations GROUP BY conv_id) ON conv_id = query_id)""")
def memory_append(spark, d):
    """An answered batch appended to the memory, twice: the repeated append adds nothing."""
    asked, summaries = _summaries(spark, d)
    answered = stage(conversation.with_next_turn(asked.join(summaries, "query_id").select(
        (F.col("query_id") % 10).alias("user_id"), F.col("query_id").alias("session_id"), "query_text", "summary"), fx.memory(spark, d)), "answered")
    path = new_folder(spark, "memory")
    for _ in range(2):
        conversation.append_interactions(answered, path)
    return spark.read.parquet(path).drop("bucket")


@query(sql.with_(sql.MEMORY, _SESSION_QUERIES, """
recent AS (
  SELECT user_id, session_id, string_agg('Previous: ' || text, '; ' ORDER BY position) AS c FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, session_id ORDER BY turn DESC) AS position
    FROM memory WHERE role = 'user') WHERE position <= 2 GROUP BY ALL)""", """
passage_queries AS (
  SELECT query_id, coalesce(query_text || ' (Context: ' || c || ')', query_text) AS query_text
  FROM session_queries LEFT JOIN recent USING (user_id, session_id))""", sql.PASSAGES, sql.neural("n", 5, 64), """
answers AS (
  SELECT query_id, 'Found ' || count(*) || ' results. Top items: ' || string_agg(domain, ', ' ORDER BY rank) FILTER (rank <= 3) AS summary
  FROM n_hits JOIN passages USING (doc_id) GROUP BY query_id)""") + """
SELECT user_id, session_id, coalesce(next, 0) + n AS turn, ['user', 'assistant'][n + 1] AS role, [query_text, summary][n + 1] AS text FROM (
  SELECT user_id, session_id, next, query_text, coalesce(summary, 'No results found (0 hits)') AS summary, unnest([0, 1]) AS n
  FROM session_queries LEFT JOIN answers USING (query_id)
  LEFT JOIN (SELECT conv_id, max(turn) + 1 AS next FROM conversations GROUP BY conv_id) ON conv_id = session_id)""")
def memory_answer_turn(spark, d):
    """Questions asked in sessions: put into context, searched by the encoder, summarised and remembered; a second run adds nothing."""
    passages = prepare.passage_chunk(fx.passages(spark, d))
    path = new_folder(spark, "turns")

    def nearest(asked):
        return results.attach(vector.neural_topk(asked, passages, "chunk_text", 5, 64), passages, "domain")
    for _ in range(2):
        conversation.answer_turn(_session_queries(spark, d), fx.memory(spark, d), nearest, path, "domain")
    return spark.read.parquet(path).drop("bucket")


_CONTEXT = """ctx AS (
  SELECT query_id, string_agg('domain: ' || domain || chr(10) || 'pid: ' || pid || chr(10) || 'passage: ' || passage
    || chr(10) || 'chunk_text: ' || chunk_text, chr(10) || chr(10) ORDER BY rank) AS context
  FROM s_hits JOIN passages USING (doc_id) GROUP BY query_id)"""
_RAG_BASE = (sql.PASSAGES, sql.PASSAGE_QUERIES, sql.sparse("s", 3), _CONTEXT)


def _contexts(spark, d):
    hits = results.attach(search.sparse_hits(spark, d, 3), fx.passages(spark, d), "domain", "pid", "passage")
    return conversation.context(prepare.passage_chunk(hits), ["domain", "pid", "passage", "chunk_text"], 10)


@query(sql.with_(*_RAG_BASE) + "SELECT * FROM ctx")
def rag_context(spark, d):
    return _contexts(spark, d)


_PROMPTS = sql.with_(*_RAG_BASE, sql.MEMORY, _SESSION_QUERIES, """hist AS (
  SELECT user_id, session_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS history FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, session_id ORDER BY turn DESC) AS position FROM memory)
  WHERE position <= 10 GROUP BY ALL)""", f"""prompts AS (
  SELECT query_id, user_id, session_id, concat_ws(chr(10) || chr(10), '{SYSTEM_PROMPT}', '{INSTRUCTIONS}',
    'History:' || chr(10) || coalesce(history, ''), 'Context:' || chr(10) || coalesce(context, ''),
    'Question: ' || query_text) AS prompt
  FROM session_queries LEFT JOIN ctx USING (query_id) LEFT JOIN hist USING (user_id, session_id))""")


def _prompts(spark, d):
    asked = _session_queries(spark, d)
    history = conversation.history(conversation.asked_sessions(fx.memory(spark, d), asked), 10)
    return conversation.prompts(asked, _contexts(spark, d), history, SYSTEM_PROMPT, INSTRUCTIONS)


@query(_PROMPTS + "SELECT * FROM prompts")
def rag_prompt(spark, d):
    return _prompts(spark, d)


def echo_client():
    """A stand-in for a language model: repeats the length of the prompt and its last line."""
    return lambda prompts: [f"{len(p)} characters; {p.splitlines()[-1]}" for p in prompts]


@query(_PROMPTS + """
SELECT query_id, length(prompt) || ' characters; ' || regexp_extract(prompt, '[^\\n]*$') AS answer FROM prompts""")
def generate_answers(spark, d):
    return encoders.generate_answers(_prompts(spark, d), echo_client).select("query_id", "answer")


@query(sql.with_(sql.MEMORY) + """
SELECT user_id, session_id, count(*) FILTER (role = 'user') AS user_turns,
  count(*) FILTER (role = 'assistant') AS assistant_turns, count(*) AS turns,
  arg_max(text, turn) FILTER (role = 'user') AS last_user_text
FROM memory GROUP BY user_id, session_id""")
def session_summary(spark, d):
    return conversation.session_summary(fx.memory(spark, d))


@query(sql.with_(sql.MEMORY) + """
SELECT user_id, count(DISTINCT session_id) AS sessions, count(*) AS turns, count(*) FILTER (role = 'user') AS user_turns
FROM memory GROUP BY user_id""")
def user_preferences(spark, d):
    return conversation.user_preferences(fx.memory(spark, d))
