"""Building blocks of the comparison SQL (DuckDB dialect)."""

from __future__ import annotations

from collections.abc import Mapping

WHITESPACE = r"[\s\x0B\x1c-\x1f\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def words(col: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({col}, ''), '{WHITESPACE}'), lambda w: w <> '')"


def first_words(col: str, n: int = 500) -> str:
    return f"array_to_string({words(col)}[1:{n}], ' ')"


def tokens(col: str) -> str:
    return rf"list_filter(regexp_split_to_array(lower(coalesce({col}, '')), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"


CATALOG = f"""catalog AS (
  SELECT *, {first_words("product_description || ' ' || brand_name || ' ' || item_name")} AS chunk_text FROM (
    SELECT p_partkey AS doc_id, p_name AS item_name, p_brand AS brand_name, p_type AS category_name,
      p_type || ' ' || p_name AS product_description, 'is the ' || p_name || ' sold as ' || p_type AS question_text,
      p_brand || ' ' || p_type || ' ' || p_name || ' ' || p_size || ' ' AS bullets,
      [p_type, p_brand, p_name][1:p_partkey % 4] AS answers, p_size AS size
    FROM part))"""
CATALOG_QUERIES = "catalog_queries AS (SELECT min(p_partkey) AS query_id, p_name AS query_text FROM part GROUP BY p_name)"
PASSAGES = f"""passages AS (
  SELECT doc_id, doc_id::VARCHAR AS pid, lang AS domain, text AS passage, source, {first_words('text')} AS chunk_text
  FROM documents)"""
PASSAGE_QUERIES = "passage_queries AS (SELECT item_id AS query_id, text AS query_text FROM benchmark)"
VECTORS = "vectors AS (SELECT vec_id AS doc_id, embedding::DOUBLE[] AS e, label AS cell FROM embeddings)"
QUERY_VECTORS = """query_vectors AS (
  SELECT item_id AS query_id, embedding::DOUBLE[] AS e FROM benchmark JOIN embeddings ON item_id = vec_id)"""
MEMORY = """memory AS (
  SELECT conv_id % 10 AS user_id, conv_id AS session_id, turn, role, text FROM conversations)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def query_tokens(name: str, queries: str) -> str:
    return f"""{name} AS (
  SELECT DISTINCT query_id, unnest({tokens('query_text')}) AS token FROM {queries})"""


def ranked(name: str, scored: str, k: int) -> str:
    return f"""{name} AS (
  SELECT query_id, rank, doc_id, score FROM (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
    FROM {scored}) WHERE rank <= {k})"""


def postings(p: str, docs: str, fields: list[str]) -> str:
    stacked = " UNION ALL ".join(f"SELECT doc_id, '{f}' AS field, {f} AS txt FROM {docs}" for f in fields)
    return f"""{p}_an AS (SELECT doc_id, field, {tokens('txt')} AS toks FROM ({stacked})),
{p}_len AS (SELECT doc_id, field, len(toks) AS dl FROM {p}_an WHERE len(toks) > 0),
{p}_post AS (
  SELECT doc_id, field, token, count(*) AS tf
  FROM (SELECT doc_id, field, unnest(toks) AS token FROM {p}_an) GROUP BY ALL)"""


def bm25(p: str, docs: str, boosts: Mapping[str, float], queries: str, k: int, allowed: str = "true") -> str:
    """CTEs ending in ``{p}_hits``."""
    values = ", ".join(f"('{f}', {float(b)}::DOUBLE)" for f, b in boosts.items())
    return f"""{postings(p, docs, list(boosts))},
{query_tokens(p + '_q', queries)},
{p}_stats AS (SELECT field, count(*) AS n, avg(dl) AS avgdl FROM {p}_len GROUP BY field),
{p}_df AS (SELECT field, token, count(*) AS df FROM {p}_post GROUP BY ALL),
{p}_boost(field, boost) AS (VALUES {values}),
{p}_score AS (
  SELECT query_id, doc_id, round(sum(boost * ln(1 + (n - df + 0.5) / (df + 0.5))
      * tf / (tf + 1.2 * (1 - 0.75 + 0.75 * dl / avgdl))), 6) AS score
  FROM {p}_q JOIN {p}_post USING (token) JOIN {p}_boost USING (field) JOIN {p}_df USING (field, token)
    JOIN {p}_stats USING (field) JOIN {p}_len USING (doc_id, field)
  WHERE {allowed} GROUP BY query_id, doc_id),
{ranked(p + '_hits', p + '_score', k)}"""


def knn(p: str, k: int) -> str:
    """Exact hits of ``query_vectors`` over ``vectors``, ending in ``{p}_hits``."""
    return f"""{p}_score AS (
  SELECT query_id, doc_id, round(1 / (1 + list_distance(q.e, v.e) ** 2), 6) AS score
  FROM query_vectors q CROSS JOIN vectors v),
{ranked(p + '_hits', p + '_score', k)}"""


def sparse(p: str, k: int) -> str:
    """Sparse hits of ``passage_queries`` over ``passages``, ending in ``{p}_hits``."""
    return f"""{p}_q AS (
  SELECT query_id, token, ln(1 + count(*)) AS qw
  FROM (SELECT query_id, unnest({tokens('query_text')}) AS token FROM passage_queries) GROUP BY ALL),
{p}_d AS (
  SELECT doc_id, token, ln(1 + count(*)) AS dw
  FROM (SELECT doc_id, unnest({tokens('passage')}) AS token FROM passages) GROUP BY ALL),
{p}_score AS (
  SELECT query_id, doc_id, round(sum(qw * dw), 6) AS score FROM {p}_q JOIN {p}_d USING (token) GROUP BY ALL),
{ranked(p + '_hits', p + '_score', k)}"""


def normalised(name: str, hits: str) -> str:
    return f"""{name} AS (
  SELECT query_id, rank, doc_id, CASE WHEN hi = lo THEN 1.0::DOUBLE ELSE (score - lo) / (hi - lo) END AS score
  FROM (SELECT *, min(score) OVER (PARTITION BY query_id) AS lo, max(score) OVER (PARTITION BY query_id) AS hi
        FROM {hits}))"""


def combined(name: str, a: str, b: str, w1: float, w2: float) -> str:
    return f"""{name} AS (
  SELECT query_id, doc_id,
    round(({w1}::DOUBLE * coalesce(a.score, 0) + {w2}::DOUBLE * coalesce(b.score, 0)) / ({w1}::DOUBLE + {w2}::DOUBLE), 6) AS score
  FROM {a} a FULL OUTER JOIN {b} b USING (query_id, doc_id))"""


def hashed(table: str, key: str, text: str, dim: int) -> str:
    """Non-zero elements ``(key, position, value)`` of the default dense encoding of a text column."""
    return f"""
SELECT {key}, position, (n / sqrt(sum(n * n) OVER (PARTITION BY {key})))::FLOAT::DOUBLE AS value FROM (
  SELECT {key}, ('0x' || substr(md5(t), 1, 8))::BIGINT % {dim} AS position, count(*)::DOUBLE AS n
  FROM (SELECT {key}, unnest({tokens(text)}) AS t FROM {table}) GROUP BY ALL)"""


def neural(p: str, k: int, dim: int) -> str:
    """Exact hits of encoded ``passage_queries`` over encoded ``passages``, ending in ``{p}_hits``."""
    return f"""{p}_d AS ({hashed('passages', 'doc_id', 'chunk_text', dim)}),
{p}_q AS ({hashed('passage_queries', 'query_id', 'query_text', dim)}),
{p}_dn AS (SELECT doc_id, coalesce(sum(value * value), 0) AS dn FROM passages LEFT JOIN {p}_d USING (doc_id) GROUP BY doc_id),
{p}_qn AS (SELECT query_id, coalesce(sum(value * value), 0) AS qn FROM passage_queries LEFT JOIN {p}_q USING (query_id) GROUP BY query_id),
{p}_dot AS (SELECT query_id, doc_id, sum(q.value * d.value) AS dot FROM {p}_q q JOIN {p}_d d USING (position) GROUP BY ALL),
{p}_score AS (
  SELECT query_id, doc_id, round(1 / (1 + greatest(qn + dn - 2 * coalesce(dot, 0), 0)), 6) AS score
  FROM {p}_qn CROSS JOIN {p}_dn LEFT JOIN {p}_dot USING (query_id, doc_id)),
{ranked(p + '_hits', p + '_score', k)}"""
