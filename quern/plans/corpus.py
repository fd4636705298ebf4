"""Queries for sources, preparation and encoding."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern import schemas
from quern.functions import encoders, text
from quern.operators import jsonlog, prepare, sparse, vector
from quern.operators.results import answer_content
from quern.plans import fixtures as fx
from quern.plans import sql
from quern.plans.registry import query
from quern.session import new_folder, stage
from quern.sources import names, readers, sinks
from quern.sources.keyed import KeyedTable
from quern.streaming import incremental


@query("""
SELECT 'documents' AS origin, doc_id AS source_id, lang AS domain, length(text) AS n_chars
FROM documents WHERE lang IN ('en', 'fr')
UNION ALL SELECT 'pages', page_id, 'web', length(html) FROM pages""")
def scan_filtered_sources(spark, d):
    wanted = ["en", "fr", "web"]
    docs = fx.table(spark, d, "documents").select(
        F.lit("documents").alias("origin"), F.col("doc_id").alias("source_id"), F.col("lang").alias("domain"),
        F.length("text").cast("bigint").alias("n_chars"))
    pages = fx.table(spark, d, "pages").select(
        F.lit("pages").alias("origin"), F.col("page_id").alias("source_id"), F.lit("web").alias("domain"),
        F.length("html").cast("bigint").alias("n_chars"))
    return prepare.filter_categories(docs.unionByName(pages), wanted, "domain")


_FILE = "'./amazon_pqa_' || lower(p_type) || '_&_' || replace(p_name, ' ', '-') || '.json'"


@query(f"""
SELECT p_partkey AS doc_id, lower(p_type) || ' and ' || replace(p_name, ' ', '-') AS category_name,
  'AMAZON_PQA_' || upper(p_type) || '_AND_' || upper(replace(p_name, ' ', '_')) AS constant
FROM part""")
def source_name_normalise(spark, d):
    files = fx.table(spark, d, "part").select(
        F.col("p_partkey").alias("doc_id"), F.expr(_FILE).alias("file_name"))
    return files.select("doc_id", names.category_value(F.col("file_name")).alias("category_name"),
                        names.category_constant(F.col("file_name")).alias("constant"))


def _question_files(spark, d):
    """The products written as JSON lines, the layout of the question corpus."""
    path = new_folder(spark, "questions")
    fx.catalog(spark, d).select(
        F.col("doc_id").cast("string").alias("question_id"), "question_text", "brand_name", "item_name",
        "product_description", *schemas.BULLETS, "answers").write.json(path)
    return path


@query("""
SELECT p_partkey::VARCHAR AS question_id, 'is the ' || p_name || ' sold as ' || p_type AS question_text,
  p_name AS item_name, NULL::VARCHAR AS asin, p_size::VARCHAR AS bullet_point4, p_partkey % 4 AS n_answers
FROM part""")
def scan_json_lines(spark, d):
    return readers.read_json_lines(spark, _question_files(spark, d)).select(
        "question_id", "question_text", "item_name", "asin", "bullet_point4",
        F.size("answers").cast("bigint").alias("n_answers"))


@query("SELECT doc_id::VARCHAR AS pid, 'files' AS domain, md5(text) AS passage_md5 FROM documents")
def scan_passage_tsv(spark, d):
    path = new_folder(spark, "passages")
    fx.passages(spark, d).select("pid", "passage").write.option("sep", "\t").option("escape", '"').option(
        "ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)
    return readers.read_passages(spark, path, domain="files").select(
        "pid", "domain", F.md5("passage").alias("passage_md5"))


@query("""
SELECT lang || '-' || source AS query_id, md5(arg_max(text, doc_id)) AS query_md5 FROM documents GROUP BY lang, source""")
def scan_query_file(spark, d):
    """Texts keyed by language and source, so ids repeat and the last row of the file order wins."""
    path = new_folder(spark, "queries")
    fx.table(spark, d, "documents").orderBy("doc_id").select(
        F.concat_ws("-", "lang", "source").alias("query_id"), "text").write.option("sep", "\t").option("escape", '"').option(
        "ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)
    return readers.read_queries(spark, path).select("query_id", F.md5("query_text").alias("query_md5"))


@query("SELECT l_orderkey::VARCHAR AS query_id, l_partkey::VARCHAR AS pid FROM lineitem WHERE l_returnflag <> 'R'")
def scan_qrels_file(spark, d):
    """Returned items are written without a grade, as rows of three columns that must be skipped."""
    path = new_folder(spark, "qrels")
    grade = F.when(F.col("l_returnflag") != "R", F.lit("\t1")).otherwise(F.lit(""))
    fx.table(spark, d, "lineitem").select(
        F.concat(F.concat_ws("\t", F.col("l_orderkey").cast("string"), F.lit("0"), F.col("l_partkey").cast("string")), grade)
    ).write.text(path)
    return readers.read_qrels(spark, path)


@query("""
SELECT l_orderkey AS query_id, arg_max(l_partkey, (l_linenumber, l_partkey, l_suppkey)) AS pid
FROM lineitem GROUP BY l_orderkey""")
def qrels_last_wins(spark, d):
    rows = fx.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("query_id"), F.col("l_partkey").alias("pid"), "l_linenumber", "l_partkey", "l_suppkey")
    return readers.last_wins(rows, "query_id", "pid", ["l_linenumber", "l_partkey", "l_suppkey"])


_LINE = """'{"question_id":"' || p_partkey || '","item_name":"' || p_name || '"}'"""


@query(f"""
SELECT 'ok' AS status, p_partkey::VARCHAR AS content FROM part WHERE p_type <> 'PROMO'
UNION ALL SELECT 'bad', substr({_LINE}, 1, 24) FROM part WHERE p_type = 'PROMO'""")
def load_quarantine(spark, d):
    """Lines of one product type are cut short and must end up in quarantine."""
    path = new_folder(spark, "tolerant")
    line = F.expr(_LINE)
    fx.table(spark, d, "part").select(
        F.when(F.col("p_type") == "PROMO", F.substring(line, 1, 24)).otherwise(line)).write.text(path)
    # Staged once: Spark refuses to filter a raw file on the corrupt-record column alone.
    loaded = stage(readers.read_json_lines(spark, path, on_error="quarantine"), "tolerant")
    good, bad = readers.split_quarantine(loaded)
    return good.select(F.lit("ok").alias("status"), F.col("question_id").alias("content")).unionByName(
        bad.select(F.lit("bad").alias("status"), F.col(readers.BAD).alias("content")))


@query("""
SELECT source, doc_id, n_chars FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS nth FROM documents) WHERE nth <= 20""")
def per_source_limit(spark, d):
    return prepare.per_source_limit(fx.table(spark, d, "documents"), "source", ["doc_id"], 20).select(
        "source", "doc_id", "n_chars")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_linestatus FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY (l_linestatus = 'F')::INT DESC, l_partkey DESC, l_suppkey DESC) = 1""")
def upsert_by_key(spark, d):
    rows = fx.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_linestatus")
    keys, version = ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"]
    table = KeyedTable.create(spark, new_folder(spark, "lines"), rows.schema, keys, buckets=8)
    table.load(rows.where("l_linestatus <> 'F'"), version)
    table.load(rows.where("l_linestatus = 'F'"), version)
    return table.read()


@query("""
SELECT p_partkey AS doc_id, p_type AS category_name,
  CASE WHEN p_partkey % 3 = 0 AND p_type >= 'M' THEN 'second ' || p_name ELSE p_name END AS item_name FROM part""")
def load_two_categories(spark, d):
    """Categories loaded one after the other into one table; the second load also brings rows anew, a third one fails."""
    docs = fx.catalog(spark, d).select("doc_id", "category_name", "item_name")
    table = KeyedTable.create(spark, new_folder(spark, "products"), docs.schema, ["doc_id"], buckets=8, sort=["category_name"])
    table.load(docs.where("category_name < 'M' OR doc_id % 3 = 0"), ["item_name"])
    renamed = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("second "), "item_name")).otherwise(F.col("item_name"))
    table.load(docs.where("category_name >= 'M'").withColumn("item_name", renamed), ["item_name"])
    try:
        table.load(docs.withColumn("item_name", F.lit(0)), ["item_name"])
    except schemas.SchemaConflict:
        return table.read()
    raise AssertionError("numbers were loaded into a text column")


@query("""
SELECT 'created' AS step, 0 AS version, 0::BIGINT AS n_rows UNION ALL SELECT 'loaded', 1, count(*) FROM customer
UNION ALL SELECT 'kept', 1, count(*) FROM customer UNION ALL SELECT 'refused', 1, count(*) FROM customer
UNION ALL SELECT 'replaced', 2, 0 UNION ALL SELECT 'loaded again', 3, count(*) FROM supplier
UNION ALL SELECT 'older version', 1, count(*) FROM customer UNION ALL SELECT 'deleted', 4, 0""")
def table_create_modes(spark, d):
    """What a table holds after each way to create it."""
    customers = fx.table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    suppliers = fx.table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    path, steps = new_folder(spark, "modes"), []

    def note(step: str, table: KeyedTable, version: int | None = None) -> None:
        shown = table.version if version is None else version
        steps.append(table.read(version).agg(F.lit(step).alias("step"), F.lit(shown).alias("version"), F.count("*").alias("n_rows")))

    def created(if_exists: str) -> KeyedTable:
        return KeyedTable.create(spark, path, customers.schema, ["key"], buckets=4, if_exists=if_exists)
    table = created("error")
    note("created", table)
    table.load(customers, ["name"])
    note("loaded", table)
    note("kept", created("keep"))
    try:
        created("error")
    except FileExistsError:
        note("refused", table)
    note("replaced", created("replace"))
    table.load(suppliers, ["name"])
    note("loaded again", table)
    note("older version", table, 1)
    table.delete(suppliers)
    note("deleted", table)
    return reduce(DataFrame.unionByName, steps)


@query("""
SELECT p_partkey AS doc_id, i AS position, [p_type, p_brand, p_name][i + 1] AS answer_text,
  CASE WHEN p_partkey % 2 = 0 THEN p_size::DOUBLE / 2 ELSE p_size END AS rating, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS author
FROM (SELECT *, unnest(range(p_partkey % 4)) AS i FROM part)
UNION ALL SELECT -1, 0, 'answers[].rating: double stored, string incoming', NULL, NULL""")
def nested_schema_evolution(spark, d):
    """Answers whose ratings widen and that gain an author; ratings of another type are reported with their path."""
    docs = fx.catalog(spark, d)
    answers = lambda *fields: F.transform("answers", lambda a: F.struct(a["answer_text"].alias("answer_text"), *fields))
    whole = F.col("size").cast("int").alias("rating")
    halves, author = (F.col("size") / 2).alias("rating"), F.col("brand_name").alias("author")
    first = docs.where("doc_id % 2 = 1").select("doc_id", answers(whole).alias("answers"))
    second = docs.where("doc_id % 2 = 0").select("doc_id", answers(author, halves).alias("answers"))
    table = KeyedTable.create(spark, new_folder(spark, "nested"), first.schema, ["doc_id"], buckets=8)
    table.load(first, ["doc_id"])
    table.load(second, ["doc_id"])
    found = table.read().select("doc_id", F.posexplode("answers").alias("position", "a")).select(
        "doc_id", F.col("position").cast("bigint").alias("position"), "a.answer_text", "a.rating", "a.author")
    try:
        table.load(docs.select("doc_id", answers(F.lit("five").alias("rating")).alias("answers")), ["doc_id"])
    except schemas.SchemaConflict as conflict:
        return found.unionByName(spark.createDataFrame([(-1, 0, str(conflict), None, None)], found.schema))
    raise AssertionError("texts were loaded as ratings")


@query("SELECT source, sum(strlen(text) + 1)::BIGINT AS bytes FROM documents GROUP BY source")
def source_file_bytes(spark, d):
    """Texts written to files by source; the listing of the files gives their bytes."""
    path = new_folder(spark, "by-source")
    fx.table(spark, d, "documents").select("source", "text").write.partitionBy("source").text(path)
    files = readers.source_sizes(spark, path, with_folder=True)
    return files.groupBy(F.regexp_extract("folder", "source=(.*)$", 1).alias("source")).agg(F.sum("bytes").alias("bytes"))


@query("""
SELECT doc_id, lang, source, NULL::INTEGER AS quality, NULL::INTEGER AS toxic FROM documents
UNION ALL SELECT doc_id, NULL, NULL, quality, toxic FROM labels""")
def schema_merge_union(spark, d):
    return schemas.add_columns(fx.table(spark, d, "documents").select("doc_id", "lang", "source"),
                               fx.table(spark, d, "labels"))


@query("""
SELECT l_suppkey, docs,
  CASE WHEN docs * 2 < 1024 THEN printf('%.0f', (docs * 2)::DOUBLE) || ' MB'
       ELSE printf('%.1f', round_even(docs * 2 / 1024, 1)) || ' GB' END AS product_estimate,
  CASE WHEN docs / 1024 < 1024 THEN printf('%.0f', round_even(docs / 1024, 0)) || ' MB'
       ELSE printf('%.1f', round_even(docs / 1024 / 1024, 1)) || ' GB' END AS passage_estimate
FROM (SELECT l_suppkey, count(*) AS docs FROM lineitem GROUP BY l_suppkey)""")
def size_estimate_by_source(spark, d):
    return sinks.size_estimate(fx.table(spark, d, "lineitem"), "l_suppkey")


@query(sql.with_(sql.PASSAGES) + """
SELECT coalesce(domain, 'TOTAL') AS domain, count(*) AS docs FROM passages WHERE chunk_text <> '' GROUP BY ROLLUP (domain)""")
def load_report_rollup(spark, d):
    return sinks.load_report(prepare.drop_blank_passages(fx.passages(spark, d)), "domain")


@query("SELECT doc_id FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)")
def missing_sources_anti(spark, d):
    return names.missing_sources(fx.table(spark, d, "documents").select("doc_id"), fx.table(spark, d, "labels"), "doc_id")


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def present_sources_semi(spark, d):
    found = fx.table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return names.present_sources(fx.table(spark, d, "customer").select("c_custkey"), found, "c_custkey")


@query(f"""
SELECT doc_id, lang, {sql.first_words('text')} AS chunk_text FROM documents
WHERE length({sql.first_words('text')}) > 4""")
def stream_incremental_load(spark, d):
    """Documents arrive as a file stream, are chunked on arrival and kept by key."""
    path, checkpoint = new_folder(spark, "stream"), new_folder(spark, "stream-progress")
    source = fx.table(spark, d, "documents").schema
    stream = incremental.table_stream(spark, f"{d}/documents.parquet", source)

    def transform(batch):
        chunked = batch.withColumn("chunk_text", text.first_words("text"))
        return prepare.drop_short_chunks(chunked).select("doc_id", "lang", "chunk_text", "n_chars")

    incremental.incremental_load(stream, transform, path, checkpoint, ["doc_id"], ["n_chars"]).awaitTermination()
    schema = transform(spark.createDataFrame([], source)).schema
    return incremental.read_current(spark, path, schema, ["doc_id"], ["n_chars"]).drop("n_chars")


@query(sql.with_(sql.CATALOG) + "SELECT doc_id, bullets FROM catalog")
def bullets_concat(spark, d):
    return prepare.concat_bullets(fx.catalog(spark, d)).select("doc_id", "bullets")


@query("""SELECT p_partkey AS doc_id, lower(p_type) AS category_name, 'AMAZON_PQA_' || p_type AS constant FROM part""")
def category_lookup(spark, d):
    docs = fx.catalog(spark, d).select("doc_id", F.lower("category_name").alias("category_name"))
    files = docs.select("category_name").distinct().select(
        F.concat(F.lit(names.FILE_PREFIX), "category_name", F.lit(".json")).alias("file_name"))
    return names.lookup_category(docs, names.category_dimension(files)).select("doc_id", "category_name", "constant")


@query("""
SELECT p_partkey AS doc_id, 'AMAZON_PQA_' || p_type AS constant, lower(p_type) AS category_name FROM part
UNION ALL SELECT p_partkey, p_brand, NULL FROM part""")
def category_reverse_lookup(spark, d):
    """Constants back to names; the brands stand for constants nobody declared."""
    part = fx.table(spark, d, "part")
    files = part.select(F.concat(F.lit(names.FILE_PREFIX), F.lower("p_type"), F.lit(".json")).alias("file_name")).distinct()
    known = part.select(F.col("p_partkey").alias("doc_id"), F.concat(F.upper(F.lit(names.FILE_PREFIX)), "p_type").alias("constant"))
    unknown = part.select(F.col("p_partkey").alias("doc_id"), F.col("p_brand").alias("constant"))
    return names.category_of_constant(known.unionByName(unknown), names.category_dimension(files)).select(
        "doc_id", "constant", "category_name")


def _u(salt: int) -> str:
    m = prepare.MODULI[salt]
    return f"((doc_id % {m} * {prepare.KEY_FACTORS[salt]} + position % {m} * {prepare.POSITION_FACTOR} + {salt}) % {m} / {m}.0::DOUBLE)"


@query(sql.with_(sql.CATALOG, f"""a AS (
  SELECT doc_id, i AS position, answers[i + 1] AS answer_text FROM (
    SELECT doc_id, answers, unnest(range(len(answers))) AS i FROM catalog))""") + f"""
SELECT doc_id, position, answer_text,
  {prepare.GIVEN_NAMES}[floor({_u(101)} * {len(prepare.GIVEN_NAMES)})::INT + 1] || ' ' ||
  {prepare.FAMILY_NAMES}[floor({_u(211)} * {len(prepare.FAMILY_NAMES)})::INT + 1] AS name,
  round({_u(307)} * 180 - 90, 6) AS user_lat, round({_u(401)} * 360 - 180, 6) AS user_lon,
  CASE WHEN {_u(13)} > 0.95 THEN 'other' WHEN {_u(13)} > 0.475 THEN 'female' ELSE 'male' END AS gender,
  round_even({_u(503)} * 100, 0)::BIGINT AS age, floor({_u(601)} * 100 / 20)::BIGINT + 1 AS product_rating
FROM a""")
def answers_enrich(spark, d):
    enriched = prepare.enrich_answers(fx.catalog(spark, d), F.col("doc_id"))
    return prepare.explode_answers(enriched, "doc_id").where(F.col("position").isNotNull()).withColumn(
        "position", F.col("position").cast("bigint"))


@query(sql.with_(sql.CATALOG) + """
SELECT doc_id, i AS position, answers[i + 1] AS answer_text FROM (
  SELECT doc_id, answers, unnest(CASE WHEN len(answers) = 0 THEN [NULL] ELSE range(len(answers)) END) AS i FROM catalog)""")
def answers_explode(spark, d):
    return prepare.explode_answers(fx.catalog(spark, d), "doc_id").withColumn("position", F.col("position").cast("bigint"))


@query(sql.with_(sql.CATALOG) + "SELECT doc_id, chunk_text FROM catalog")
def chunk_text_build(spark, d):
    return prepare.question_chunk(fx.catalog(spark, d)).select("doc_id", "chunk_text")


@query(sql.with_(sql.PASSAGES) + f"SELECT doc_id, chunk_text, len({sql.words('chunk_text')}) AS n_words FROM passages")
def chunk_truncate_500(spark, d):
    return prepare.passage_chunk(fx.passages(spark, d)).select(
        "doc_id", "chunk_text", F.size(text.words("chunk_text")).cast("bigint").alias("n_words"))


@query(sql.with_(sql.CATALOG, sql.PASSAGES) + """
SELECT 'product' AS kind, doc_id FROM catalog WHERE length(chunk_text) > 4
UNION ALL SELECT 'passage', doc_id FROM passages WHERE chunk_text <> ''
UNION ALL SELECT 'long passage', doc_id FROM passages WHERE length(chunk_text) > 4""")
def chunk_filter(spark, d):
    products = prepare.drop_short_chunks(prepare.question_chunk(fx.catalog(spark, d)))
    passages = fx.passages(spark, d)
    not_blank = prepare.drop_blank_passages(passages)
    long = prepare.drop_short_chunks(prepare.passage_chunk(passages))
    kinds = {"product": products, "passage": not_blank, "long passage": long}
    parts = [df.select(F.lit(kind).alias("kind"), "doc_id") for kind, df in kinds.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("SELECT doc_id, lang || '_' || doc_id AS _id FROM documents")
def composite_key(spark, d):
    return fx.table(spark, d, "documents").select("doc_id", prepare.composite_key("lang", "doc_id").alias("_id"))


@query("""SELECT doc_id, CASE WHEN length(text) <= 256 THEN text END AS text_keyword FROM documents""")
def keyword_ignore_above(spark, d):
    return fx.table(spark, d, "documents").select("doc_id", text.keyword("text").alias("text_keyword"))


@query(f"""
SELECT doc_id, array_to_string(list_sort(k), ',') AS dotted FROM (
  SELECT doc_id, list_filter(list_distinct({sql.words('text')}), lambda w: contains(w, '.')) AS k FROM documents)
WHERE len(k) > 0""")
def dotted_key_check(spark, d):
    keys = F.array_distinct(text.words("text"))
    docs = fx.spread(fx.table(spark, d, "documents")).select(
        "doc_id", F.map_from_arrays(keys, F.array_repeat(F.lit(1.0), F.size(keys))).alias("weights"))
    return prepare.dotted_keys(docs, "weights", "doc_id")


@query(sql.with_(sql.CATALOG) + """
SELECT doc_id, 'Q: ' || question_text || chr(10) || 'A: ' || coalesce(answers[1], '') AS content FROM catalog""")
def qna_content(spark, d):
    return fx.catalog(spark, d).select("doc_id", answer_content().alias("content"))


@query("""
SELECT event_id, coalesce((props::JSON->>'$.k')::BIGINT, -1) AS k, 'none' AS absent,
  coalesce((props::JSON->>'$.k')::BIGINT, -1) AS nested FROM events""")
def json_safe_access(spark, d):
    inner = F.to_json(F.struct(F.col("props").alias("inner")))
    return fx.spread(fx.table(spark, d, "events")).select("event_id", jsonlog.decode(F.col("props")).alias("v"),
                                               jsonlog.decode(inner).alias("w")).select(
        "event_id", jsonlog.get_or(F.col("v"), "$.k", "bigint", -1).alias("k"),
        jsonlog.get_or(F.col("v"), "$.a.b", "string", "none").alias("absent"),
        jsonlog.get_or(jsonlog.at(F.col("w"), "$.inner"), "$.k", "bigint", -1).alias("nested"))


@query("""
SELECT p_partkey AS doc_id, 0 AS step, 1 AS position,
  CASE p_partkey % 4 WHEN 0 THEN 'text' WHEN 1 THEN 'category_aggregation' WHEN 2 THEN 'search_results'
    ELSE 'final_response' END AS type,
  CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN p_type || ' (' || p_size || ')' || chr(10) || p_brand || ' (2)'
    WHEN 2 THEN p_name || chr(10) || p_brand ELSE p_size || ' of ' || p_name END AS content
FROM part WHERE p_size <= 40""")
def agent_log_classify(spark, d):
    """Responses of every shape built from the products, the result being JSON text inside JSON."""
    name, brand = F.col("p_name"), F.col("p_brand")
    generated = F.to_json(F.struct(F.struct(F.struct(F.array(F.struct(name.alias("text"))).alias("content"))
                                            .alias("message")).alias("output")))
    buckets = F.array(F.struct(F.col("p_type").alias("key"), F.col("p_size").alias("doc_count")),
                      F.struct(brand.alias("key"), F.lit(2).alias("doc_count")))
    facets = F.to_json(F.struct(F.struct(F.struct(buckets.alias("buckets")).alias("categories")).alias("aggregations")))
    hit = lambda c: F.to_json(F.struct(F.struct(c.alias("item_name")).alias("_source")))
    shape = F.col("p_partkey") % 4
    result = (F.when(shape == 0, generated).when(shape == 1, facets)
              .when(shape == 2, F.concat(hit(name), F.lit("\n"), hit(brand)))
              .otherwise(F.concat(F.col("p_size").cast("string"), F.lit(" of "), name)))
    result = F.when(F.col("p_size") > 40, F.lit("{broken")).otherwise(result)
    outputs = F.array(F.struct(F.lit("memory_id").alias("name"), F.lit("m1").alias("result")),
                      F.struct(F.lit("response").alias("name"), result.alias("result")))
    logs = fx.spread(fx.table(spark, d, "part")).select(F.col("p_partkey").alias("doc_id"), F.to_json(
        F.struct(F.array(F.struct(outputs.alias("output"))).alias("inference_results"))).alias("response"))
    return jsonlog.classify_outputs(logs, "response", "doc_id")


@query("SELECT p_partkey AS doc_id, p_type AS category_name FROM part WHERE p_type IN ('ECONOMY', 'SMALL')")
def category_filter(spark, d):
    return prepare.filter_categories(fx.catalog(spark, d), ["ECONOMY", "SMALL"], "category_name").select(
        "doc_id", "category_name")


@query("""SELECT string_agg(n, ', ' ORDER BY n) AS names FROM (SELECT DISTINCT '''' || p_type || '''' AS n FROM part)""")
def category_name_list(spark, d):
    return prepare.category_names(fx.catalog(spark, d), "category_name")


@query(f"""
SELECT doc_id, term, round(ln(1 + count(*)), 6) AS weight
FROM (SELECT doc_id, unnest({sql.tokens('text')}) AS term FROM documents) GROUP BY ALL""")
def sparse_encode(spark, d):
    return sparse.encode_long(fx.passages(spark, d), "doc_id", "passage", "weight").withColumn(
        "weight", F.round("weight", 6))


_HASHED = sql.hashed("passages", "doc_id", "chunk_text", 64)


@query(sql.with_(sql.PASSAGES) + f"SELECT doc_id, position, round(value, 5) AS value FROM ({_HASHED})")
def dense_encode(spark, d):
    docs = prepare.passage_chunk(fx.passages(spark, d)).select("doc_id", "chunk_text")
    encoded = encoders.dense_encode(docs, {"chunk_text": "chunk_embedding"}, 64)
    return encoded.select("doc_id", F.posexplode("chunk_embedding").alias("position", "value")).where("value <> 0").select(
        "doc_id", F.col("position").cast("bigint").alias("position"), F.round(F.col("value").cast("double"), 5).alias("value"))


@query(sql.with_(sql.PASSAGES, f"dense AS ({_HASHED})") + f"""
SELECT doc_id, coalesce(n_terms, 0) AS n_terms, coalesce(total, 0.0) AS sparse_total, coalesce(peak, 0.0) AS dense_peak
FROM passages
LEFT JOIN (SELECT doc_id, count(*) AS n_terms, round(sum(w), 2) AS total FROM (
    SELECT doc_id, t, ln(1 + count(*))::FLOAT::DOUBLE AS w
    FROM (SELECT doc_id, unnest({sql.tokens('chunk_text')}) AS t FROM passages) GROUP BY ALL) GROUP BY doc_id) USING (doc_id)
LEFT JOIN (SELECT doc_id, round(max(value), 5) AS peak FROM dense GROUP BY doc_id) USING (doc_id)""")
def dual_encode(spark, d):
    """Sparse and dense encodings of the same chunk in one pass over the documents."""
    docs = prepare.passage_chunk(fx.passages(spark, d)).select("doc_id", "chunk_text")
    both = encoders.sparse_encode(encoders.dense_encode(docs, {"chunk_text": "dense"}, 64), {"chunk_text": "sparse"})
    total = F.aggregate(F.map_values("sparse"), F.lit(0.0), lambda acc, w: acc + w.cast("double"))
    return both.select(
        "doc_id", F.size("sparse").cast("bigint").alias("n_terms"), F.round(total, 2).alias("sparse_total"),
        F.round(F.array_max("dense").cast("double"), 5).alias("dense_peak"))


@query("""
SELECT vec_id AS doc_id, CASE label WHEN 3 THEN 63::BIGINT ELSE -1::BIGINT END AS found_dim
FROM embeddings WHERE label IN (3, 4)""")
def vector_dim_check(spark, d):
    """Vectors of one label are cut short and those of another removed; the check must find exactly these."""
    damaged = F.when(F.col("cell") == 3, F.slice("embedding", 1, 63)).when(F.col("cell") != 4, F.col("embedding"))
    vectors = fx.vectors(spark, d).withColumn("embedding", damaged)
    return vector.dimension_errors(vectors, 64).select("doc_id", "found_dim")
