"""The registered queries of this subpackage: one per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import (bag_search, contamination, jaccard, katz, language, line_dedup, mixing, order_minhash, quality, secrets, spelling,
                       url_templates, warc)
from quern.llm.registry import query
from quern.session import new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# SQL: A-Z lower-cased; the white space that the contracts strip.
_FOLD = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query(f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split),
keyed AS (SELECT *, {_FOLD.format(f"trim(line, {_SPACE})")} AS key FROM lines),
hot AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT k.doc_id, count(*) AS n_lines, count(hot.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE hot.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN hot ON k.key = hot.key GROUP BY k.doc_id""")
def op10_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Lines that stand in at least 10 documents leave all of them."""
    cleaned = line_dedup.dedup_lines(table(spark, d, "documents").select("doc_id", "text"), min_docs=10)
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query()
def op1_mixing(spark: SparkSession, d: str) -> DataFrame:
    """Every document's part in a mix by Sainte-Laguë apportionment."""
    return mixing.mix(table(spark, d, "documents")).drop("source")


_WORDS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_FOLD.format("coalesce(text, '')"))


@query(rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, list_slice(w, s, s + least(len(w), 10) - 1) AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n),
found AS (SELECT p.doc_id, p.s, p.n, i.item_id FROM places p JOIN windows i ON p.n = i.n AND list_slice(p.w, p.s, p.s + p.n - 1) = i.phrase),
hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS place FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""")
def op4_decontamination(spark: SparkSession, d: str) -> DataFrame:
    """Words of each document that stand in windows of test items."""
    found = contamination.find_spans(table(spark, d, "documents"), table(spark, d, "benchmark"), keep=["doc_id"])
    return contamination.digest_rows(found)


@query()
def op3_quality(spark: SparkSession, d: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.fit(docs, table(spark, d, "labels")), keep=["doc_id"])
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= quality.ACCEPT).cast("int").alias("predicted"))


@query()
def op6_ngram_jaccard(spark: SparkSession, d: str) -> DataFrame:
    """Components of documents whose sets of three-word shingles are 90 % alike."""
    return jaccard.near_duplicates(table(spark, d, "documents"), width=3, percent=90)


@query()
def op2_katz(spark: SparkSession, d: str) -> DataFrame:
    """Log probability of every document under a trigram back-off model of the documents that are not held out."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))
    return katz.train_and_score(table(spark, d, "documents"), ~held_out, order=3)


@query()
def op8_order_minhash(spark: SparkSession, d: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they and the next document's are."""
    docs = table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = order_minhash.with_next(order_minhash.with_fingerprint(docs, "text", "print", fill=True), "doc_id", "text", ["text", "print"])
    docs = docs.withColumn("n_chars", F.length("text").cast("bigint"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - cut), F.substring("next_text", F.lit(1), cut))
    docs = order_minhash.with_fingerprint(docs.withColumn("edited", edited), "edited", "edited_print", fill=True)
    return docs.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), order_minhash.as_text(F.col("print")).alias("fingerprint"),
        order_minhash.as_text(F.col("edited_print")).alias("edited_fingerprint"),
        order_minhash.likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        order_minhash.likeness(F.col("print"), F.col("next_print")).alias("near_next"))


@query("""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, p.payload_digest, CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN firsts ON p.payload_digest = firsts.payload_digest AND payload_bytes >= 100""")
def op9_warc(spark: SparkSession, d: str) -> DataFrame:
    """Every page written to archives, read back and assembled."""
    pages = table(spark, d, "pages")
    path = new_folder(spark, "warc")
    warc.write_archives(warc.plan_captures(pages), path)
    found = warc.digests(warc.assemble(warc.read_records(spark, path, with_payload=False)))
    kind = dict(pages.dtypes)["page_id"]
    return found.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})


RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


@query()
def op5_url_templates(spark: SparkSession, d: str) -> DataFrame:
    """Rules, then path templates; a page is labelled by the document whose number its path holds, bad if poor or toxic."""
    labels = table(spark, d, "labels").groupBy("doc_id").agg(F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad"))
    _, path = url_templates.host_and_path(F.col("url"))
    pages = table(spark, d, "pages").select("page_id", "url", F.regexp_extract(path, r"([0-9]+)", 1).try_cast("bigint").alias("number"))
    return url_templates.judge(pages.join(labels, pages["number"] == labels["doc_id"], "left").select("page_id", "url", "bad"), RULES)


@query()
def op7_secrets(spark: SparkSession, d: str) -> DataFrame:
    """Every candidate secret of every document with the forest's verdict."""
    found = secrets.scan(table(spark, d, "documents"))
    return found.select("doc_id", "start", "n_chars", F.sha2("candidate", 256).alias("candidate_sha256"), "held_out", "label", "score", "predicted")


_TERMS = r"regexp_extract_all({0}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')".format(_FOLD.format("coalesce(text, '')"))


@query(rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS w FROM documents),
i AS (SELECT row_number() OVER () AS item, item_id, {_TERMS} AS w FROM (SELECT DISTINCT item_id, text FROM benchmark)),
asked AS (SELECT item, term, count(*) AS q FROM (SELECT item, unnest(w) AS term FROM i) GROUP BY ALL),
totals AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS length FROM d WHERE len(w) > 0),
marks AS (SELECT row, doc_id, 75 + (25 * len(w)::BIGINT * n_docs) // length AS m FROM d, totals WHERE len(w) > 0),
tfs AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tfs, totals GROUP BY term),
scores AS (SELECT item, row, sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM asked JOIN tfs USING (term) JOIN weights USING (term) JOIN marks USING (row) GROUP BY item, row),
ranked AS (SELECT item, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS LAST)::INTEGER AS rank
  FROM scores JOIN marks USING (row) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked JOIN i USING (item) WHERE rank <= 20""")
def op11_bag_search(spark: SparkSession, d: str) -> DataFrame:
    """The 20 best documents of every benchmark item, scored by classes of equal documents."""
    return bag_search.search(table(spark, d, "benchmark"), table(spark, d, "documents"), k=20)


_RUN = "[A-Za-z\u00C0-\u00FF]+"


@query(rf"""
WITH RECURSIVE crc AS (SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all({_FOLD.format("text")}, '{_RUN}')) AS run FROM documents) GROUP BY ALL),
bytes AS (SELECT run, n, list_prepend(4294967295, flatten(list_transform(string_split(id || ':' || run, ''),
    lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)::BIGINT] ELSE [192 + (ord(c) >> 6)::BIGINT, 128 + (ord(c) & 63)::BIGINT] END))) AS b FROM runs),
hashed AS (SELECT run, n, xor(list_reduce(b, lambda h, x: xor(h >> 8, t[(xor(h, x) & 255) + 1])), 4294967295) AS h FROM bytes, crc),
damaged AS (SELECT n, CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM damaged WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cuts AS (SELECT word, length(word) AS l, i, left(word, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
longer AS (SELECT DISTINCT c.word AS a, w.word AS b FROM cuts c JOIN words w ON c.rest = w.word),
pairs AS (SELECT a, b FROM longer UNION SELECT b, a FROM longer UNION
  SELECT x.word, y.word FROM cuts x JOIN cuts y ON x.i = y.i AND x.rest = y.rest AND x.l = y.l AND x.word <> y.word),
near AS (SELECT a AS word, count(*) AS n_near, max(n) AS most FROM pairs JOIN words ON b = word GROUP BY a),
best AS (SELECT near.word, min(b) AS best FROM near JOIN pairs ON a = near.word JOIN words w ON w.word = b AND w.n = most GROUP BY near.word),
formed AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 2 * w.n THEN best END AS form,
  CASE WHEN most >= 2 * w.n THEN most END AS form_n FROM words w LEFT JOIN near USING (word) LEFT JOIN best USING (word)),
ways AS (SELECT word, word AS stop FROM formed UNION ALL SELECT ways.word, f.form FROM ways JOIN formed f ON f.word = ways.stop WHERE f.form IS NOT NULL),
ends AS (SELECT ways.word, stop AS root FROM ways JOIN formed f ON f.word = stop WHERE f.form IS NULL)
SELECT word, n, n_near, form, form_n, root FROM formed JOIN ends USING (word)""")
def op12_spelling_variants(spark: SparkSession, d: str) -> DataFrame:
    """Every word with its number of near words, its form and its root."""
    return spelling.group_variants(table(spark, d, "documents"))


@query()
def op13_language(spark: SparkSession, d: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    found = language.predict(docs, language.fit(docs), keep=["doc_id"])
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")
