"""Facets, totals, comparison and formatting of hits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.text import or_na, text_or_empty
from quern.operators.lexical import match_counts
from quern.session import stage


def attach(hits: DataFrame, docs: DataFrame, *columns: str, how: str = "inner") -> DataFrame:
    """Source fields of the hits. Spark chooses the join by the bytes of the staged hit ids: while they are few they
    are sent to the scan and the corpus is not shuffled.

    Derive fields such as chunk text after this call, on the hits alone.
    """
    hits = stage(hits, "hits")
    wanted = hits.select("doc_id").distinct()
    found = docs.select("doc_id", *columns).join(wanted, "doc_id", "left_semi")
    return hits.join(found, "doc_id", how)


def facet(queries: DataFrame, docs: DataFrame, fields: Sequence[str], key: str, size: int = 10) -> DataFrame:
    """Top ``size`` values of ``key`` by matching documents; ties by value. No hits are computed."""
    counts = match_counts(queries, docs, fields, key)
    order = Window.partitionBy("query_id").orderBy(F.desc("doc_count"), F.asc(key))
    return (
        counts.withColumn("position", F.row_number().over(order))
        .where(F.col("position") <= size)
        .select("query_id", F.col("position").cast("bigint").alias("position"), key, "doc_count")
    )


def facet_map(facets: DataFrame, key: str) -> DataFrame:
    """The facet of each query as ``map<value, count>`` (at most the facet size)."""
    entries = F.array_sort(F.collect_list(F.struct("position", key, "doc_count")))
    pairs = F.transform(entries, lambda e: F.struct(e[key], e["doc_count"]))
    return facets.groupBy("query_id").agg(F.map_from_entries(pairs).alias("facet"))


def facet_lines(facets: DataFrame, key: str) -> DataFrame:
    """The facet of each query as ``value (count)`` lines in facet order."""
    line = F.format_string("%s (%d)", key, "doc_count")
    lines = F.array_sort(F.collect_list(F.struct("position", line.alias("line"))))
    return facets.groupBy("query_id").agg(F.array_join(F.transform(lines, lambda e: e["line"]), "\n").alias("lines"))


def total_hits(queries: DataFrame, docs: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Exact number of matching documents per query, zero included."""
    counts = match_counts(queries, docs, fields)
    return queries.select("query_id").join(counts, "query_id", "left").select(
        "query_id", F.coalesce("doc_count", F.lit(0)).cast("bigint").alias("total_hits"))


def distinct_texts(hits: DataFrame, text: str, size: int = 10) -> DataFrame:
    """The first ``size`` distinct texts per query, each at its best rank, numbered anew."""
    best = hits.groupBy("query_id", text).agg(F.min("rank").alias("rank"))
    order = Window.partitionBy("query_id").orderBy("rank")
    return (
        best.withColumn("position", F.row_number().over(order).cast("bigint"))
        .where(F.col("position") <= size)
        .select("query_id", "position", text)
    )


def compare(first: DataFrame, second: DataFrame, text: str, names: tuple[str, str], size: int = 10) -> DataFrame:
    """Two result lists side by side, aligned by position."""
    a = distinct_texts(first, text, size).withColumnRenamed(text, names[0])
    b = distinct_texts(second, text, size).withColumnRenamed(text, names[1])
    return a.join(b, ["query_id", "position"], "full_outer")


def distinct_hits(hits: DataFrame, digests: DataFrame, size: int = 10) -> DataFrame:
    """The first ``size`` hits of distinct texts per query, each at its best rank: ``(query_id, position, doc_id)``.

    ``digests(doc_id, digest)`` stands for the texts, so that none is moved before the cut.
    """
    best = hits.join(digests, "doc_id").groupBy("query_id", "digest").agg(F.min(F.struct("rank", "doc_id")).alias("best"))
    order = Window.partitionBy("query_id").orderBy("best.rank")
    return (best.withColumn("position", F.row_number().over(order).cast("bigint")).where(F.col("position") <= size)
            .select("query_id", "position", F.col("best.doc_id").alias("doc_id")))


def compare_hits(first: DataFrame, second: DataFrame, docs: DataFrame, text: str, names: tuple[str, str], size: int = 10) -> DataFrame:
    """Two legs of hits side by side as texts, aligned by position; the texts are read for the hits that remain."""
    legs = {names[0]: first, names[1]: second}
    ids = reduce(DataFrame.unionByName, [h.select("doc_id") for h in legs.values()]).distinct()
    digests = stage(docs.select("doc_id", text).join(ids, "doc_id", "left_semi").select("doc_id", F.md5(text).alias("digest")), "hit-digests")
    cut = reduce(DataFrame.unionByName, [distinct_hits(h, digests, size).withColumn("leg", F.lit(n)) for n, h in legs.items()])
    shown = docs.select("doc_id", text).join(cut, "doc_id")
    side = lambda n: F.max(F.when(F.col("leg") == n, F.col(text))).alias(n)
    return shown.groupBy("query_id", "position").agg(*(side(n) for n in legs))


def tag(hits: DataFrame, source: str, content: Column, metadata: Mapping[str, Column]) -> DataFrame:
    """Hits as ``(query_id, rank, doc_id, content, score, metadata, source)``."""
    pairs = [x for name, col in metadata.items() for x in (F.lit(name), text_or_empty(col.cast("string")))]
    return hits.select(
        "query_id", "rank", "doc_id", content.alias("content"), "score",
        F.create_map(*pairs).alias("metadata"), F.lit(source).alias("source"))


def union_results(*tagged: DataFrame) -> DataFrame:
    out = tagged[0]
    for other in tagged[1:]:
        out = out.unionByName(other)
    return out


def score_text(score: Column) -> Column:
    return F.round(score.cast("decimal(20,6)"), 4).cast("string")


def format_product(hits: DataFrame) -> DataFrame:
    """The display block of a product hit; missing fields read ``N/A``."""
    block = F.concat(
        F.lit("Score: "), score_text(F.col("score")), F.lit("\nCategory: "), or_na("category_name"),
        F.lit("\nProduct: "), or_na("item_name"), F.lit("\nBrand: "), or_na("brand_name"),
        F.lit("\nText: "), F.substring(or_na("chunk_text"), 1, 200), F.lit("...\n---"))
    return hits.withColumn("block", block)


def format_passage(hits: DataFrame) -> DataFrame:
    block = F.concat(
        F.lit("Score: "), score_text(F.col("score")), F.lit("\nDomain: "), or_na("domain"),
        F.lit("\nPID: "), or_na(F.col("pid").cast("string")),
        F.lit("\nPassage: "), F.substring(or_na("passage"), 1, 300), F.lit("\n---"))
    return hits.withColumn("block", block)


def answer_content(question: str = "question_text", answers: str = "answers") -> Column:
    """``Q: ...`` and ``A:`` with the first answer, empty when there is none."""
    first = F.get(F.col(answers), F.lit(0))["answer_text"]
    return F.concat(F.lit("Q: "), text_or_empty(question), F.lit("\nA: "), text_or_empty(first))
