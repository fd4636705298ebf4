"""Lexical search: analysis, corpus statistics and BM25 over one or more fields."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.text import tokens
from quern.operators.matching import count_known, dot_topk, match_counts_by
from quern.session import dealt, stage

K1 = 1.2
B = 0.75
TERM = ["field", "token"]


def term_key() -> Column:
    """Field and token as one key (tokens hold only letters and digits)."""
    return F.concat_ws(":", "field", "token")


# Every document field also holds this one pseudo-token, so the table of postings
# carries the length of all fields, matched or not, and the corpus is read once.
LENGTH_MARK = ""


def field_type(schema: T.StructType, name: str) -> T.DataType | None:
    """The type of a column or of a dotted path below it (through arrays too: many values); None if there is none."""
    if name in schema.names:
        return schema[name].dataType
    kind, many = schema, False
    for part in name.split("."):
        if isinstance(kind, T.ArrayType):
            kind, many = kind.elementType, True
        if not isinstance(kind, T.StructType) or part not in kind.names:
            return None
        kind = kind[part].dataType
    return T.ArrayType(kind) if many else kind


def field_text(docs: DataFrame, name: str) -> Column:
    """The text of a field. The values of an array are one text with line breaks between them, which no token crosses."""
    kind = field_type(docs.schema, name)
    column = F.col(f"`{name}`") if name in docs.columns else F.col(name)
    while isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.ArrayType):
        column, kind = F.flatten(F.array_compact(column)), kind.elementType
    return F.array_join(column.cast("array<string>"), "\n") if isinstance(kind, T.ArrayType) else column


def known_fields(docs: DataFrame, fields: Sequence[str]) -> list[str]:
    """The fields the table has; the others are reported, since they can contribute nothing."""
    known = [f for f in fields if field_type(docs.schema, f) is not None]
    if not known:
        raise ValueError(f"none of the fields {list(fields)} exists")
    if len(known) < len(fields):
        warnings.warn(f"fields without a column contribute nothing: {sorted(set(fields) - set(known))}", stacklevel=3)
    return known


def analysed(docs: DataFrame, fields: Sequence[str], keep: Sequence[str] = (), han: str = "run") -> DataFrame:
    """One row per document and non-empty field: ``(doc_id, *keep, field, tokens)``.

    A field may hold many values: an array of text, or a dotted path into an array of structs such as ``answers.answer_text``.
    Its tokens and its length are those of all values. A field the table does not have contributes nothing, as in a search server.
    """
    known = known_fields(docs, fields)
    per_field = F.array(*[F.struct(F.lit(f).alias("field"), tokens(field_text(docs, f), han).alias("tokens")) for f in known])
    return (
        docs.select("doc_id", *keep, F.inline(per_field))
        .where(F.size("tokens") > 0)
    )


def _narrow(docs: DataFrame, fields: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """The columns an analysis reads."""
    wanted = {"doc_id", *keep, *(f if f in docs.columns else f.split(".")[0] for f in fields)}
    return docs.select(*(F.col(f"`{c}`") for c in docs.columns if c in wanted))


def token_counts(docs: DataFrame, fields: Sequence[str], keep: Sequence[str] = (), han: str = "run",
                 vocabulary: DataFrame | None = None, with_lengths: bool = False) -> DataFrame:
    """Term frequency per document and field: ``(doc_id, *keep, field, field_length, token, tf)``.

    With a ``vocabulary`` of ``(field, token)`` only its tokens are counted.
    """
    # Dealt out by document first, so a task counts whole documents: their texts move instead of their tokens, and no
    # task of the scan holds a count for every token of a table that is small on disk.
    rows = analysed(dealt(_narrow(docs, fields, keep), "doc_id"), fields, keep, han)
    listed = F.col("tokens")
    if with_lengths:
        listed = F.array_append(listed, F.lit(LENGTH_MARK))
    occurrences = rows.select("doc_id", *keep, "field", F.size("tokens").cast("bigint").alias("field_length"),
                              F.explode(listed).alias("token"))
    keys = ["doc_id", *keep, "field", "field_length", "token"]
    if vocabulary is not None:
        return count_known(occurrences, keys, vocabulary, TERM)
    return occurrences.groupBy(*keys).agg(F.count(F.lit(1)).alias("tf"))


def build_index(docs: DataFrame, fields: Sequence[str], keep: Sequence[str] = (), han: str = "run") -> DataFrame:
    """All postings and field lengths; write it once when many query batches follow.

    Partition the written table by ``field``: a search reads only its own fields. Document columns in ``keep``
    are stored with the postings, for searches that filter by them.
    """
    return token_counts(docs, fields, keep, han, with_lengths=True)


def postings_of(index: DataFrame) -> DataFrame:
    return index.where(F.col("token") != LENGTH_MARK)


def lengths_of(index: DataFrame) -> DataFrame:
    return index.where(F.col("token") == LENGTH_MARK).select("doc_id", "field", "field_length")


def field_stats(lengths: DataFrame) -> DataFrame:
    """Documents having the field, and their mean length: one row per field."""
    return lengths.groupBy("field").agg(
        F.count(F.lit(1)).alias("n_docs"), F.avg("field_length").alias("avg_length"))


def document_frequency(postings: DataFrame) -> DataFrame:
    return postings.groupBy(*TERM).agg(F.count(F.lit(1)).alias("df"))


def term_stats(index: DataFrame) -> DataFrame:
    """``(field, token, df, total_tf)`` over the corpus."""
    return postings_of(index).groupBy(*TERM).agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total_tf"))


def query_terms(queries: DataFrame, boosts: Mapping[str, float], han: str = "run") -> DataFrame:
    """Distinct query tokens against every searched field: ``(query_id, field, token, query_weight)``.

    A query without tokens yields no rows and so no hits.
    """
    fields = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(float(b)).alias("query_weight"))
                       for f, b in boosts.items()])
    return (
        queries.select("query_id", F.explode(F.array_distinct(tokens("query_text", han))).alias("token"))
        .select("query_id", "token", F.inline(fields))
        .select("query_id", "field", "token", term_key().alias("term"), "query_weight")
    )


def saturation(postings: DataFrame, stats: DataFrame) -> DataFrame:
    """The document side of a BM25 weight: ``tf / (tf + k1 (1 - b + b dl / avgdl))``.

    ``field_stats`` has one row per field named in the call, a proven bound, hence the broadcast.
    """
    norm = K1 * (1 - B + B * F.col("field_length") / F.col("avg_length"))
    return postings.join(F.broadcast(stats), "field").withColumn("doc_weight", F.col("tf") / (F.col("tf") + norm))


def with_idf(terms: DataFrame, postings: DataFrame, stats: DataFrame) -> DataFrame:
    """Query terms with their ``idf`` in ``query_weight``.

    The weight of a term goes to the few rows of the queries, so no posting is joined by its token and a stop word
    is only ever counted, by partial sums. Terms no document has match nothing and go.
    """
    idf = F.log1p((F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    return (
        terms.join(document_frequency(postings), TERM).join(F.broadcast(stats), "field")
        .select("query_id", "term", (F.col("query_weight") * idf).alias("query_weight"))
    )


def query_index(terms: DataFrame, docs: DataFrame, fields: Sequence[str], han: str = "run",
                index: DataFrame | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """The part of the index the query terms touch, and all field lengths, staged.

    Document frequency, mean length, weights and the size of the slices all read
    this table instead of tokenising the corpus again.
    """
    marks = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.lit(LENGTH_MARK).alias("token")) for f in fields]))
    lengths = terms.sparkSession.range(1).select(marks.alias("m")).select("m.*")
    vocabulary = terms.select(*TERM).distinct().unionByName(lengths)
    if index is not None:
        touched = index.where(F.col("field").isin(list(fields))).join(vocabulary, TERM, "left_semi")
    else:
        touched = token_counts(docs, fields, keep, han, vocabulary, with_lengths=True)
    return stage(touched, "postings")


def bm25_topk(queries: DataFrame, docs: DataFrame, boosts: Mapping[str, float], k: int,
              han: str = "run", index: DataFrame | None = None,
              allowed: DataFrame | Column | None = None) -> DataFrame:
    """BM25 top-k of many queries at once; the score sums ``boost * BM25`` over fields.

    ``allowed`` filters documents before ranking while the statistics stay corpus-wide: a condition on the
    columns of the documents (or of the index, see ``build_index``), which travels with the postings, or a table of ids.
    """
    return bm25_search(queries, docs, boosts, k, han, index, allowed)[0]


def bm25_search(queries: DataFrame, docs: DataFrame, boosts: Mapping[str, float], k: int,
                han: str = "run", index: DataFrame | None = None,
                allowed: DataFrame | Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Hits, query terms with their idf ``(query_id, term, query_weight)`` and ``field_stats`` of one search; see ``bm25_topk``."""
    keep = []
    if isinstance(allowed, Column):
        flag, keep = F.coalesce(allowed, F.lit(False)), ["_allowed"]
        docs, index = docs.withColumn("_allowed", flag), index.withColumn("_allowed", flag) if index is not None else None
    boosts = {f: boosts[f] for f in known_fields(docs, list(boosts))}
    terms = query_terms(queries, boosts, han)
    n_terms = terms.count()
    touched = query_index(terms, docs, list(boosts), han, index, keep)
    stats, postings = stage(field_stats(lengths_of(touched)), "field-stats"), postings_of(touched)
    weighted = saturation(postings.where("_allowed") if keep else postings, stats).select("doc_id", term_key().alias("term"), "doc_weight")
    if allowed is not None and not keep:
        weighted = weighted.join(allowed.select("doc_id"), "doc_id", "left_semi")
    weights = with_idf(terms, postings, stats)
    return dot_topk(weights, weighted, k, n_terms, touched.count()), weights, stats


def match_counts(queries: DataFrame, docs: DataFrame, fields: Sequence[str],
                 value: str | None = None, han: str = "run") -> DataFrame:
    """Exact number of matching documents per query, and per ``value`` when given.

    The facet value travels with the postings, so no join back to the documents.
    """
    boosts = {f: 1.0 for f in known_fields(docs, fields)}
    terms = query_terms(queries, boosts, han)
    keep = [value] if value else []
    n_terms = terms.count()
    postings = stage(token_counts(docs, list(boosts), keep, han, terms.select(*TERM).distinct())
                     .select("doc_id", *keep, term_key().alias("term")), "matches")
    return match_counts_by(terms, postings, value, n_terms, postings.count())
