"""Corpus preparation: enrichment, chunk text, keys and filters. All row-local unless said."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.text import first_words, join_fields
from quern.schemas import BULLETS

MIN_CHUNK_CHARS = 5
CHUNK_WORDS = 500

# Fixed moduli and multipliers of the reproducible pseudo-random enrichment, one of each per attribute:
# with one multiplier for all, small keys would give nearly the same value to every attribute.
MODULI = {101: 10007, 211: 10009, 307: 10037, 401: 10039, 13: 10061, 503: 10067, 601: 10069}
KEY_FACTORS = {101: 7283, 211: 7465, 307: 8969, 401: 3988, 13: 5616, 503: 3342, 601: 1547}
POSITION_FACTOR = 104729

GIVEN_NAMES = ["Ada", "Ben", "Cleo", "Dan", "Eve", "Finn", "Gus", "Hana"]
FAMILY_NAMES = ["Adler", "Brook", "Costa", "Dale", "Endo", "Frost", "Gray"]


def concat_bullets(docs: DataFrame) -> DataFrame:
    """The five bullet fields as one text; a missing bullet counts as empty."""
    return docs.withColumn("bullets", join_fields(*BULLETS)).drop(*BULLETS)


def uniform(key: Column, position: Column, salt: int) -> Column:
    """A reproducible value in [0, 1) for a whole-number key, stable across task retries.

    Every attribute (``salt``) takes the remainder by a prime of its own, before multiplying by a factor of its own, so no key overflows.
    """
    modulus = MODULI[salt]
    rest = lambda value: F.pmod(value.cast("bigint"), F.lit(modulus))
    mixed = rest(key) * F.lit(KEY_FACTORS[salt]) + rest(position) * F.lit(POSITION_FACTOR) + F.lit(salt)
    return F.pmod(mixed, F.lit(modulus)) / F.lit(float(modulus))


def gender_of(u: Column) -> Column:
    return F.when(u > 0.95, "other").when(u > 0.475, "female").otherwise("male")


def age_of(u: Column) -> Column:
    return F.bround(u * 100).cast("bigint")


def rating_of(u: Column) -> Column:
    return (F.floor(u * 100 / 20) + 1).cast("bigint")


def pick(names: list[str], u: Column) -> Column:
    return F.get(F.array(*[F.lit(n) for n in names]), F.floor(u * len(names)).cast("int"))


def enrich_answers(docs: DataFrame, key: Column, answers: str = "answers") -> DataFrame:
    """Add name, place, gender, age and rating to every answer; no answers stay none. Other fields of an answer are kept."""
    made = ("name", "user_lat", "user_lon", "gender", "age", "product_rating")
    fields = [f for f in docs.schema[answers].dataType.elementType.names if f not in made]

    def extend(answer: Column, i: Column) -> Column:
        u = lambda salt: uniform(key, i, salt)
        return F.struct(
            *(answer[f].alias(f) for f in fields),
            F.concat_ws(" ", pick(GIVEN_NAMES, u(101)), pick(FAMILY_NAMES, u(211))).alias("name"),
            F.round(u(307) * 180 - 90, 6).alias("user_lat"),
            F.round(u(401) * 360 - 180, 6).alias("user_lon"),
            gender_of(u(13)).alias("gender"),
            age_of(u(503)).alias("age"),
            rating_of(u(601)).alias("product_rating"),
        )
    return docs.withColumn(answers, F.transform(answers, extend))


def text_key(col: Column | str) -> Column:
    """A numeric enrichment key for text ids."""
    return F.pmod(F.xxhash64(col), F.lit(2**31))


def explode_answers(docs: DataFrame, *keep: str) -> DataFrame:
    """One row per answer with its position; documents without answers keep one empty row."""
    return docs.select(*keep, F.posexplode_outer("answers").alias("position", "answer")).select(
        *keep, "position", "answer.*")


def question_chunk(docs: DataFrame, words: int = CHUNK_WORDS) -> DataFrame:
    """Chunk text of a product document: description, brand, item, cut to ``words`` words."""
    joined = join_fields("product_description", "brand_name", "item_name")
    return docs.withColumn("chunk_text", first_words(joined, words))


def passage_chunk(docs: DataFrame, words: int = CHUNK_WORDS) -> DataFrame:
    return docs.withColumn("chunk_text", first_words("passage", words))


def drop_short_chunks(docs: DataFrame) -> DataFrame:
    return docs.where(F.length("chunk_text") >= MIN_CHUNK_CHARS)


def drop_blank_passages(docs: DataFrame) -> DataFrame:
    """Blank means white space only in the sense of ``functions.text.WHITESPACE``."""
    return docs.where(first_words("passage", 1) != "")


def composite_key(*cols: str) -> Column:
    return F.concat_ws("_", *[F.col(c).cast("string") for c in cols])


def per_source_limit(docs: DataFrame, source: str, order: Iterable[str], n: int) -> DataFrame:
    """The first ``n`` rows of each source; zero or less means all.

    Applied before chunk filters, so rows dropped later still use up the limit.
    The rank cut keeps ``n`` rows per source and task before the exchange.
    """
    if n <= 0:
        return docs
    nth = F.row_number().over(Window.partitionBy(source).orderBy(*order))
    return docs.withColumn("_nth", nth).where(F.col("_nth") <= n).drop("_nth")


def filter_categories(docs: DataFrame, wanted: list[str] | None, column: str,
                      valid: list[str] | None = None) -> DataFrame:
    """Keep the wanted categories; no list or an empty one means all, and so does a list with an invalid name."""
    if not wanted or (valid is not None and not set(wanted) <= set(valid)):
        return docs
    return docs.where(F.col(column).isin(list(wanted)))


def category_names(docs: DataFrame, column: str) -> DataFrame:
    """One row: the distinct names, quoted, sorted and comma separated.

    Names are made distinct before the single-row aggregate, so it holds the
    category dimension and never the corpus.
    """
    quoted = F.concat(F.lit("'"), F.col(column), F.lit("'"))
    return docs.select(quoted.alias("name")).distinct().agg(
        F.array_join(F.array_sort(F.collect_list("name")), ", ").alias("names"))


def dotted_keys(docs: DataFrame, map_column: str, *keep: str) -> DataFrame:
    """Rows whose map holds a key with a dot, with those keys."""
    keys = F.filter(F.map_keys(map_column), lambda k: F.contains(k, F.lit(".")))
    return docs.select(*keep, F.array_join(F.array_sort(keys), ",").alias("dotted")).where(F.col("dotted") != "")
