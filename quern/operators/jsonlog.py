"""Nested JSON in text columns: decoding, safe access, and reading agent logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Closes the array a text is wrapped in; no JSON text ends with it by accident.
END_MARK = '"\\u0003end"'


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def parse_whole(text: Column) -> Column:
    """The text as one JSON value, null when it is not exactly that.

    ``try_parse_json`` stops after the first value, so "5 stars" would read as 5;
    inside an array closed by a mark the whole text has to parse.
    """
    wrapped = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f",{END_MARK}]")))
    return _let(F.try_variant_get(wrapped, "$", "array<variant>"),
                lambda pair: F.when(F.size(pair) == 2, F.get(pair, F.lit(0))))


def _parse_lines(text: Column) -> Column:
    """Lines that each hold one JSON value, as an array; null when any line does not."""
    lines = F.filter(F.split(F.trim(text), "\n"), lambda s: F.trim(s) != "")
    return _let(lines, lambda ls: F.when(
        F.forall(ls, lambda s: parse_whole(s).isNotNull()),
        F.try_parse_json(F.concat(F.lit("["), F.array_join(ls, ","), F.lit("]")))))


def decode(text: Column) -> Column:
    """A text as VARIANT: one JSON value, else JSON lines as an array, else the text itself.

    Blank text decodes to an empty array.
    """
    return _let(text, lambda t: F.coalesce(parse_whole(t), _parse_lines(t), t.cast("variant")))


def _text(value: Column) -> Column:
    """The string a VARIANT holds, null for any other type."""
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def at(value: Column, path: str) -> Column:
    """The part of a VARIANT at ``path``, decoded again when it is itself JSON text; null when absent."""
    return _let(F.try_variant_get(value, path, "variant"), lambda part: F.coalesce(decode(_text(part)), part))


def get_or(value: Column, path: str, kind: str, default) -> Column:
    """A typed value at ``path``, or ``default`` when any step is missing."""
    return F.coalesce(F.try_variant_get(value, path, kind), F.lit(default))


def _items(value: Column) -> Column:
    """The elements of a VARIANT array, null when it is not an array."""
    return F.try_variant_get(value, "$", "array<variant>")


def _lines(items: Column, line) -> Column:
    return F.array_join(F.transform(items, line), "\n")


def _entry(kind: str, content: Column) -> Column:
    return F.struct(F.lit(kind).alias("type"), content.alias("content"))


def _generated(value: Column) -> Column:
    return _let(_items(at(value, "$.output.message.content")), lambda parts: F.when(
        F.size(parts) > 0, _entry("text", get_or(F.get(parts, F.lit(0)), "$.text", "string", ""))))


def _facets(value: Column) -> Column:
    line = lambda b: F.concat(
        F.try_variant_get(b, "$.key", "string"), F.lit(" ("), F.try_variant_get(b, "$.doc_count", "string"), F.lit(")"))
    return _let(_items(at(value, "$.aggregations.categories.buckets")), lambda buckets: F.when(
        F.size(buckets) > 0, _entry("category_aggregation", _lines(buckets, line))))


def _hits(value: Column) -> Column:
    source = lambda h: F.try_variant_get(h, "$._source", "variant")
    line = lambda h: get_or(h, "$._source.item_name", "string", "")
    return _let(_items(value), lambda hits: F.when(
        source(F.get(hits, F.lit(0))).isNotNull(),
        _entry("search_results", _lines(F.filter(hits, lambda h: source(h).isNotNull()), line))))


def _final(value: Column) -> Column:
    return _let(_text(value), lambda t: F.when(
        (t != "") & ~F.startswith(t, F.lit("{")), _entry("final_response", t)))


def _classify(value: Column) -> Column:
    """The first rule that fits decides: generated text, category buckets, a list of hits, plain final text."""
    return _let(value, lambda v: F.coalesce(_generated(v), _facets(v), _hits(v), _final(v)))


def classify_outputs(logs: DataFrame, response: str, *keep: str) -> DataFrame:
    """Typed entries of agent responses: ``(*keep, step, position, type, content)``.

    Outputs not named ``response`` are ignored.
    """
    results = logs.select(*keep, at(decode(F.col(response)), "$.inference_results").alias("_steps"))
    outputs = (
        results.select(*keep, F.posexplode(_items(F.col("_steps"))).alias("step", "_result"))
        .select(*keep, "step", F.posexplode(_items(at(F.col("_result"), "$.output"))).alias("position", "_output"))
        .where(F.try_variant_get("_output", "$.name", "string") == "response")
        .select(*keep, "step", "position", at(F.col("_output"), "$.result").alias("_value"))
    )
    return (
        outputs.select(*keep, "step", "position", _classify(F.col("_value")).alias("_found"))
        .where(F.col("_found").isNotNull())
        .select(*keep, "step", "position", "_found.*")
    )
