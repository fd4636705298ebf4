"""Conversation memory and prompt tables.

Memory rows are ``(user_id, session_id, turn, role, text)`` with a turn number
that grows inside a session.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.text import text_or_empty
from quern.session import stage

SESSION = ["user_id", "session_id"]
TURNS_PER_CHUNK = 1000


def next_message(memory: DataFrame, columns: Sequence[str] = ("role", "text")) -> DataFrame:
    """Every message with its successor in the session as struct ``next`` (null at the end).

    A session of any length is spread over tasks: it is cut into chunks of turns,
    the successor is found inside the chunk, and the last message of a chunk
    takes the head of the next one (one head per chunk crosses the session window).
    """
    chunked = memory.withColumn("_chunk", F.floor(F.col("turn") / TURNS_PER_CHUNK))
    message = F.struct(*columns)
    inside = Window.partitionBy(*SESSION, "_chunk").orderBy("turn")
    heads = (
        chunked.groupBy(*SESSION, "_chunk").agg(F.min_by(message, "turn").alias("_head"))
        .withColumn("_next_head", F.lead("_head").over(Window.partitionBy(*SESSION).orderBy("_chunk")))
        .drop("_head")
    )
    keys = [*SESSION, "_chunk"]
    heads = heads.select(*(F.col(c).alias(f"_head_{c}") for c in keys), "_next_head")
    # Null-safe: messages whose user, session or turn is unknown stay.
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_head_{c}")) for c in keys))
    return (
        chunked.withColumn("_next", F.lead(message).over(inside))
        .join(heads, same)
        .withColumn("next", F.coalesce("_next", "_next_head"))
        .select(*memory.columns, "next")
    )


def turn_pairs(memory: DataFrame) -> DataFrame:
    """User turns followed by an assistant turn, as one interaction."""
    return next_message(memory).where((F.col("role") == "user") & (F.col("next.role") == "assistant")).select(
        *SESSION, "turn", F.col("text").alias("user_text"), F.col("next.text").alias("assistant_text"))


def interaction_rows(results: DataFrame) -> DataFrame:
    """Memory rows to append for ``(user_id, session_id, turn, query_text, summary)``.

    ``turn`` is the number of the user message; the summary follows it.
    """
    messages = F.array(
        F.struct(F.col("turn").alias("turn"), F.lit("user").alias("role"), F.col("query_text").alias("text")),
        F.struct((F.col("turn") + 1).alias("turn"), F.lit("assistant").alias("role"), F.col("summary").alias("text")))
    return results.select(*SESSION, F.inline(messages))


def with_next_turn(asked: DataFrame, memory: DataFrame) -> DataFrame:
    """Adds ``turn``, the number of the next message of the session (0 for a new one)."""
    last = memory.groupBy(*SESSION).agg((F.max("turn") + 1).alias("_next_turn"))
    return asked.join(last, SESSION, "left").withColumn("turn", F.coalesce("_next_turn", F.lit(0)).cast("bigint")).drop("_next_turn")


def append_interactions(results: DataFrame, path: str, buckets: int = 64) -> None:
    """Append the messages to the table at ``path``, in ``buckets`` folders by user.

    Messages that the table holds (same user, session, turn and role) are not written again, so a repeated append adds nothing.
    """
    spark = results.sparkSession
    new = interaction_rows(results).withColumn("bucket", F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("int"))
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    else:
        keys = ["bucket", *SESSION, "turn", "role"]
        held = stored.select(*(F.col(c).alias(f"_held_{c}") for c in keys))
        same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_held_{c}")) for c in keys))  # an unknown user or session is one too
        new = stage(new.join(held, same, "left_anti"), "interactions")
    new.write.mode("append").partitionBy("bucket").parquet(path)


def recent(memory: DataFrame, n: int = 10, role: str | None = None) -> DataFrame:
    """The ``n`` latest messages of each session, newest first as ``position`` 1..n."""
    rows = memory if role is None else memory.where(F.col("role") == role)
    newest = Window.partitionBy(*SESSION).orderBy(F.desc("turn"))
    return (
        rows.withColumn("position", F.row_number().over(newest).cast("bigint"))
        .where(F.col("position") <= n)
    )


def _joined(rows: DataFrame, keys: Sequence[str], order: str, line, separator: str, name: str) -> DataFrame:
    """One ordered text per key, over a number of rows bounded by a rank cut."""
    items = F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), line.alias("_l"))))
    return rows.groupBy(*keys).agg(
        F.array_join(F.transform(items, lambda e: e["_l"]), separator).alias(name))


def asked_sessions(memory: DataFrame, queries: DataFrame) -> DataFrame:
    """Only the sessions some query belongs to, before any message is shuffled."""
    return memory.join(queries.select(*SESSION).distinct(), SESSION, "left_semi")


def enhance_queries(queries: DataFrame, memory: DataFrame) -> DataFrame:
    """Add ``enhanced``: the query with the two latest user messages of its session as context."""
    line = F.concat(F.lit("Previous: "), text_or_empty("text"))
    context = _joined(recent(asked_sessions(memory, queries), 2, "user"), SESSION, "position", line, "; ", "_context")
    enhanced = F.concat("query_text", F.lit(" (Context: "), "_context", F.lit(")"))
    return (
        queries.join(context, SESSION, "left")
        .withColumn("enhanced", F.coalesce(enhanced, F.col("query_text")))
        .drop("_context")
    )


def summarise(queries: DataFrame, totals: DataFrame, hits: DataFrame, name: str = "item_name") -> DataFrame:
    """One line per query: the total and the first three names, or that nothing was found."""
    top = hits.where(F.col("rank") <= 3)
    names = _joined(top, ["query_id"], "rank", F.coalesce(F.col(name), F.lit("Unknown")), ", ", "_names")
    found = F.concat(F.lit("Found "), F.coalesce("total_hits", F.lit(0)).cast("string"),
                     F.lit(" results. Top items: "), "_names")
    return (
        queries.select("query_id").join(totals, "query_id", "left").join(names, "query_id", "left")
        .select("query_id", F.coalesce(found, F.lit("No results found (0 hits)")).alias("summary"))
    )


def answer_turn(asked: DataFrame, memory: DataFrame, search: Callable[[DataFrame], DataFrame], path: str, name: str = "item_name") -> DataFrame:
    """One turn of many sessions: ``asked(query_id, user_id, session_id, query_text)`` is put into the context of its session, searched with,
    summarised and appended to the table at ``path``. Returns ``(query_id, user_id, session_id, turn, query_text, enhanced, summary)``.

    ``search`` takes ``(query_id, query_text)``, the text with its context, and returns hits with the column ``name``; their number is the
    total of the summary. The question itself, not the text searched with, is remembered. A turn that is stored already is not stored again.
    """
    enhanced = stage(with_next_turn(enhance_queries(asked, memory), memory), "turn-questions")
    hits = stage(search(enhanced.select("query_id", F.col("enhanced").alias("query_text"))), "turn-hits")
    totals = hits.groupBy("query_id").agg(F.count("*").alias("total_hits"))
    answered = enhanced.join(summarise(enhanced, totals, hits, name), "query_id").select(
        "query_id", *SESSION, "turn", "query_text", "enhanced", "summary")
    answered = stage(answered, "turn-answers")
    append_interactions(answered, path)
    return answered


def context(hits: DataFrame, fields: Sequence[str], size: int = 10) -> DataFrame:
    """The given fields of up to ``size`` hits per query as one text, best hit first."""
    entry = F.concat_ws("\n", *[F.concat(F.lit(f"{f}: "), text_or_empty(F.col(f).cast("string"))) for f in fields])
    return _joined(hits.where(F.col("rank") <= size), ["query_id"], "rank", entry, "\n\n", "context")


def history(memory: DataFrame, size: int = 10) -> DataFrame:
    """The latest ``size`` messages of each session as text, oldest first."""
    rows = recent(memory, size).withColumn("_age", -F.col("position"))
    return _joined(rows, SESSION, "_age", F.concat("role", F.lit(": "), text_or_empty("text")), "\n", "history")


def prompts(queries: DataFrame, contexts: DataFrame, histories: DataFrame, system: str, instructions: str) -> DataFrame:
    """One prompt per query: system text, instructions, history, context and question."""
    return (
        queries.join(contexts, "query_id", "left").join(histories, SESSION, "left")
        .select("query_id", *SESSION, F.concat_ws(
            "\n\n", F.lit(system), F.lit(instructions),
            F.concat(F.lit("History:\n"), text_or_empty("history")),
            F.concat(F.lit("Context:\n"), text_or_empty("context")),
            F.concat(F.lit("Question: "), text_or_empty("query_text"))).alias("prompt"))
    )


def session_summary(memory: DataFrame) -> DataFrame:
    """Messages per role and the latest user text of each session, from partial aggregates."""
    return memory.groupBy(*SESSION).agg(
        F.count_if(F.col("role") == "user").alias("user_turns"),
        F.count_if(F.col("role") == "assistant").alias("assistant_turns"),
        F.count(F.lit(1)).alias("turns"),
        F.max_by("text", F.when(F.col("role") == "user", F.col("turn"))).alias("last_user_text"))


def user_preferences(memory: DataFrame) -> DataFrame:
    """The same grouping by user alone: sessions, messages and user turns."""
    return memory.groupBy("user_id").agg(
        F.count_distinct("session_id").alias("sessions"), F.count(F.lit(1)).alias("turns"),
        F.count_if(F.col("role") == "user").alias("user_turns"))
