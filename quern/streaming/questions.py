"""A stream of questions answered over a stored index.

Each micro-batch is one batched search over the index as it is then. Hits go to a stored table keyed by question and rank, under the id of
the streaming query and the number of the batch, so a replayed batch adds nothing, and readers see whole batches only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from quern.operators.segments import SearchIndex
from quern.sources.keyed import KeyedTable
from quern.streaming.incremental import _named


def answer_stream(stream: DataFrame, index: SearchIndex, boosts: Mapping[str, float], k: int, path: str, checkpoint: str,
                  buckets: int = 16) -> StreamingQuery:
    """Answer all questions ``(query_id, query_text)`` that have arrived, then stop; a question asked again gets new hits."""
    def answer(batch: DataFrame, batch_id: int, name: str) -> None:
        asked = batch.where("query_id IS NOT NULL").groupBy("query_id").agg(F.max("query_text").alias("query_text"))
        hits = index.search(asked, boosts, k)
        listed = F.array_sort(F.collect_list(F.struct("rank", "doc_id", "score")))
        answers = asked.select("query_id").join(hits.groupBy("query_id").agg(listed.alias("hits")), "query_id", "left")
        table = KeyedTable.create(batch.sparkSession, path, answers.schema, ["query_id"], buckets, if_exists="keep")
        table.load(answers, ["query_id"], source=name, batch=batch_id)
    return _named(stream, answer, checkpoint)


def index_stream(stream: DataFrame, index: SearchIndex, version: list[str], checkpoint: str) -> StreamingQuery:
    """Add all documents that have arrived to the index, one segment per micro-batch, and merge where segments pile up."""
    def add(batch: DataFrame, batch_id: int, name: str) -> None:
        index.add(batch, version, source=name, batch=batch_id)
        index.merge()
    return _named(stream, add, checkpoint)


def read_answers(table: KeyedTable) -> DataFrame:
    """``hits`` of all questions answered so far."""
    return table.read().select("query_id", F.inline("hits")).select("query_id", "rank", "doc_id", "score")
