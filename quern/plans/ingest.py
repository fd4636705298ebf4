"""From source folders to searchable tables: read, enrich, chunk, key, encode, store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import encoders
from quern.operators import prepare
from quern.session import stage
from quern.sources import names, readers, sinks
from quern.sources.keyed import KeyedTable


def question_files(folder: str, categories: Sequence[str] | None = None) -> list[str]:
    """Paths of the wanted categories, all of them for ``None``; an unknown name is an error."""
    by_name = {stem.replace("&", "and").replace("_", " "): file
               for stem, file in zip(names.CATEGORY_STEMS, names.CATEGORY_FILES)}
    unknown = sorted(set(categories or []) - set(by_name))
    if unknown:
        valid = ", ".join(sorted(f"'{n}'" for n in by_name))
        raise ValueError(f"Unknown category name {', '.join(unknown)}\nValid names: {valid}")
    return [f"{folder}/{by_name[n]}" for n in (categories or by_name)]


def questions(spark: SparkSession, folder: str, categories: Sequence[str] | None = None, limit: int = -1,
              on_error: str = "fail", quarantine: str | None = None) -> DataFrame:
    """Question documents of the wanted categories, enriched, chunked and keyed.

    ``limit`` counts lines per category before any is dropped. Malformed lines fail the load, or with another ``on_error``
    are stored below the folder ``quarantine``, which is then required, with their file names.
    """
    if on_error != "fail" and not quarantine:
        raise ValueError("name a quarantine folder for the malformed lines")
    raw = readers.read_json_lines(spark, question_files(folder, categories), on_error=on_error)
    raw = raw.select("*", *readers.in_file_order()).withColumn("category_name", names.category_value(F.col("file_name")))
    kept = prepare.per_source_limit(raw, "category_name", ["_file", "_block", "_row"], limit).drop(
        "_file", "_block", "_row", "file_name")
    if on_error != "fail":
        kept = stage(kept, "questions")
        kept.where(F.col(readers.BAD).isNotNull()).select("category_name", readers.BAD).write.mode("append").parquet(quarantine)
        kept = kept.where(F.col(readers.BAD).isNull()).drop(readers.BAD)
    enriched = prepare.enrich_answers(prepare.concat_bullets(kept), prepare.text_key("question_id"))
    return prepare.drop_short_chunks(prepare.question_chunk(enriched)).withColumn("_id", F.col("question_id"))


def passages(spark: SparkSession, folder: str, domains: Sequence[str] | None = None, limit: int = -1,
             multi_line: bool = True) -> DataFrame:
    """Passages of the wanted domains, chunked and keyed; an no list, an empty one or one with an invalid domain means all of them."""
    valid = names.PASSAGE_DOMAINS
    wanted = domains if domains and set(domains) <= set(valid) else valid
    raw = readers.read_passages(spark, [f"{folder}/{d}/corpus.tsv" for d in wanted], multi_line=multi_line, with_order=True)
    kept = prepare.per_source_limit(raw, "domain", ["_file", "_block", "_row"], limit).drop("_file", "_block", "_row")
    chunked = prepare.passage_chunk(prepare.drop_blank_passages(kept))
    return chunked.withColumn("_id", prepare.composite_key("domain", "pid"))


def encode(docs: DataFrame, dense_dim: int | None = None, sparse: bool = False,
           dense_factory: encoders.DenseFactory | None = None,
           sparse_factory: encoders.SparseFactory | None = None) -> DataFrame:
    """Add the dense and/or sparse column of the chunk text, both in one pass."""
    if dense_dim:
        docs = encoders.dense_encode(docs, {"chunk_text": "chunk_embedding"}, dense_dim, dense_factory)
    if sparse:
        docs = encoders.sparse_encode(docs, {"chunk_text": "chunk_sparse_embedding"}, sparse_factory)
    return docs


def load(docs: DataFrame, path: str, partition: str, version: Sequence[str], mode: str = "upsert", buckets: int = 64,
         source: str | None = None, batch: int = 0) -> DataFrame:
    """Load into the stored table at ``path``, made if absent, and return its load report.

    ``upsert`` keeps stored rows and replaces those whose ``_id`` comes again, by the last version of each; ``replace`` starts
    from an empty table. Rows are sorted by ``partition`` inside each bucket. See ``KeyedTable`` for the rest.
    """
    if mode not in ("upsert", "replace"):
        raise ValueError(f"mode is upsert or replace, not {mode}")
    table = KeyedTable.create(docs.sparkSession, path, docs.schema, ["_id"], buckets, [partition],
                              if_exists="replace" if mode == "replace" else "keep")
    table.load(docs, version, source, batch)
    return sinks.load_report(table.read(), partition)
