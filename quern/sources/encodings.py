"""Encodings stored by the content of the text, so that no text passes the model twice.

A row is ``(digest, embedding)``: the SHA-256 of the text (null counts as empty) and its vector, below a folder named after the
encoder. Such a row never changes: what decides it is in its key. So a load only ever adds a folder with the texts not yet
stored, loads side by side need no lock (a text that two of them encode is stored twice, equally, and read once), and a
failed load leaves nothing or valid rows.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import encoders
from quern.session import stage
from quern.sources.versions import VersionLog

_SCHEMA = "digest binary, embedding array<float>"


def digest(text: str | Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), 256))


class EncodingStore:
    """The encodings of one encoder; ``encoder`` names the model and its version, and ``dim`` is its dimension."""

    def __init__(self, spark: SparkSession, path: str, encoder: str, dim: int, factory: encoders.DenseFactory | None = None):
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", encoder):
            raise ValueError(f"an encoder's name has letters, digits and . _ - only, not {encoder!r}")
        self.spark, self.dim, self.factory = spark, dim, factory
        self.folder = f"{path.rstrip('/')}/{encoder}-{dim}"
        self._files = VersionLog(spark, self.folder)

    def stored(self) -> DataFrame:
        """``(digest, embedding)``, once per text. What follows by ``digest`` needs no further exchange."""
        loads = [c for c in self._files.children(self.folder) if c.startswith("load-")]
        if not loads:
            return self.spark.createDataFrame([], _SCHEMA)
        rows = self.spark.read.schema(_SCHEMA).parquet(*(f"{self.folder}/{c}" for c in loads))
        return rows.dropDuplicates(["digest"])

    def add(self, docs: DataFrame, text: str) -> int:
        """Encode the texts that are not stored yet, each once however often it occurs; returns how many these were."""
        texts = docs.select(digest(text).alias("digest"), F.coalesce(text, F.lit("")).alias("text"))
        # Copies go inside each task before the exchange; a digest decides its text.
        new = stage(texts.dropDuplicates(["digest"]).join(self.stored().select("digest"), "digest", "left_anti"), "unseen")
        n = new.count()
        if n:
            encoded = encoders.dense_encode(new, {"text": "embedding"}, self.dim, self.factory)
            encoded.select("digest", "embedding").write.parquet(f"{self.folder}/load-{uuid.uuid4().hex}")
        return n

    def lookup(self, docs: DataFrame, text: str, vector: str) -> DataFrame:
        """``docs`` with the stored encoding of ``text`` as column ``vector``, null where there is none.

        Copies of one text make a skewed join key on the side of ``docs``, which adaptive execution splits; the stored side is unique.
        """
        keyed = docs.withColumn("_digest", digest(text))
        found = self.stored().select(F.col("digest").alias("_digest"), F.col("embedding").alias(vector))
        return keyed.join(found, "_digest", "left").drop("_digest")

    def encode(self, docs: DataFrame, text: str, vector: str) -> DataFrame:
        """``add`` and ``lookup``: the same column as ``encoders.dense_encode``."""
        self.add(docs, text)
        return self.lookup(docs, text, vector)
