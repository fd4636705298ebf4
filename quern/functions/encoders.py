"""Encoder hooks: dense and sparse representations, and answer generation.

An encoder factory is called once per Python worker task and returns a function
on a batch of texts, so a model is loaded once and not per row. The default
encoders are deterministic and need no model.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.session import ship_package

DenseFactory = Callable[[], Callable[[list[str]], np.ndarray]]
SparseFactory = Callable[[], Callable[[list[str]], list[dict[str, float]]]]
AnswerFactory = Callable[[], Callable[[list[str]], list[str]]]

ROWS_AT_ONCE = 512  # Spark's batches may hold ten thousand texts, whose encodings would lie beside them

_WORD = regex.compile(r"[\p{L}\p{N}]+")


def hashed_bag_of_words(dim: int) -> DenseFactory:
    """Unit vector of token counts in ``dim`` buckets; a token's bucket is taken from its MD5."""
    def load():
        @lru_cache(1 << 18)
        def bucket(token: str) -> int:
            return int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % dim

        def encode(texts: list[str]) -> np.ndarray:
            out = np.zeros((len(texts), dim))
            for row, text in zip(out, texts):
                row += np.bincount([bucket(t) for t in _WORD.findall(text.lower())], minlength=dim)
            norm = np.linalg.norm(out, axis=1, keepdims=True)
            return out / np.where(norm == 0.0, 1.0, norm)
        return encode
    return load


def _encoded(df: DataFrame, encode, field_map: dict[str, str]) -> DataFrame:
    """Apply an encoder once per row.

    Marked non-deterministic so that no filter on its output is pushed below it,
    which would run the model a second time.
    """
    once = encode.asNondeterministic()
    return df.withColumns({target: once(F.col(source)) for source, target in field_map.items()})


def _pieces(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        for at in range(0, len(batch), ROWS_AT_ONCE):
            yield batch.iloc[at:at + ROWS_AT_ONCE]


def dense_encode(df: DataFrame, field_map: dict[str, str], dim: int, factory: DenseFactory | None = None) -> DataFrame:
    """Add an ``array<float>`` column for each ``{text column: vector column}``."""
    ship_package(df.sparkSession)
    load = factory or hashed_bag_of_words(dim)

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        run = load()
        for batch in _pieces(batches):
            vectors = np.asarray(run(batch.fillna("").tolist()), dtype=np.float32)
            if vectors.shape != (len(batch), dim):
                raise ValueError(f"encoder returned shape {vectors.shape}, expected {(len(batch), dim)}")
            yield pd.Series(list(vectors), index=batch.index)

    return _encoded(df, encode, field_map)


def sparse_encode(df: DataFrame, field_map: dict[str, str], factory: SparseFactory | None = None) -> DataFrame:
    """Add a ``map<string, float>`` of token weights for each ``{text column: map column}``.

    The default weight ``ln(1 + tf)`` is counted per text by the same hook.
    """
    ship_package(df.sparkSession)
    load = factory or log_term_frequency

    @F.pandas_udf(T.MapType(T.StringType(), T.FloatType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        run = load()
        for batch in _pieces(batches):
            yield pd.Series(run(batch.fillna("").tolist()), index=batch.index)

    return _encoded(df, encode, field_map)


def log_term_frequency():
    from collections import Counter

    def encode(texts: list[str]) -> list[dict[str, float]]:
        return [{t: float(np.log1p(n)) for t, n in Counter(_WORD.findall(text.lower())).items()} for text in texts]
    return encode


def generate_answers(prompts: DataFrame, factory: AnswerFactory, prompt: str = "prompt", answer: str = "answer") -> DataFrame:
    """Add the answer of an injected client to every prompt row; the client is opened once per task."""
    ship_package(prompts.sparkSession)
    schema = T.StructType([*prompts.schema.fields, T.StructField(answer, T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = factory()
        for batch in batches:
            yield batch.assign(**{answer: ask(batch[prompt].fillna("").tolist())})

    return prompts.mapInPandas(run, schema)
