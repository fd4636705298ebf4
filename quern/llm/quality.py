"""Quality classifier: a generalised additive model with pairwise interactions.

Per feature of the text a lookup table over bins, and per chosen pair of features a table over
both bins, all learned by cyclic boosting: one shallow tree on one feature after the other,
a small step each, then the same over the pairs that reduce the remaining loss most. A score is the
logistic of a sum of table entries, looked up for a whole batch at once.

The model is fitted on the driver from at most ``max_rows`` labelled documents (those of
smallest hash of their id; 20,000 rows of 18 numbers), everything else stays spread: the text is
read once to get the features of that sample and once to score. Labels, language, source and id are no features.

Null text scores as empty text. Repeated rows score alike. Null labels are ignored, contradicting
labels of an id vote (a draw counts as 1), labels without document are unused. Without labels
the score is 0.5; with one class it is near that class.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quern.llm.text import map_chunks, text_bytes

MAX_ROWS = 20_000
ROUNDS = 120
PAIR_ROUNDS = 60
PAIRS = 6
RATE = 0.1
BINS = 32
PAIR_BINS = 8
ACCEPT = 0.3
CHUNK_BYTES = 8 << 20

FEATURES = ("chars", "words", "word_length", "distinct_words", "top_word", "repeated_neighbours", "upper", "digits", "punctuation",
            "symbols", "bars", "sentence_ends", "lines", "distinct_lines", "short_words", "marked_words", "non_ascii", "distinct_pairs")

_BYTES = np.arange(256)
_IS = {
    "upper": (_BYTES >= 65) & (_BYTES <= 90), "digits": (_BYTES >= 48) & (_BYTES <= 57), "non_ascii": _BYTES >= 128,
    "punctuation": np.isin(_BYTES, list(b".,;:'\"()?-")), "symbols": np.isin(_BYTES, list(b"!#$%&*+/<=>@[\\]^_`{}~")),
    "bars": _BYTES == 124, "sentence_ends": np.isin(_BYTES, list(b".!?")),
}


def features(text: str | None) -> list[float]:
    """The numbers of one text, in the order of ``FEATURES``; zeros for an empty one."""
    raw = text.encode("utf-8", "surrogatepass") if text else b""
    words = raw.split()
    if not words:
        return [float(len(raw) > 0)] + [0.0] * (len(FEATURES) - 1)
    n, size = len(words), len(raw)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = {k: float(counts[v].sum()) / size for k, v in _IS.items()}
    by_word = Counter(words)
    lines = raw.split(b"\n")
    lengths = list(map(len, words))
    return [
        float(np.log1p(size)), float(np.log1p(n)), sum(lengths) / n, len(by_word) / n, max(by_word.values()) / n,
        sum(map(eq, words, words[1:])) / n, share["upper"], share["digits"], share["punctuation"], share["symbols"], share["bars"],
        share["sentence_ends"], len(lines) / n, len(set(lines)) / len(lines), sum(1 for k in lengths if k <= 3) / n,
        sum(map(_MARKED.__contains__, (w[-1] for w in words))) / n, share["non_ascii"],
        len(set(zip(words, words[1:]))) / max(1, n - 1),
    ]


_MARKED = frozenset(b"!#$%&*+/<=>@\\^_`{}~|")


@dataclass
class GamModel:
    """Bin edges and tables. ``pairs`` index coarser bins, every so many of the fine ones."""
    bias: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, j], side="right")]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[np.searchsorted(self.pair_edges[a], x[:, a], side="right"),
                           np.searchsorted(self.pair_edges[b], x[:, b], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins)) if len(values) else np.zeros(0)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf values per bin of a tree with up to three leaves on one feature."""
    out = np.zeros(len(g))
    leaves = [(0, len(g))]
    for _ in range(2):
        best = (1e-9, None, None)
        for a, b in leaves:
            if b - a < 2:
                continue
            left_g, left_h = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            total_g, total_h = g[a:b].sum(), h[a:b].sum()
            gains = _gain(left_g, left_h) + _gain(total_g - left_g, total_h - left_h) - _gain(total_g, total_h)
            k = int(np.argmax(gains))
            if gains[k] > best[0]:
                best = (gains[k], (a, b), a + k + 1)
        if best[1] is None:
            break
        (a, b), cut = best[1:]
        leaves.remove((a, b))
        leaves += [(a, cut), (cut, b)]
    for a, b in leaves:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + 1.0)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and leaf values of the best tree with one cut on either feature (four leaves)."""
    quarters = []
    for m in (g, h):
        c = m.cumsum(0).cumsum(1)
        a = c[:-1, :-1]
        quarters.append((a, c[:-1, -1:] - a, c[-1:, :-1] - a, c[-1, -1] - c[:-1, -1:] - c[-1:, :-1] + a))
    gains = sum(_gain(x, y) for x, y in zip(*quarters)) - _gain(g.sum(), h.sum())
    out = np.zeros(g.shape)
    if not gains.size:
        return 0.0, out
    i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
    for k, (rows, columns) in enumerate(((slice(0, i + 1), slice(0, j + 1)), (slice(0, i + 1), slice(j + 1, None)),
                                         (slice(i + 1, None), slice(0, j + 1)), (slice(i + 1, None), slice(j + 1, None)))):
        out[rows, columns] = quarters[0][k][i, j] / (quarters[1][k][i, j] + 1.0)
    return float(gains[i, j]), out


def fit_gam(x: np.ndarray, y: np.ndarray) -> GamModel:
    """Cyclic boosting on the logistic loss, first the single features, then the pairs."""
    if not len(y):
        return GamModel(0.0)
    model = GamModel(float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))))
    model.edges = [_edges(x[:, j], BINS) for j in range(x.shape[1])]
    model.pair_edges = [_edges(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.edges)]
    coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(model.pair_edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(len(y), model.bias)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)
    for _ in range(ROUNDS):
        for j, table in enumerate(model.tables):
            g, h = slopes()
            step = RATE * _tree(np.bincount(bins[j], g, len(table)), np.bincount(bins[j], h, len(table)))
            table += step
            total += step[bins[j]]

    def pair_sums(a: int, b: int, g: np.ndarray, h: np.ndarray) -> list[np.ndarray]:
        shape = (len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1)
        cell = coarse[a] * shape[1] + coarse[b]
        return [np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in (g, h)]
    g, h = slopes()
    ranked = sorted(((-_pair_tree(*pair_sums(a, b, g, h))[0], a, b) for a in range(x.shape[1]) for b in range(a)))
    model.pairs = [(a, b) for gain, a, b in ranked[:PAIRS] if gain < 0]
    model.pair_tables = [np.zeros((len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1)) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (a, b), table in zip(model.pairs, model.pair_tables):
            step = RATE * _pair_tree(*pair_sums(a, b, *slopes()))[1]
            table += step
            total += step[coarse[a], coarse[b]]
    return model


def held_out(id_col: Column) -> Column:
    """Whether an id is kept from learning: crc32 of its text mod 5 is 0; a null id is not."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
                  text_col: str = "text", max_rows: int = MAX_ROWS) -> DataFrame:
    """``(doc_id, label, features)`` of at most ``max_rows`` labelled documents that are not held out."""
    voted = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
             .groupBy(F.col(id_col).alias("doc_id")).agg((F.avg(F.col(label_col)) >= 0.5).cast("double").alias("label")))
    drawn = voted.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(drawn), "doc_id")
    kind = dict(chosen.dtypes)["doc_id"]

    def work(chunk: pa.Table) -> Iterator[pa.RecordBatch]:
        found = [features(t) for t in chunk.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([chunk.column("doc_id").combine_chunks(), chunk.column("label").combine_chunks(),
                                          pa.array(found, pa.list_(pa.float64()))], names=["doc_id", "label", "features"])
    rows = map_chunks(chosen, ["doc_id", "label", "text"], text_bytes("text"), CHUNK_BYTES, work,
                      f"doc_id {kind}, label double, features array<double>")
    return rows.groupBy("doc_id").agg(F.min("label").alias("label"), F.min("features").alias("features"))


def fit(docs: DataFrame, labels: DataFrame, **options) -> GamModel:
    """The model learned from ``labels`` of ``docs``; see ``training_rows`` for the options."""
    rows: pd.DataFrame = training_rows(docs, labels, **options).toPandas().sort_values("doc_id")
    x = np.array(rows["features"].tolist(), dtype=float).reshape(len(rows), len(FEATURES))
    return fit_gam(x, rows["label"].to_numpy(dtype=float))


def score(docs: DataFrame, model: GamModel, text_col: str = "text", keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """The columns ``keep`` (all) of each row and the score as column ``name``; a kept column of that name is replaced."""
    columns = [c for c in (docs.columns if keep is None else keep) if c != name]
    schema = StructType([docs.schema[c] for c in columns] + [StructField(name, DoubleType())])

    def work(chunk: pa.Table) -> Iterator[pa.RecordBatch]:
        x = np.array([features(t) for t in chunk.column(text_col).to_pylist()], dtype=float).reshape(-1, len(FEATURES))
        yield pa.RecordBatch.from_arrays([*(chunk.column(c).combine_chunks() for c in columns), pa.array(model.score(x))],
                                         names=[*columns, name])
    return map_chunks(docs, list(dict.fromkeys([*columns, text_col])), text_bytes(text_col), CHUNK_BYTES, work, schema)
