"""Benchmark decontamination with an FM-index per training shard.

A shard is a bounded run of whole documents inside one task, so nothing is shuffled. Its words are
numbered by the vocabulary of the test phrases; words that no phrase has can be in no
occurrence, so they only cut the text, and only runs of phrase words that are long enough
for some phrase are indexed (exactly: whatever is left out cannot match). The index is a suffix array
sampled at every ``SAMPLE``-th word and a wavelet matrix over the Burrows-Wheeler transform.
All phrases are searched backwards together: each step narrows the suffix interval of every phrase by
two rank queries. Occurrences are located by walking to the nearest sampled suffix, and their words are
merged into spans per document.

The test phrases are a stated query set. They are read in blocks of at most ``block_words``
words; each block is one more pass over the documents in the same stage, so what a task
holds of them is bounded whatever the size of the benchmark.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. A window is ``window``
consecutive words of an item; a shorter item (not an empty one) is one window. Null texts have no
words. Repeated rows are separate documents; item ids that are null are written ``null``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quern.llm.text import map_chunks, text_bytes

WINDOW = 10
SHARD_BYTES = 12 << 20
BLOCK_WORDS = 4_000_000
SAMPLE = 8

# The bytes that part words, all ASCII but digits and letters.
_PARTS = bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))
_TO_SPACE = bytes.maketrans(_PARTS + b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b" " * len(_PARTS) + b"abcdefghijklmnopqrstuvwxyz")
_WORD = re.compile(rb"[^ ]+")


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TO_SPACE).split() if text else []


class WaveletMatrix:
    """Rank queries over numbers: one bit vector with block counts per binary digit."""

    def __init__(self, values: np.ndarray, digits: int):
        self.levels = []
        for digit in range(digits - 1, -1, -1):
            bits = (values >> digit) & 1
            ones = np.concatenate([[0], np.cumsum(bits, dtype=np.int32)]).astype(np.int32)
            zeros = len(values) - int(ones[-1])
            self.levels.append((digit, ones, zeros))
            values = np.concatenate([values[bits == 0], values[bits == 1]])

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol stands among the first ``end`` values."""
        starts = np.zeros_like(ends)
        for digit, ones, zeros in self.levels:
            one = ((symbols >> digit) & 1).astype(bool)
            a, b = ones[starts], ones[ends]
            starts, ends = np.where(one, zeros + a, starts - a), np.where(one, zeros + b, ends - b)
        return ends - starts


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by doubling the compared length until all ranks differ."""
    n, width = len(symbols), 1
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    while True:
        second = np.zeros(n, dtype=np.int64)
        second[:n - width] = rank[width:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        step = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = step
        if n == 0 or step[-1] == n - 1:
            return order
        width *= 2


class FMIndex:
    """Backward search over a sequence of symbols >= 1; 0 parts texts and no phrase may cross it."""

    def __init__(self, symbols: np.ndarray, top: int):
        text = np.concatenate([symbols, [0]])
        # Every separator sorts by its place, so suffixes differ at the first one.
        cuts = np.flatnonzero(text == 0)
        distinct = text + len(cuts)
        distinct[cuts] = np.arange(len(cuts))[::-1]
        order = suffix_array(distinct)
        last = text[order - 1]
        self.size = len(text)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        self.wavelet = WaveletMatrix(last, max(1, int(top).bit_length()))
        self.last = last
        sampled = (order % SAMPLE == 0) | (last == 0)
        self.sampled = np.concatenate([[0], np.cumsum(sampled)])
        self.places = order[sampled]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals of phrases given as rows padded on the right."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), self.size, dtype=np.int64)
        for at in range(phrases.shape[1] - 1, -1, -1):
            live = np.flatnonzero((lengths > at) & (low < high))
            if not len(live):
                continue
            symbol = phrases[live, at]
            start = self.first[symbol]
            low[live] = start + self.wavelet.rank(symbol, low[live])
            high[live] = start + self.wavelet.rank(symbol, high[live])
        return low, np.maximum(high, low)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of suffix rows, by stepping left to the nearest sampled suffix."""
        rows, steps = rows.copy(), np.zeros(len(rows), dtype=np.int64)
        while True:
            far = np.flatnonzero(self.sampled[rows + 1] == self.sampled[rows])
            if not len(far):
                return self.places[self.sampled[rows]] + steps
            symbol = self.last[rows[far]]
            rows[far] = self.first[symbol] + self.wavelet.rank(symbol, rows[far])
            steps[far] += 1


class Phrases:
    """One block of test items: numbered vocabulary, distinct windows and the items of each window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.names = [name for name, _ in items]
        found: dict[tuple, set[int]] = {}
        self.vocabulary: dict[bytes, int] = {}
        for number, (_, words) in enumerate(items):
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            for start in range(max(1, len(ids) - window + 1) if ids else 0):
                found.setdefault(tuple(ids[start:start + window]), set()).add(number)
        self.lengths = np.array([len(p) for p in found], dtype=np.int64)
        self.windows = np.zeros((len(found), window), dtype=np.int64)
        for row, phrase in enumerate(found):
            self.windows[row, :len(phrase)] = phrase
        self.items = [sorted(v) for v in found.values()]
        self.shortest = int(self.lengths.min()) if len(found) else 0


def occurrences(ids: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Start places in ``ids`` (0: no phrase word, or a cut) and the window that stands there."""
    known = np.concatenate([[0], (ids > 0).astype(np.int8), [0]])
    edges = np.diff(known)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    long = ends - starts >= max(1, phrases.shortest)
    starts, ends = starts[long], ends[long]
    none = np.zeros(0, dtype=np.int64)
    if not len(starts) or not len(phrases.lengths):
        return none, none
    sizes = ends - starts + 1  # with the cut behind the run
    at = np.cumsum(sizes) - sizes
    source = np.arange(int(sizes.sum())) - np.repeat(at - starts, sizes)
    symbols = np.where(source < len(ids), ids[np.minimum(source, len(ids) - 1)], 0)
    symbols[at + sizes - 1] = 0
    index = FMIndex(symbols, len(phrases.vocabulary))
    low, high = index.search(phrases.windows, phrases.lengths)
    count = high - low
    rows = np.arange(int(count.sum())) + np.repeat(low - (np.cumsum(count) - count), count)
    return source[index.locate(rows)], np.repeat(np.arange(len(low)), count)


_STATE = "n_words bigint, spans binary, items array<string>"


def _search_pass(df: DataFrame, columns: list[str], text_col: str, block, window: int, first: bool, shard_bytes: int, cut: bool) -> DataFrame:
    """One block of test phrases; with ``cut`` the words found so far leave the text."""
    fields = [f for f in df.schema if f.name in columns]
    schema = StructType(fields + list(StructType.fromDDL(_STATE)))
    state = ["n_words", "spans", "items"]

    def work(chunk: pa.Table) -> Iterator[pa.RecordBatch]:
        phrases = block.value
        get = phrases.vocabulary.get
        parts, bounds = [], [0]
        for text in chunk.column(text_col).to_pylist():
            words = words_of(text)
            part = np.zeros(len(words) + 1, dtype=np.int64)
            part[:-1] = np.fromiter((get(w, 0) for w in words), dtype=np.int64, count=len(words))
            parts.append(part)
            bounds.append(bounds[-1] + len(part))
        bounds = np.array(bounds)
        starts, windows = occurrences(np.concatenate(parts), phrases)
        n_words = np.diff(bounds) - 1
        spans = [b""] * len(n_words) if first else chunk.column("spans").to_pylist()
        items = [[]] * len(n_words) if first else chunk.column("items").to_pylist()
        order = np.argsort(starts, kind="stable")
        starts, windows = starts[order], windows[order]
        owner = np.searchsorted(bounds, starts, side="right") - 1
        for doc in np.unique(owner):
            a, b = np.searchsorted(owner, [doc, doc + 1])
            begin = starts[a:b] - bounds[doc]
            pairs = np.stack([begin, begin + phrases.lengths[windows[a:b]]], axis=1)
            old = np.frombuffer(spans[doc], dtype=np.int64).reshape(-1, 2)
            spans[doc] = merge_spans(np.concatenate([old, pairs])).tobytes()
            new = {phrases.names[i] for w in np.unique(windows[a:b]) for i in phrases.items[w]}
            items[doc] = sorted(new.union(items[doc]))
        out = [chunk.column(f.name).combine_chunks() for f in fields]
        if cut:
            at = [f.name for f in fields].index(text_col)
            out[at] = pa.array([without_spans(t, s) for t, s in zip(out[at].to_pylist(), spans)], pa.string())
        out += [
            pa.array(n_words, pa.int64()), pa.array(spans, pa.binary()), pa.array(items, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(out, names=[f.name for f in fields] + state)
    return map_chunks(df, [f.name for f in fields] + ([] if first else state), text_bytes(text_col), shard_bytes, work, schema)


def merge_spans(pairs: np.ndarray) -> np.ndarray:
    """Sorted disjoint ``(start, end)`` word spans covering the same words."""
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    fresh = np.concatenate([[True], pairs[1:, 0] > reach[:-1]])
    ends = reach[np.concatenate([np.flatnonzero(fresh)[1:] - 1, [len(pairs) - 1]])]
    return np.stack([pairs[fresh, 0], ends], axis=1)


def phrase_blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_words: int) -> Iterator[Phrases]:
    """The test items in blocks of bounded size; one empty block if there are none."""
    items, held, blocks = [], 0, 0
    for name, text in benchmark.select(F.col(item_col).cast("string"), F.col(text_col)).toLocalIterator():
        words = words_of(text)
        items.append(("null" if name is None else name, words))
        held += len(words)
        if held >= block_words:
            yield Phrases(items, window)
            items, held, blocks = [], 0, blocks + 1
    if items or not blocks:
        yield Phrases(items, window)


def find_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
               shard_bytes: int = SHARD_BYTES, keep: list[str] | None = None, cut: bool = False) -> DataFrame:
    """The columns ``keep`` of each row with ``n_words``, ``spans`` (int64 pairs of word places,
    sorted and disjoint, as bytes) and ``items`` (ids of the items found, sorted). Kept
    columns of these names are replaced. With ``cut`` the text comes without the words of the spans."""
    context = docs.sparkSession.sparkContext
    state = ("n_words", "spans", "items")
    columns = [c for c in (docs.columns if keep is None else keep) if c not in state]
    df, first = docs.drop(*state), True
    wanted = list(dict.fromkeys([*columns, text_col]))
    blocks = phrase_blocks(benchmark, item_col, item_text_col, window, block_words)
    phrases = next(blocks)
    while phrases is not None:
        following = next(blocks, None)
        df = _search_pass(df, wanted, text_col, context.broadcast(phrases), window, first, shard_bytes, cut and following is None)
        phrases, first = following, False
    return df.select(*columns, *state)


def hits_of(spans: bytes) -> int:
    pairs = np.frombuffer(spans, dtype=np.int64).reshape(-1, 2)
    return int((pairs[:, 1] - pairs[:, 0]).sum())


def digest_rows(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`` from ``find_spans``."""
    def run(batches):
        for batch in batches:
            n_hit = [hits_of(s) for s in batch.column("spans").to_pylist()]
            items = batch.column("items").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), pa.array(n_hit, pa.int64()),
                 pa.array([len(i) for i in items], pa.int64()),
                 pa.array([hashlib.sha256(",".join(i).encode()).hexdigest() for i in items], pa.string()),
                 pa.array([n > 0 for n in n_hit], pa.bool_())], names=names)
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    kind = dict(found.dtypes)[id_col]
    schema = f"doc_id {kind}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"
    return found.select(F.col(id_col).alias("doc_id"), "n_words", "spans", "items").mapInArrow(run, schema)


def without_spans(text: str | None, spans: bytes) -> str | None:
    """The text without the words of the spans and what parts them inside a span."""
    pairs = np.frombuffer(spans, dtype=np.int64).reshape(-1, 2)
    if text is None or not len(pairs):
        return text
    raw = text.encode("utf-8", "surrogatepass")
    places = [m.span() for m in _WORD.finditer(raw.translate(_TO_SPACE))]
    kept, at = [], 0
    for start, end in pairs:
        kept.append(raw[at:places[start][0]])
        at = places[end - 1][1]
    return b"".join([*kept, raw[at:]]).decode("utf-8", "surrogatepass")


def remove_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The input's rows and columns, the test passages cut out of the text."""
    others = [c for c in docs.columns if c != text_col]
    packed = docs.select(F.struct(*others, F.lit(0).alias("_")).alias("row"), F.col(text_col).cast("string").alias("text"))
    cleaned = find_spans(packed, benchmark, keep=["row", "text"], cut=True, **options)
    return cleaned.select(*(F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns))
