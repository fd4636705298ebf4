"""Spelling variants: words one edit apart, found through a trie of letter-group counts.

A word's letters fall into ``GROUPS`` groups (frequent letters in the first ones); its frequency vector holds how many letters
each group has. One edit changes the vector by a surplus of at most one and a deficit of at most one. Vectors are
arranged as a trie by successive counts, and a depth-first search walks it against the vectors of the words looked for,
spending that budget of one each; words of the leaves it reaches are verified letter by letter.

The trie is spread: a word is stored under the first ``LEVELS`` counts, a branch of more than ``SLICE`` words
is cut into slices, and branches are dealt to slots of about ``SLICE`` words. A word is sent to every slot whose branches its budget
reaches (``1 + LEVELS + LEVELS * (LEVELS - 1) / 2`` branches, since of two words the search starts from the one whose vector
is smaller). A task holds one slot, and its search at most ``FRONTIER`` pairs at once; a word leaves it with the number of its near words
and the best of them, never as pairs.

Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased; null or empty text has none. Every row counts,
repeated rows as often as they stand; a null id counts as empty text. Very long runs are words like others. Of near words with equal counts the
smallest in code-point order is the form. Without words the result is empty.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.text import map_chunks, text_bytes
from quern.session import ship_package, stage

GROUPS = 24
LEVELS = 4
SLICE = 40_000
FRONTIER = 1 << 19
LETTERS_AT_ONCE = 1 << 23
CHUNK_BYTES = 16 << 20
DAMAGE = 97

# Fixed rule: a-z from frequent to rare, then the accented letters, dealt to the groups in turn.
_LETTERS = "etaoinshrdlucmfwypvbgkjqxz" + "".join(map(chr, range(0xC0, 0x100)))
_GROUP = np.zeros(256, dtype=np.int64)
_GROUP[np.frombuffer(_LETTERS.encode("latin-1"), np.uint8)] = np.arange(len(_LETTERS)) % GROUPS

# Runs in Latin-1, one byte a code point: other bytes become blanks, A-Z lower case.
_RUN_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def _damaged(runs: Counter, row_id: str | None) -> Iterator[tuple[bytes, int]]:
    """Runs of one text after deletion of a letter where the checksum of id and run says so."""
    start = zlib.crc32(f"{row_id or ''}:".encode())
    for run, n in runs.items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % DAMAGE == 0:
            cut = h % len(run)
            run = run[:cut] + run[cut + 1:]
        yield run, n


def count_words(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_chars: int = 5, min_n: int = 3) -> DataFrame:
    """``(word, n)``: the words of all texts, counted inside each chunk before anything is shuffled."""
    def work(chunk: pa.Table) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for row_id, text in zip(chunk.column("id").to_pylist(), chunk.column("text").to_pylist()):
            runs = Counter(text.encode("latin-1", "replace").translate(_RUN_BYTES).split()) if text else {}
            for word, n in _damaged(runs, row_id):
                if len(word) >= min_chars:
                    total[word] += n
        words = pa.array([w.decode("latin-1") for w in total], pa.string())
        yield pa.RecordBatch.from_arrays([words, pa.array(total.values(), pa.int64())], names=["word", "n"])
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    counted = map_chunks(rows, ["id", "text"], text_bytes("text"), CHUNK_BYTES, work, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_n)


def _branch(counts: list[Column]) -> Column:
    return F.concat_ws(",", *(c.cast("string") for c in counts))


def _reached(counts: list[Column]) -> Column:
    """The branches of words whose vector is the same, or first differs by a surplus and then perhaps by a deficit."""
    def moved(up: int, down: int | None) -> Column:
        return _branch([c + 1 if i == up else c - 1 if i == down else c for i, c in enumerate(counts)])
    n = len(counts)
    return F.array(_branch(counts), *(moved(i, j) for i in range(n) for j in (None, *range(i + 1, n))))


def group_counts(words: list[bytes]) -> np.ndarray:
    """One row per word: letters per group."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    cells = np.repeat(np.arange(len(words), dtype=np.int64) * GROUPS, lengths) + _GROUP[np.frombuffer(b"".join(words), np.uint8)]
    return np.bincount(cells, minlength=len(words) * GROUPS).reshape(-1, GROUPS)


class VectorTrie:
    """Frequency vectors sorted by successive counts. A node of a level is a range of rows; ``keys`` of a level are
    ``parent * width + count``, ascending, so that a child is found by binary search."""

    def __init__(self, counts: np.ndarray, width: int):
        self.width = width
        self.order = np.lexsort(counts.T[::-1])
        ranked = counts[self.order]
        new = np.zeros(len(ranked), dtype=bool)
        new[:1] = True
        parent = np.zeros(len(ranked), dtype=np.int64)
        self.keys, self.children = [], []
        for level in range(GROUPS):
            new[1:] |= ranked[1:, level] != ranked[:-1, level]
            first = np.flatnonzero(new)
            self.keys.append(parent[first] * width + ranked[first, level])
            nodes = int(parent[-1]) + 1 if len(parent) else 0
            self.children.append(np.searchsorted(parent[first], np.arange(nodes + 1)))
            parent = np.cumsum(new) - 1
        self.leaves = np.append(np.flatnonzero(new), len(ranked))


def _spread(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each range its number, repeated, and the positions in it."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return owner, starts[owner] + inside


def leaf_pairs(asked: VectorTrie, stored: VectorTrie) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Leaves ``(asked, stored, spent)`` within the budget; spent is 0, 1 (a surplus) or 2 (and a deficit after it).

    Depth first: a piece of the frontier goes down to the leaves before its next sibling is opened."""
    if not len(asked.order) or not len(stored.order):
        return
    zero = np.zeros(1, dtype=np.int64)
    stack = [(0, zero, zero, zero)]
    while stack:
        level, a, b, spent = stack.pop()
        if level == GROUPS:
            yield a, b, spent
            continue
        first = asked.children[level]
        owner, child = _spread(first[a], first[a + 1] - first[a])
        count = asked.keys[level][child] % asked.width
        base, paid = b[owner] * stored.width + count, spent[owner]
        found = []
        for step, allowed, left in ((0, None, 0), (1, paid == 0, 1), (-1, (paid == 1) & (count > 0), 1)):
            index = np.arange(len(child)) if allowed is None else np.flatnonzero(allowed)
            key = base[index] + step
            place = np.searchsorted(stored.keys[level], key)
            place[place == len(stored.keys[level])] = 0
            hit = stored.keys[level][place] == key
            index = index[hit]
            found.append((child[index], place[hit], paid[index] + left))
        a, b, spent = (np.concatenate(x) for x in zip(*found))
        for start in range(0, len(a), FRONTIER):
            piece = slice(start, start + FRONTIER)
            stack.append((level + 1, a[piece], b[piece], spent[piece]))


def _one_edit(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Whether ``v`` is ``u`` with one letter replaced or, where it is longer, inserted."""
    near = np.zeros(len(u), dtype=bool)
    kinds = lengths[u] * 2 + (lengths[v] > lengths[u])
    order = np.argsort(kinds, kind="stable")
    bounds = np.flatnonzero(np.diff(kinds[order], prepend=-1, append=-1))
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        size, longer = divmod(int(kinds[order[lo]]), 2)
        step = max(1, LETTERS_AT_ONCE // size)
        for at in range(lo, hi, step):
            some = order[at:min(hi, at + step)]
            letters = np.arange(size)
            left = flat[starts[u[some]][:, None] + letters]
            same = left == flat[starts[v[some]][:, None] + letters]
            if longer:
                shifted = left == flat[starts[v[some]][:, None] + letters + 1]
                before = np.where(same.all(1), size, (~same).argmax(1))
                after = np.where(shifted.all(1), size, (~shifted[:, ::-1]).argmax(1))
                near[some] = before + after >= size
            else:
                near[some] = same.sum(1) == size - 1
    return near


def near_in_slot(words: list[bytes], stored: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs ``(u, v)`` of distinct words one edit apart: ``v`` is stored, and ``u`` has the smaller vector, or, with
    equal vectors, the smaller text (so each pair of the whole vocabulary comes up once)."""
    counts = group_counts(words)
    width = int(counts.max(initial=0)) + 3
    kept = np.flatnonzero(stored)
    asked, tree = VectorTrie(counts, width), VectorTrie(counts[kept], width)
    flat, lengths = np.frombuffer(b"".join(words), np.uint8), np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths) - lengths
    for a, b, spent in leaf_pairs(asked, tree):
        many, few = np.diff(asked.leaves)[a], np.diff(tree.leaves)[b]
        cut = np.searchsorted(np.cumsum(many * few), np.arange(FRONTIER, int((many * few).sum()), FRONTIER))
        for piece in np.split(np.arange(len(a)), np.unique(cut)):
            owner, left = _spread(asked.leaves[a[piece]], many[piece])
            again, right = _spread(tree.leaves[b[piece]][owner], few[piece][owner])
            u, v = asked.order[left[again]], kept[tree.order[right]]
            rising = (spent[piece][owner[again]] > 0) | (u < v)
            u, v = u[rising], v[rising]
            near = _one_edit(flat, starts, lengths, u, v)
            yield u[near], v[near]


def _best(words: list[bytes], n: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Per word with near words: how many, and the most frequent (of equals the smallest). Words come sorted."""
    u, v = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (zip(*pairs) if pairs else ((), ())))
    word, other = np.concatenate([u, v]), np.concatenate([v, u])
    order = np.lexsort((other, -n[other], word))
    word, other = word[order], other[order]
    first = np.flatnonzero(np.diff(word, prepend=-1))
    text = pa.array([w.decode("latin-1") for w in words], pa.string())
    return pa.RecordBatch.from_arrays(
        [text.take(pa.array(word[first])), pa.array(np.diff(np.append(first, len(word))), pa.int64()),
         pa.array(n[other[first]], pa.int64()), text.take(pa.array(other[first]))], names=["word", "n_near", "best_n", "best"])


def _search_slot(table: pa.Table) -> pa.Table:
    rows = pc.sort_indices(table, [("word", "ascending"), ("stored", "descending")])
    table = table.take(rows)
    words = [w.encode("latin-1") for w in table.column("word").to_pylist()]
    first = np.array([i == 0 or words[i] != words[i - 1] for i in range(len(words))], dtype=bool)
    words = [w for w, keep in zip(words, first) if keep]
    n = table.column("n").to_numpy()[first]
    stored = table.column("stored").to_numpy(zero_copy_only=False)[first]
    return pa.Table.from_batches([_best(words, n, list(near_in_slot(words, stored)))])


def near_words(words: DataFrame, levels: int = LEVELS, slice_words: int = SLICE) -> DataFrame:
    """``(word, n_near, best_n, best)`` of each of the distinct ``words(word, n)`` that has a near word."""
    ship_package(words.sparkSession)
    counts = [F.length("word") - F.length(F.translate("word", _LETTERS[g::GROUPS], "")) for g in range(levels)]
    routed = words.select("word", "n", _branch(counts).alias("home"), _reached(counts).alias("reached"))
    sizes = routed.groupBy(F.col("home").alias("branch")).agg(F.ceil(F.count("*") / slice_words).cast("int").alias("slices"))
    slots = max(1, math.ceil(words.count() / slice_words))
    spread = (routed.select("word", "n", "home", F.explode("reached").alias("branch")).join(sizes, "branch")
              .select("word", "n", "home", "branch", "slices", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice")))
    mine = (F.col("branch") == F.col("home")) & (F.pmod(F.xxhash64("word"), F.col("slices")) == F.col("slice"))
    rows = spread.select(F.pmod(F.xxhash64("branch", "slice"), F.lit(slots)).cast("int").alias("slot"), "word", "n", mine.alias("stored"))
    pieces = rows.repartition(slots, "slot").groupBy("slot").applyInArrow(
        lambda table: _search_slot(table), "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best"))).alias("best")
    return (pieces.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
            .select("word", "n_near", (-F.col("best.less")).alias("best_n"), F.col("best.best").alias("best")))


def roots(links: DataFrame) -> DataFrame:
    """``(word, root)`` of each link ``(word, form)``: forms followed to the last. Every round doubles the way covered;
    a form has at least twice the count of its word, so there is no circle and rounds are few."""
    reached = stage(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if reached.join(further, "root", "left_semi").isEmpty():
            return reached
        reached = stage(reached.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")


def group_variants(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_chars: int = 5, min_n: int = 3,
                   ratio: int = 2) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` of each word of the texts. ``form`` is the near word of largest count if
    that is at least ``ratio`` (2 or more) times the word's; ``root`` the last form on the way from the word, or the word itself."""
    words = stage(count_words(docs, text_col, id_col, min_chars, min_n), "spelling-words")
    near = near_words(words)
    formed = F.col("best_n") >= ratio * F.col("n")
    described = stage(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n")), "spelling-forms")
    last = roots(described.filter("form IS NOT NULL"))
    return described.join(last, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
