"""LM scoring with a Katz back-off model of any order, trained and evaluated over all texts.

Tokens are words (A-Z lower-cased) and one end per text. Counts up to ``TOP`` are discounted by Good-Turing, per order;
the mass freed in a context goes to words not seen after it, in proportion to their lower-order probability::

    P(w | u v) = d(c) c / C(u v)   if c = count(u v w) > 0   else   alpha(u v) P(w | v)
    P(w | v)   = d(c) c / C(v)     if c = count(v w) > 0     else   alpha(v) P(w)
    P(w)       = d(c) c / N        if c = count(w) > 0       else   what is left: P(unknown)

``alpha(h) = (1 - sum seen P(w | h)) / (1 - sum seen P(w | h without its first word))`` makes every context sum to one exactly. A
context whose counts are all above ``TOP`` frees nothing; there ``C(h)`` is raised by one. Contexts never seen have ``alpha = 1``. Where the
counts of counts give no valid Good-Turing discount, a fixed share ``n1 / (n1 + 2 n2)`` of a count is taken (0.5 without ``n1``).
A text starts with one mark, so its first word has that mark as context in all orders and its second one word more at most.

How it runs. Texts are cut into *blocks* of some megabytes; a block numbers its own vocabulary and sends every distinct token
or n-gram once, with its count, as packed arrays, instead of one row per token:

1. Token counts are merged per hash bucket and returned to the blocks with a number for each token, frequent ones having small numbers.
2. For each order from 2 on, n-grams go, with the counts of their lower-order parts, to the bucket of their context. Contexts that
   hold more than a quarter of a bucket's share of all tokens are spread over all buckets by the last word, and only their sums meet
   again (at most four such contexts per bucket and order). The buckets are the stored n-gram tables: contexts in ascending order with
   what their weights are made of, and the counts of their n-grams.
3. Counts of counts are summed, back-off weights computed per bucket, and the answers return to the blocks: counts,
   a weight for each context that has an unseen word in the block, and the place of each n-gram in its table, which is its number as a
   context of the next order.

Most contexts stand in one block only, as their bucket sees. What follows them is asked by nobody else, so the block counts it from its own
tokens, with the same formulas, and sends only its counts of counts: the stored tables hold the n-grams of contexts shared by blocks.
An n-gram whose lower-order part stands in one block only, or was never trained, has a count that the block knows as well: of these only the
counts are sent, for the sums of their context, neither the word nor a request.

A task holds one block or one bucket; there is a bucket for each ``BUCKET_TOKENS`` tokens (at least one per shuffle partition), so both have
a bound at any size. Tables below the shared folder carry everything from step to step; blocks and answers are stored bucketed
by the block's number, so that an answer is moved once, to where it is stored, and read from there by all later steps. Tokens are
identified by 64-bit hashes.

Null text is empty text (one token, the end). Repeated rows count and are scored each; null ids train.
Without training texts all tokens are unknown, with probability one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.text import folded_words, map_chunks, text_bytes
from quern.session import new_folder, ship_package

TOP = 5
BLOCK_BYTES = 8 << 20
BUCKET_TOKENS = 4_000_000
START = -2
UNKNOWN = -1


def pack(values: np.ndarray) -> bytes:
    """An array as compressed bytes, bytes of equal weight together. Integers of a sorted array are best packed as differences."""
    values = np.ascontiguousarray(values)
    rows = values.view(np.uint8).reshape(len(values), values.itemsize)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(rows.T).tobytes())


def unpack(data: bytes, kind=np.int64) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(kind)


def _pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=values.dtype.type(0)))


def _unpack_sorted(data: bytes, kind=np.int64) -> np.ndarray:
    return np.cumsum(unpack(data, kind), dtype=kind)


def discounts(counts_of_counts: list[int]) -> np.ndarray:
    """``d(1) .. d(TOP)`` from the numbers of n-grams that occur 1 .. TOP + 1 times."""
    n = np.array(counts_of_counts, dtype=float)
    r = np.arange(1, TOP + 1)
    if (n > 0).all():
        cut = (TOP + 1) * n[TOP] / n[0]
        d = ((r + 1) * n[1:] / n[:-1] / r - cut) / (1 - cut) if cut != 1 else np.zeros(TOP)
        if ((d > 0) & (d < 1)).all():
            return d
    share = n[0] / (n[0] + 2 * n[1]) if n[0] > 0 and n[1] > 0 else 0.5
    return (r - share) / r


def discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    """``d(c) c``; counts above ``TOP`` and 0 as they are."""
    return counts * np.concatenate([[1.0], d, [1.0]])[np.minimum(counts, TOP + 1)]


@dataclass
class Unigrams:
    """What every task needs of the tokens: total, distinct, discounts."""
    total: int
    distinct: int
    d: np.ndarray
    counts_of_counts: list[int]

    def __post_init__(self):
        freed = sum((1 - d) * r * n for r, d, n in zip(range(1, TOP + 1), self.d, self.counts_of_counts))
        self.denominator = self.total if freed > 0 else self.total + 1
        self.unknown = (freed or 1.0) / self.denominator

    def p(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, discounted(counts, self.d) / self.denominator, self.unknown)


def context_weights(total: np.ndarray, seen: np.ndarray, lower: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """``alpha`` and denominator of contexts from their count, the discounted counts seen and the lower-order probabilities of the
    words seen; ``least`` is a lower bound of what these leave."""
    short = total - seen <= 1e-9
    denominator = total + short
    return (denominator - seen) / denominator / np.maximum(1 - lower, least), denominator


@dataclass
class Model:
    """What is known of the model while it grows: tokens, discounts of the orders from 2 on."""
    unigrams: Unigrams
    texts: int
    buckets: int
    d: list[np.ndarray]

    def heavy(self, counts: np.ndarray) -> np.ndarray:
        """Contexts that are spread over the buckets."""
        return counts * 4 * self.buckets > self.unigrams.total

    def least(self, order: int) -> float:
        return self.unigrams.unknown if order == 2 else 1e-15

    def discounts(self, order: int) -> np.ndarray:
        return self.unigrams.d if order == 1 else self.d[order - 2]


# --- blocks -----------------------------------------------------------------------------------------------------------------

class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _blocks(docs: DataFrame) -> DataFrame:
    """One row per block: ids, flags and lengths of its texts, its tokens (places in ``vocab``), sorted token hashes, training counts."""
    kind = dict(docs.dtypes)["doc_id"]
    state = {"next": 0}

    def work(chunk: pa.Table) -> Iterator[pa.RecordBatch]:
        numbers, parts, lengths = _Numbers({b"": 0}), [], []
        for text in chunk.column("text").to_pylist():
            words = folded_words(text)
            part = np.zeros(len(words) + 1, np.int32)
            part[:-1] = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
            parts.append(part)
            lengths.append(len(part))
        tokens = np.concatenate(parts)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, len(numbers))
        order = np.argsort(hashes)
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        tokens = place[tokens]
        train = np.array(chunk.column("train").to_pylist(), dtype=bool)
        counts = np.bincount(tokens[np.repeat(train, lengths)], minlength=len(order))
        block = (TaskContext.get().partitionId() << 24) + state["next"]
        state["next"] += 1
        yield pa.RecordBatch.from_arrays([
            pa.array([block]), pa.array([chunk.column("doc_id").to_pylist()], pa.list_(chunk.schema.field("doc_id").type)),
            pa.array([pack(train)], pa.binary()), pa.array([pack(np.array(lengths, np.int64))], pa.binary()),
            pa.array([pack(tokens)], pa.binary()), pa.array([_pack_sorted(hashes[order])], pa.binary()),
            pa.array([pack(counts.astype(np.int64))], pa.binary()), pa.array([int(train.sum())]), pa.array([len(tokens)])],
            names=["block", "ids", "train", "lengths", "tokens", "vocab", "counts", "texts", "words"])
    return map_chunks(docs, ["doc_id", "train", "text"], text_bytes("text"), BLOCK_BYTES, work,
                      f"block bigint, ids array<{kind}>, train binary, lengths binary, tokens binary, vocab binary, counts binary, texts bigint, "
                      "words bigint")


def _bucket_ends(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Sorted hashes fall into ``buckets`` equal ranges: the ends of their slices."""
    bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    return np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))


class _Tokens:
    """Order 1: the tokens of a block with their numbers and counts; the start of a text is one more, behind the last. Tokens of no
    other block (``own``) have no number, but a negative one to tell them apart. ``by_rank`` are the tokens by ascending number."""
    order = 1

    def __init__(self, hashes: np.ndarray, tokens: np.ndarray, counts: np.ndarray, answers: pd.DataFrame, model: Model):
        n = len(hashes)
        ends = _bucket_ends(hashes, model.buckets)
        self.ident, self.count = np.full(n + 1, START, np.int64), np.full(n + 1, model.texts, np.int64)
        self.own = np.zeros(n + 1, bool)
        self.count[:n] = counts
        for bucket, places, shared in zip(answers["bucket"], answers["first"], answers["second"]):
            part = np.arange(ends[bucket], ends[bucket + 1])
            marked = unpack(places)
            self.own[part] = marked & 1
            self.ident[part] = np.where(marked & 1, START - 1 - part, (marked >> 1) * model.buckets + int(bucket))
            common = part[(marked & 1) == 0]
            self.count[common[np.argsort(-self.ident[common])]] = _unpack_sorted(shared)
        self.by_rank = np.argsort(self.ident[:n])
        self.rank = np.empty(n, np.int64)
        self.rank[self.by_rank] = np.arange(n)
        self.gram, self.denominator, self.tells = tokens, np.full(n + 1, model.unigrams.denominator), np.ones(n + 1, bool)


class _Grams:
    """The distinct n-grams of an order in a block: for each its context and its lower-order part as places in the order below, and its
    last token. ``gram`` tells the n-gram at a position of ``at``. ``own`` are n-grams of no other block, ``inside`` those whose context is
    one already. The count of an n-gram is ``settled`` if its lower-order part is of no other block or was never trained. ``sent`` are the
    n-grams with a known context that other blocks have too, by bucket, context and last token; asked about are those not settled.
    ``tells`` are those of which, as contexts, this block and no other tells the denominator of the lower-order part."""

    def __init__(self, block: _Block, below: _Tokens | _Grams, first: _Tokens, model: Model):
        self.order, tokens, n = below.order + 1, block.tokens, len(first.count) - 1
        if self.order == 2:
            self.at = np.arange(len(tokens))
            before = np.concatenate([[n], tokens[:-1]])
            before[block.starts] = n
        else:
            self.at = np.flatnonzero(np.arange(len(tokens)) - np.repeat(block.starts, block.lengths) >= self.order - 2)
            before = below.gram[self.at - 1]
        key, place = np.unique(before.astype(np.int64) * (n + 1) + first.rank[tokens[self.at]], return_inverse=True)
        self.gram = np.zeros(len(tokens), np.int32)
        self.gram[self.at] = place
        self.context, self.last = (key // (n + 1)).astype(np.int32), first.by_rank[key % (n + 1)]
        self.short = np.empty(len(key), np.int32)
        self.short[place] = below.gram[self.at]
        self.count, self.alpha, self.raised = np.zeros(len(key), np.int64), np.ones(len(key)), np.zeros(len(key), bool)
        self.ident, self.inside = np.zeros(len(key), np.int64), below.own[self.context]
        self.own, self.tells = self.inside | below.own[self.short], np.zeros(len(key), bool)
        self.settled = below.own[self.short] | (below.count[self.short] == 0)
        trained = np.repeat(block.train, block.lengths)[self.at]
        self.trained = np.bincount(self.gram[self.at[trained]], minlength=len(key))
        known = np.flatnonzero((below.count[self.context] > 0) & ~self.inside)
        v = below.ident[self.context[known]]
        bucket = _mixed(v) % np.uint64(model.buckets) if self.order == 2 else (v >> 32).astype(np.uint64)
        heavy = model.heavy(below.count[self.context[known]])
        bucket[heavy] = _mixed(v[heavy] * 3 + _mixed(first.ident[self.last[known[heavy]]]).view(np.int64)) % np.uint64(model.buckets)
        order = np.lexsort((v, bucket))
        self.sent, self.sent_v = known[order], v[order]
        self.slices = np.searchsorted(bucket[order], np.arange(model.buckets + 1, dtype=np.uint64))

    def slice(self, bucket: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """What goes to a bucket: n-grams, the starts of their contexts, and which n-grams are asked about; which contexts have one that
        is, and which have a settled one that needs the context's weight or denominator (a trained one of at most TOP frees something)."""
        part = slice(self.slices[bucket], self.slices[bucket + 1])
        sent, starts = self.sent[part], _runs(self.sent_v[part])
        asked, trained = ~self.settled[sent], self.trained[sent]
        wants = ~asked & ((trained == 0) | (trained > TOP))
        return sent, starts, asked, np.logical_or.reduceat(asked, starts), np.logical_or.reduceat(wants, starts)

    def take(self, answers: pd.DataFrame, below: _Tokens | _Grams, model: Model) -> None:
        """Counts and back-off weights as the buckets answered, and of own contexts; and what the next order needs of them."""
        self.count[self.sent] = self.trained[self.sent]
        for k, counts, flags, weights, places in zip(*(answers[c] for c in ("bucket", "first", "second", "weight", "third"))):
            sent, starts, asked, has, wants = self.slice(k)
            told = np.ones(np.count_nonzero(has) + np.count_nonzero(wants))
            told[unpack(flags, bool)] = unpack(weights, np.float64)
            weight = np.ones(len(starts))
            weight[wants] = told[np.count_nonzero(has):]
            weight[has] = np.where(wants[has], weight[has], told[:np.count_nonzero(has)])
            own = np.repeat(weight, np.diff(np.append(starts, len(sent))))
            self.alpha[sent], self.raised[sent] = np.abs(own), own < 0
            self.count[sent[asked]] = unpack(counts)
            if places is not None:
                place = _unpack_sorted(places)
                sent = sent[asked]
                self.ident[sent], self.own[sent], self.tells[sent] = (int(k) << 32) + (place >> 2), place & 1, place & 2
        inside = np.flatnonzero(self.inside & (below.count[self.context] > 0))
        context, start = np.unique(self.context[inside], return_inverse=True)
        self.count[inside] = counts = self.trained[inside]
        short = self.short[inside]
        lower = discounted(below.count[short], model.discounts(self.order - 1)) / np.maximum(below.denominator[short], 1)
        alpha, denominator = context_weights(
            below.count[context], np.bincount(start, discounted(counts, model.discounts(self.order)), len(context)),
            np.bincount(start, np.where(counts > 0, lower, 0), len(context)), model.least(self.order))
        self.alpha[inside], self.raised[inside] = alpha[start], (denominator > below.count[context])[start]
        self.denominator = below.count[self.context] + self.raised

    def p(self, lower: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Probability of each n-gram's last word, from those of the order below."""
        return np.where(self.count > 0, discounted(self.count, d) / np.maximum(self.denominator, 1), self.alpha * lower[self.short])


class _Block:
    """A block with its n-grams up to an order; all orders that were answered are filled in."""

    def __init__(self, row, answers: pd.DataFrame, model: Model, order: int):
        self.ids, self.train, self.lengths = list(row["ids"]), unpack(row["train"], bool), unpack(row["lengths"])
        self.tokens = unpack(row["tokens"], np.int32)
        self.starts = np.cumsum(self.lengths) - self.lengths
        first = _Tokens(_unpack_sorted(row["vocab"], np.uint64), self.tokens, unpack(row["counts"]), answers[answers["level"] == 1], model)
        self.levels = [first]
        for k in range(2, order + 1):
            level = _Grams(self, self.levels[-1], first, model)
            if k - 2 < len(model.d):
                level.take(answers[answers["level"] == k], self.levels[-1], model)
            self.levels.append(level)


def _mixed(values: np.ndarray) -> np.ndarray:
    h = values.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _runs(values: np.ndarray) -> np.ndarray:
    """Starts of runs of equal values."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)


# --- buckets ----------------------------------------------------------------------------------------------------------------

def _token_requests(buckets: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                hashes, counts = _unpack_sorted(row["vocab"], np.uint64), unpack(row["counts"])
                ends = _bucket_ends(hashes, buckets)
                for b in np.flatnonzero(np.diff(ends)):
                    part = slice(ends[b], ends[b + 1])
                    yield pa.RecordBatch.from_pylist([{"block": row["block"], "bucket": int(b), "first": _pack_sorted(hashes[part]),
                                                       "second": pack(counts[part])}])
    return run


_ANSWER = "block bigint, bucket bigint, level int, first binary, second binary, weight binary, third binary, stats array<bigint>"


def _merge_tokens(rows: pd.DataFrame) -> pd.DataFrame:
    """Sums over the bucket's tokens, and per block their numbers, doubled (frequent tokens have small ones; 1 means no other block has the
    token), and the counts of numbered ones from the largest number down."""
    rows = rows.sort_values("block")
    parts = [_unpack_sorted(k, np.uint64) for k in rows["first"]]
    keys, place = np.unique(np.concatenate(parts), return_inverse=True)
    counts = np.bincount(place, np.concatenate([unpack(c) for c in rows["second"]]), len(keys)).astype(np.int64)
    stats = [int(counts.sum()), int((counts > 0).sum()), *(int((counts == r).sum()) for r in range(1, TOP + 2))]
    bucket, at, out = int(rows["bucket"].iloc[0]), 0, []
    out.append((-1, bucket, 1, None, None, None, None, stats))
    number = np.empty(len(keys), np.int64)
    number[np.argsort(-counts, kind="stable")] = np.arange(len(keys))
    marked = np.where(np.bincount(place, minlength=len(keys)) == 1, 1, 2 * number)
    for block, part in zip(rows["block"], parts):
        own = place[at:at + len(part)]
        at += len(part)
        common = own[(marked[own] & 1) == 0]
        out.append((block, bucket, 1, pack(marked[own]), _pack_sorted(counts[common[np.argsort(-number[common])]]), None, None, None))
    return pd.DataFrame(out, columns=["block", "bucket", "level", "first", "second", "weight", "third", "stats"])


def _pack_runs(values: np.ndarray, starts: np.ndarray) -> bytes:
    """Values that ascend in runs which begin at ``starts``."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    steps[starts] = values[starts]
    return pack(steps)


def _unpack_runs(data: bytes, runs: np.ndarray) -> np.ndarray:
    steps = unpack(data)
    runs = runs[runs > 0]
    starts, sums = np.cumsum(runs) - runs, np.cumsum(steps)
    return sums - np.repeat(sums[starts] - steps[starts], runs)


_REQUEST = ("block bigint, bucket bigint, v binary, runs binary, total binary, base binary, w binary, lower binary, trained binary, "
            "settled_runs binary, settled_lower binary, settled_trained binary, wants binary, stats array<bigint>")


def _gram_requests(model: Model, order: int):
    columns = [c.split()[0] for c in _REQUEST.split(", ")]

    def run(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in block.to_dict("records"):
            b = _Block(row, answers, model, order)
            below, top = b.levels[-2:]
            inside, none = top.trained[top.inside | top.settled], pack(np.zeros(0, np.int64))
            out.append((row["block"], row["block"] % model.buckets, *[none] * 10, pack(np.zeros(0, bool)),
                        [int((inside == r).sum()) for r in range(1, TOP + 2)]))
            for k in np.flatnonzero(np.diff(top.slices)):
                sent, starts, asked, _, wants = top.slice(k)
                one, extra = sent[starts], ~asked & (top.trained[sent] > 0)
                runs, settled, asked = np.add.reduceat(asked, starts, dtype=np.int64), sent[extra], sent[asked]
                w, lower = b.levels[0].ident[top.last[asked]], below.count[top.short[asked]]
                total, base = below.count[top.context[one]], below.denominator[top.short[one]].astype(np.int64)
                heavy = model.heavy(total)
                lower = lower[top.trained[asked] > 0]
                if order == 2:  # a function of the token, and nearly sorted by its number
                    lower = _zigzag(lower[np.unique(w[top.trained[asked] > 0], return_index=True)[1]])
                out.append((row["block"], int(k), _pack_sorted(below.ident[top.context[one]]), pack(runs), pack(np.where(heavy, total, 0)),
                            pack(np.where(heavy | below.tells[top.context[one]], base, 0)), _pack_runs(w, (np.cumsum(runs) - runs)[runs > 0]),
                            pack(lower), pack(top.trained[asked]), pack(np.add.reduceat(extra, starts, dtype=np.int64)),
                            pack(below.count[top.short[settled]]), pack(top.trained[settled]), pack(wants), None))
        return pd.DataFrame(out, columns=columns)
    return run


def _zigzag(values: np.ndarray) -> np.ndarray:
    """Differences as numbers from 0 on, small if neighbours are alike."""
    steps = np.diff(values, prepend=np.int64(0))
    return (steps << 1) ^ (steps >> 63)


def _unzigzag(steps: np.ndarray) -> np.ndarray:
    return np.cumsum((steps >> 1) ^ -(steps & 1))


def _told(parts, place: np.ndarray, n: int) -> np.ndarray:
    """Values by place, from those that are not 0; such values of one place are equal."""
    values = np.concatenate([unpack(x) for x in parts])
    out, told = np.zeros(n, np.int64), np.flatnonzero(values)
    out[place[told]] = values[told]
    return out


_TABLE = ("bucket bigint, v binary, total binary, lower binary, context binary, counts binary, settled_context binary, settled_counts binary, "
          "stats array<bigint>, blocks array<bigint>, places array<binary>, wanted array<binary>")


def _merge_grams(model: Model, order: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """The bucket's table: contexts with their counts and the lower-order probability of the words seen after them, counts of the n-grams
        sorted by context and last token, and where each block's requests stand."""
        inside = [x for x in rows["stats"] if x is not None]
        rows = rows.sort_values("block")
        runs = [unpack(r) for r in rows["runs"]]
        heads = np.concatenate([_unpack_sorted(v) for v in rows["v"]])
        vs, head = np.unique(heads, return_inverse=True)
        totals, bases = (_told(rows[c], head, len(vs)) for c in ("total", "base"))
        last = [_unpack_runs(w, r) for w, r in zip(rows["w"], runs)]
        trained = [unpack(t) for t in rows["trained"]]
        lower = [unpack(x) for x in rows["lower"]]
        if order == 2:
            lower = [_unzigzag(x)[np.unique(w[t > 0], return_inverse=True)[1]] for x, w, t in zip(lower, last, trained)]
        last, trained = np.concatenate(last), np.concatenate(trained)
        words = int(last.max(initial=0)) + 1
        key, place = np.unique(np.repeat(head, np.concatenate(runs)) * words + last, return_inverse=True)
        context, known = key // words, np.zeros(len(key), np.int64)
        known[place[trained > 0]] = np.concatenate(lower)
        counts = np.bincount(place, trained, len(key)).astype(np.int64)
        settled, settled_lower, settled_counts = (
            np.concatenate([unpack(x) for x in rows[c]]) for c in ("settled_runs", "settled_lower", "settled_trained"))
        settled = np.repeat(head, settled)
        by_context = np.argsort(settled, kind="stable")
        # All that follows a context in training was sent here, unless the context is heavy.
        sums = np.zeros(len(vs)) + np.bincount(context, counts, len(vs)) + np.bincount(settled, settled_counts, len(vs))
        totals = np.where(totals > 0, totals, sums.astype(np.int64))
        d = model.discounts(order - 1)
        lower = (np.bincount(context, np.where(counts > 0, discounted(known, d), 0), len(vs))
                 + np.bincount(settled, discounted(settled_lower, d), len(vs))) / np.maximum(bases, 1)
        places = [_pack_sorted(p.astype(np.int32)) for p in np.split(place, np.cumsum([int(r.sum()) for r in runs])[:-1])]
        wanted = [_pack_sorted(h[unpack(x, bool)]) for h, x in zip(np.split(head, np.cumsum([len(r) for r in runs])[:-1]), rows["wants"])]
        stats = [int((counts == r).sum()) + int(sum(x[r - 1] for x in inside)) for r in range(1, TOP + 2)]
        return pd.DataFrame([{"bucket": int(rows["bucket"].iloc[0]), "v": _pack_sorted(vs), "total": pack(totals), "lower": pack(lower),
                              "context": _pack_sorted(context), "counts": pack(counts), "settled_context": _pack_sorted(settled[by_context]),
                              "settled_counts": pack(settled_counts[by_context]), "stats": stats, "blocks": [int(b) for b in rows["block"]],
                              "places": places, "wanted": wanted}])
    return run


class _Bucket:
    """A bucket's table opened: per context the sums that its back-off weight needs."""

    def __init__(self, row: dict, model: Model, order: int):
        self.v, self.total, self.context = _unpack_sorted(row["v"]), unpack(row["total"]), _unpack_sorted(row["context"])
        self.counts, self.lower = unpack(row["counts"]), unpack(row["lower"], np.float64).copy()
        d = model.discounts(order)
        self.seen = (np.zeros(len(self.v)) + np.bincount(self.context, discounted(self.counts, d), len(self.v))
                     + np.bincount(_unpack_sorted(row["settled_context"]), discounted(unpack(row["settled_counts"]), d), len(self.v)))
        self.heavy = model.heavy(self.total)


def _heavy_sums(model: Model, order: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                b = _Bucket(row, model, order)
                yield pa.RecordBatch.from_arrays([pa.array(x[b.heavy], t) for x, t in (
                    (b.v, pa.int64()), (b.seen, pa.float64()), (b.lower, pa.float64()))], names=["v", "seen", "lower"])
    return run


def _weights(model: Model, order: int, heavy, last: bool):
    """Per block the counts and back-off weights it asked for, of contexts asked about and then of those of settled n-grams: a negative
    weight says that the context's count is raised, and contexts whose words are all seen get 1; only weights other than 1 are told. Unless
    the order is the last, also the places, fourfold, plus one if no other block has the n-gram, plus two in the last block that has it."""
    def run(batches):
        hv, hs, hl = heavy.value
        for batch in batches:
            for row in batch.to_pylist():
                b = _Bucket(row, model, order)
                at = np.searchsorted(hv, b.v[b.heavy])
                b.seen[b.heavy], b.lower[b.heavy] = hs[at], hl[at]
                alpha, denominator = context_weights(b.total, b.seen, b.lower, model.least(order))
                raised = denominator > b.total
                places = [_unpack_sorted(place, np.int32) for place in row["places"]]
                every, at = np.concatenate(places), 0
                marked = 4 * every.astype(np.int64) + (np.bincount(every, minlength=len(b.counts)) == 1)[every]
                latest = np.zeros(len(b.counts), np.int64)
                latest[every] = np.arange(len(every))
                marked[latest] += 2
                for block, place, wanted in zip(row["blocks"], places, row["wanted"]):
                    wanted, mark, at = _unpack_sorted(wanted), marked[at:at + len(place)], at + len(place)
                    if not len(place) and not len(wanted):
                        continue
                    context, counts = b.context[place], b.counts[place]
                    runs = _runs(context)
                    unseen = np.minimum.reduceat(counts, runs) == 0 if len(runs) else np.zeros(0, bool)
                    own = np.concatenate([context[runs], wanted])
                    weight = np.where(np.concatenate([unseen, np.ones(len(wanted), bool)]), alpha[own], 1.0)
                    weight = np.where(raised[own], -weight, weight)
                    yield pa.RecordBatch.from_pylist([{
                        "block": block, "bucket": row["bucket"], "level": order, "first": pack(counts), "second": pack(weight != 1),
                        "weight": pack(weight[weight != 1]), "third": None if last else _pack_sorted(mark)}], schema=_arrow)
    _arrow = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("level", pa.int32()), ("first", pa.binary()), ("second", pa.binary()),
                        ("weight", pa.binary()), ("third", pa.binary()), ("stats", pa.list_(pa.int64()))])
    return run


def _score(model: Model, order: int):
    def run(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out, unigrams = [], model.unigrams
        for row in block.to_dict("records"):
            b = _Block(row, answers, model, order)
            p = unigrams.p(b.levels[0].count)
            by_token = np.log10(p)[b.tokens]
            for level in b.levels[1:]:
                p = level.p(p, model.discounts(level.order))
                by_token[level.at] = np.log10(p)[level.gram[level.at]]
            own = b.levels[0].count[b.tokens]
            base = np.log10((own + 0.5) / (unigrams.total + 0.5 * (unigrams.distinct + 1)))
            out.append(pd.DataFrame({
                "doc_id": pd.Series([None if i is None else i for i in b.ids], dtype=object), "held_out": ~b.train, "n_tokens": b.lengths,
                "n_known": np.add.reduceat((own > 0).astype(np.int64), b.starts), "train_tokens": unigrams.total,
                "base_score": np.add.reduceat(base, b.starts), "score": np.add.reduceat(by_token, b.starts)}))
        return pd.concat(out) if out else pd.DataFrame(columns=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def train_and_score(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", order: int = 2,
                    bucket_tokens: int = BUCKET_TOKENS) -> DataFrame:
    """Learn n-grams up to ``order`` words from the rows where ``train`` holds and score all rows:
    ``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``; scores are sums of log10."""
    spark = docs.sparkSession
    ship_package(spark)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(train, F.lit(True)).alias("train"), F.col(text_col).cast("string").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    name = f"katz_blocks_{uuid.uuid4().hex}"
    _blocks(rows).write.bucketBy(partitions, "block").saveAsTable(name, path=new_folder(spark, "katz-blocks"))
    blocks = spark.table(name)
    texts, words = blocks.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("texts", "words"))).first()
    buckets = max(partitions, -(-words // bucket_tokens))

    store, path = f"katz_answers_{uuid.uuid4().hex}", new_folder(spark, "katz-answers")

    def keep(rows: DataFrame) -> DataFrame:
        """Add answers to those stored, bucketed by block as the blocks are, so that they are moved once."""
        rows.repartition(partitions, "block").write.mode("append").bucketBy(partitions, "block").saveAsTable(store, path=path)
        return spark.table(store)

    requests = blocks.select("block", "vocab", "counts").mapInArrow(
        _token_requests(buckets), "block bigint, bucket bigint, first binary, second binary")
    answers = keep(requests.groupBy("bucket").applyInPandas(_merge_tokens, _ANSWER))
    total, distinct, *of_counts = answers.filter("block = -1").agg(
        *(F.coalesce(F.sum(F.col("stats")[i]), F.lit(0)) for i in range(TOP + 3))).first()
    model = Model(Unigrams(total, distinct, discounts(of_counts), of_counts), texts, buckets, [])
    for n in range(2, order + 1):
        asked = blocks.groupBy("block").cogroup(answers.drop("stats").groupBy("block")).applyInPandas(_gram_requests(model, n), _REQUEST)
        grams = f"katz_grams_{uuid.uuid4().hex}"
        asked.groupBy("bucket").applyInPandas(_merge_grams(model, n), _TABLE).write.saveAsTable(grams)
        table = spark.table(grams)
        of_counts = list(table.agg(*(F.coalesce(F.sum(F.col("stats")[i]), F.lit(0)) for i in range(TOP + 1))).first())
        model = replace(model, d=[*model.d, discounts(of_counts)])
        opened = table.drop("stats")
        sums = opened.drop("blocks", "places", "wanted").mapInArrow(_heavy_sums(model, n), "v bigint, seen double, lower double")
        sums = sums.groupBy("v").agg(F.sum("seen").alias("seen"), F.sum("lower").alias("lower")).toPandas().sort_values("v")
        heavy = spark.sparkContext.broadcast(tuple(sums[c].to_numpy() for c in ("v", "seen", "lower")))
        answers = keep(opened.mapInArrow(_weights(model, n, heavy, n == order), _ANSWER))
        spark.sql(f"DROP TABLE {grams}")  # all that was asked of it is answered

    schema = (f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
    return blocks.groupBy("block").cogroup(answers.drop("stats").groupBy("block")).applyInPandas(_score(model, order), schema)
