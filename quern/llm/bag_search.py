"""Ranked lexical search over classes of documents that look alike to the items asked.

A document matters to the items only by how often it holds their terms, and by its length mark ``m``. Documents are
therefore restricted to the items' vocabulary; those with identical vectors of term counts and identical ``m`` form a
class (grouped by a hash of both, verified by the vectors themselves). A class is scored once, against every item, and is
expanded into its members by ascending id only where it reaches an item's best ``k``. As no more than ``k`` members can
be among them, a class carries its ``k`` smallest ids; members of a hot class are cut to these inside every task before they meet.

Items are answered in blocks of about ``BLOCK_TERMS`` terms (a hash of the item decides): the vocabulary and the term lists of one block are what
the driver and each task hold, and every block reads the documents once. Scores are whole numbers, so their order does not depend on the plan.

Terms are maximal runs of ASCII letters, digits and code points above 127, only A-Z lower-cased. A null or empty text
has no term: such a document is not counted, such an item finds nothing. Rows of documents are documents each, also
repeated ones; a null id comes after all others. Repeated rows of items count once; items of one id with different texts are
ranked each. An empty table of either kind gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.text import map_chunks, text_bytes
from quern.session import ship_package, stage

BLOCK_TERMS = 500_000
CLASSES_AT_ONCE = 4096
ITEMS_AT_ONCE = 1024
CHUNK_BYTES = 8 << 20

# Bytes of UTF-8 outside terms become blanks; continuation and lead bytes are above 127 and stay.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split() if text else []


def item_terms(items: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """``(item_no, item_id, terms, counts)`` of the distinct items, staged so that the numbers stay."""
    kind = dict(items.dtypes)[id_col]

    def work(chunk: pa.Table) -> Iterator[pa.RecordBatch]:
        counted = [Counter(terms_of(t)) for t in chunk.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [chunk.column("item_id").combine_chunks(), pa.array([list(c) for c in counted], pa.list_(pa.binary())),
             pa.array([list(c.values()) for c in counted], pa.list_(pa.int64()))], names=["item_id", "terms", "counts"])
    rows = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).distinct()
    found = map_chunks(rows, ["item_id", "text"], text_bytes("text"), CHUNK_BYTES, work,
                       f"item_id {kind}, terms array<binary>, counts array<bigint>")
    return stage(found.filter(F.size("terms") > 0).select(F.monotonically_increasing_id().alias("item_no"), "*"), "bag-items")


def restricted(docs: DataFrame, vocabulary: list[bytes], text_col: str, id_col: str) -> DataFrame:
    """``(doc_id, n, terms, tfs)`` of each document with a term: ``n`` counts all its terms, ``terms`` are places in
    the sorted ``vocabulary``, ascending."""
    place = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})

    def work(chunk: pa.Table) -> Iterator[pa.RecordBatch]:
        places, kept, sizes, starts, terms, tfs = place.value, [], [], [0], [], []
        for row, text in enumerate(chunk.column("text").to_pylist()):
            found = terms_of(text)
            if not found:
                continue
            pairs = sorted((places[t], n) for t, n in Counter(found).items() if t in places)
            kept.append(row)
            sizes.append(len(found))
            terms += [t for t, _ in pairs]
            tfs += [n for _, n in pairs]
            starts.append(len(terms))
        offsets = pa.array(starts, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [chunk.column("doc_id").combine_chunks().take(pa.array(kept, pa.int64())), pa.array(sizes, pa.int64()),
             pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32()))],
            names=["doc_id", "n", "terms", "tfs"])
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_chunks(rows, ["doc_id", "text"], text_bytes("text"), CHUNK_BYTES, work,
                      f"doc_id {dict(rows.dtypes)['doc_id']}, n bigint, terms array<int>, tfs array<int>")


def classes_of(vectors: DataFrame, mark: Column, k: int) -> DataFrame:
    """``(terms, tfs, m, members)``: one row per class of equal vectors and equal ``m``, with its ``k`` smallest ids."""
    marked = vectors.filter(F.size("terms") > 0).select("doc_id", "terms", "tfs", mark.alias("m"))
    keyed = marked.select(F.xxhash64("terms", "tfs", "m").alias("hash"), "*")
    alike = ["hash", "m", "terms", "tfs"]
    first = keyed.withColumn("place", F.row_number().over(Window.partitionBy(*alike).orderBy(F.col("doc_id").asc_nulls_last())))
    member = F.struct("place", "doc_id")
    return (first.filter(F.col("place") <= k).groupBy(*alike).agg(F.array_sort(F.collect_list(member)).alias("members"))
            .select("terms", "tfs", "m", F.col("members.doc_id").alias("members")))


def _contributions(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def score_classes(classes: DataFrame, asked: list[tuple[int, np.ndarray, np.ndarray]], weights: np.ndarray, k: int) -> DataFrame:
    """``(item_no, score, members)``: each batch's ``k`` best classes for each item ``(number, term places, counts)``."""
    spark = classes.sparkSession
    ship_package(spark)
    kind = dict(classes.dtypes)["members"]
    numbers = np.array([number for number, _, _ in asked], dtype=np.int64)
    entries = [(t, i, int(n) * int(weights[t])) for i, (_, terms, counts) in enumerate(asked) for t, n in zip(terms, counts)]
    entries.sort()
    by_term = np.array(entries, dtype=np.int64).reshape(-1, 3)
    ranges = np.searchsorted(by_term[:, 0], np.arange(len(weights) + 1))
    shared = spark.sparkContext.broadcast((numbers, by_term[:, 1], by_term[:, 2], ranges))

    def best(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        numbers, holders, worth, ranges = shared.value
        lists, m = batch.column("terms"), batch.column("m").to_numpy()
        sizes = np.diff(lists.offsets.to_numpy())
        terms, tfs = lists.flatten().to_numpy(), batch.column("tfs").flatten().to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(batch.num_rows), sizes)
        gain = _contributions(tfs, m[owner])
        order = np.argsort(terms, kind="stable")
        held, bounds = np.unique(terms[order], return_index=True)
        pieces = np.split(order, bounds[1:])
        members = batch.column("members")
        smallest = pc.list_element(members, 0)
        rank = np.empty(batch.num_rows, dtype=np.int64)
        rank[pc.sort_indices(smallest, null_placement="at_end").to_numpy()] = np.arange(batch.num_rows)
        for start in range(0, len(numbers), ITEMS_AT_ONCE):
            stop = min(start + ITEMS_AT_ONCE, len(numbers))
            scores = np.zeros((stop - start, batch.num_rows), dtype=np.int64)
            for term, piece in zip(held, pieces):
                lo, hi = ranges[term] + np.searchsorted(holders[ranges[term]:ranges[term + 1]], [start, stop])
                if lo < hi:
                    scores[np.ix_(holders[lo:hi] - start, owner[piece])] += worth[lo:hi, None] * gain[piece]
            item, chosen = [], []
            for row in range(stop - start):
                positive = np.flatnonzero(scores[row])
                if len(positive) > k:
                    least = np.partition(scores[row][positive], len(positive) - k)[len(positive) - k]
                    positive = positive[scores[row][positive] >= least]
                found = positive[np.lexsort((rank[positive], -scores[row][positive]))][:k]
                item.append(np.full(len(found), row))
                chosen.append(found)
            item, chosen = np.concatenate(item), np.concatenate(chosen)
            yield pa.RecordBatch.from_arrays([pa.array(numbers[start + item]), pa.array(scores[item, chosen]), members.take(pa.array(chosen))],
                                             names=["item_no", "score", "members"])

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, CLASSES_AT_ONCE):
                part = pa.Table.from_batches([batch.slice(start, CLASSES_AT_ONCE)]).combine_chunks().to_batches()
                for piece in part:
                    yield from best(piece)
    return classes.mapInArrow(run, f"item_no bigint, score bigint, members {kind}")


def _search_block(block: DataFrame, docs: DataFrame, k: int, text_col: str, id_col: str) -> DataFrame:
    """``(item_no, rank, doc_id, score)`` of one block of items."""
    rows = block.select("item_no", "terms", "counts").toArrow().to_pydict()
    vocabulary = sorted({t for terms in rows["terms"] for t in terms})
    place = {t: i for i, t in enumerate(vocabulary)}
    asked = [(number, np.array([place[t] for t in terms]), np.array(counts))
             for number, terms, counts in zip(rows["item_no"], rows["terms"], rows["counts"])]
    vectors = stage(restricted(docs, vocabulary, text_col, id_col), "bag-vectors")
    totals = vectors.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(1)).alias("length")).first()
    counted = vectors.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
    df = np.zeros(len(vocabulary), dtype=np.int64)
    df[counted.column("term").to_numpy()] = counted.column("count").to_numpy()
    weights = np.array([math.floor(1000 * math.log((2 * totals["docs"] + 2) / (2 * int(x) + 1))) for x in df], dtype=np.int64)
    mark = F.lit(75) + F.expr(f"(25 * n * {totals['docs']}L) div {totals['length']}L")
    scored = score_classes(classes_of(vectors, mark, k), asked, weights, k)
    hits = scored.select("item_no", "score", F.explode("members").alias("doc_id"))
    best = Window.partitionBy("item_no").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("item_no", "rank", "doc_id", "score")


def search(items: DataFrame, docs: DataFrame, k: int = 20, item_text: str = "text", item_id: str = "item_id", text_col: str = "text",
           id_col: str = "doc_id", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents of each item, equal scores by ascending id."""
    asked = item_terms(items, item_text, item_id)
    total = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("n")).first()["n"]
    blocks = math.ceil(total / block_terms)
    parts = [asked.filter(F.pmod(F.xxhash64("item_no"), F.lit(blocks)) == b) for b in range(blocks)]
    found = [_search_block(part, docs, k, text_col, id_col) for part in parts if not part.isEmpty()]
    kind = dict(docs.dtypes)[id_col]
    hits = reduce(DataFrame.union, found) if found else docs.sparkSession.createDataFrame(
        [], f"item_no bigint, rank int, doc_id {kind}, score bigint")
    return hits.join(asked.select("item_no", "item_id"), "item_no").select("item_id", "rank", "doc_id", "score")
