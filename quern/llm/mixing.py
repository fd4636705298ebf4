"""Mixing sources to target weights by Sainte-Laguë apportionment.

The mix has as many words as the input. Every source has a weight; its target is its share of
the total by weight, but at most ``max_repeat`` times its own size, the excess going to the
others by weight. The mix is dealt in blocks of ``block_words`` words:

1. Blocks go to the sources by highest quotient ``target / (2 k + 1)``.
2. A source's blocks go to its shards the same way, by shard size. A source of ``n`` blocks
   has about ``sqrt(n) / 8`` shards, so the shards of a source and the blocks of a shard both
   grow with the root of the source: a source holding a third of all rows is spread over many tasks.
3. In a shard the documents, in seeded order, form a stream of words. A quota first takes whole passes of
   the stream, then blocks of it in seeded order (the last one cut to fit).

One row per *source* passes through one task (targets and quotients need all of them); everything
about documents stays spread. Reruns agree: all order comes from seeded hashes of the id, then size.

Null text has no words. A null source is a source, sorted last. Documents without words take
nothing. Repeated rows are separate documents. Null ids are allowed (they hash alike and are
ordered by size). An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.text import word_count
from quern.session import ship_package, stage

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
BLOCK_WORDS = 16
SEED = 17


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)`` rows; weights repeat over the sorted sources.

    With sources sorted by ``cap / weight``, capping the first ``k`` leaves the others at
    ``(total - caps) / weights left`` per unit of weight. That level rises while a cap still binds and falls
    afterwards, so its maximum is the one at which no source is above its cap.
    """
    everything = Window.partitionBy()
    ranked = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn(
        "nth", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("nth") % len(weights) + 1).cast("int"))
    caps = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_repeat)
    rising = everything.orderBy(F.col("cap") / F.col("weight"), "nth")
    before = F.coalesce(F.sum("cap").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing))
    level = caps.withColumn("level", (F.sum("source_size").over(everything) - before) / rest)
    level = level.withColumn("level", F.max("level").over(everything))
    return level.select("source", "source_size",
                        F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")).alias("target"))


def apportion(weights: np.ndarray, seats: int) -> np.ndarray:
    """Sainte-Laguë: ``seats`` dealt one by one to the highest ``weight / (2 k + 1)``, ties to the first.

    Rounding ``weight * seats / total`` is what the method gives for some number of seats near
    ``seats``; the few that differ are then given or taken by quotient.
    """
    weights = np.asarray(weights, dtype=float)
    total = weights.sum()
    if total <= 0 or seats <= 0:
        return np.zeros(len(weights), dtype=np.int64)
    won = np.floor(weights * (seats / total) + 0.5).astype(np.int64)
    missing = seats - int(won.sum())
    if missing > 0:
        heap = [(-w / (2 * k + 1), i) for i, (w, k) in enumerate(zip(weights, won)) if w > 0]
        heapq.heapify(heap)
        for _ in range(missing):
            i = heap[0][1]
            won[i] += 1
            heapq.heapreplace(heap, (-weights[i] / (2 * won[i] + 1), i))
    elif missing < 0:
        heap = [(w / (2 * k - 1), -i) for i, (w, k) in enumerate(zip(weights, won)) if k > 0]
        heapq.heapify(heap)
        for _ in range(-missing):
            i = -heap[0][1]
            won[i] -= 1
            if won[i]:
                heapq.heapreplace(heap, (weights[i] / (2 * won[i] - 1), -i))
            else:
                heapq.heappop(heap)
    return won


def take_blocks(sizes: np.ndarray, quota: int, block: int, repeat: int, seed: int) -> np.ndarray:
    """Words taken of each document when a stream of ``sizes`` words gives ``quota`` blocks."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    if not total:
        return np.zeros(len(sizes), dtype=np.int64)
    passes, rest = divmod(min(quota * block, repeat * total), total)
    count = -(-total // block)
    lengths = np.full(count, block, dtype=np.int64)
    lengths[-1] = total - block * (count - 1)
    order = np.random.default_rng(seed).permutation(count)
    reached = np.cumsum(lengths[order])
    used = np.zeros(count, dtype=np.int64)
    used[order] = np.clip(rest - (reached - lengths[order]), 0, lengths[order])
    before = np.concatenate([[0], np.cumsum(used)])

    def taken_until(word: np.ndarray) -> np.ndarray:
        at = np.minimum(word // block, count - 1)
        return before[at] + np.minimum(word - at * block, used[at])
    return sizes * passes + taken_until(ends) - taken_until(ends - sizes)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT, block_words: int = BLOCK_WORDS,
        seed: int = SEED) -> DataFrame:
    """One row ``(doc_id, source, size, source_size, target, taken)`` per input row."""
    spark = docs.sparkSession
    ship_package(spark)
    sized = stage(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                              word_count(F.col(text_col)).alias("size"), F.xxhash64(F.lit(seed), F.col(id_col)).alias("draw")),
                  "mix-sizes")

    def deal_sources(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("source", na_position="last", kind="stable").reset_index(drop=True)
        seats = int(round(rows["source_size"].sum() / block_words))
        rows["blocks"] = apportion(rows["target"].to_numpy(), seats)
        return rows[["source", "source_size", "target", "blocks"]]
    by_source = stage(targets(sized, weights, max_repeat).withColumn("every", F.lit(0)).groupBy("every").applyInPandas(
        deal_sources, "source string, source_size bigint, target double, blocks bigint"), "mix-sources")
    own = by_source.withColumn("shards", F.greatest(F.lit(1), F.floor(F.sqrt(F.col("source_size") / block_words) / 8)).cast("bigint"))

    dealt = sized.alias("d").join(own.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")), "left").select(
        "d.*", "source_size", "target", "blocks", F.pmod("draw", F.col("shards")).alias("shard"))
    filled = dealt.filter("size > 0")
    shards = filled.groupBy("source", "shard").agg(F.sum("size").alias("shard_size"), F.first("blocks").alias("blocks"))

    def deal_shards(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("shard").reset_index(drop=True)
        rows["quota"] = apportion(rows["shard_size"].to_numpy(), int(rows["blocks"].iloc[0]))
        return rows[["source", "shard", "quota"]]
    quotas = stage(shards.groupBy("source").applyInPandas(deal_shards, "source string, shard bigint, quota bigint"), "mix-quotas")

    def select_blocks(key, rows: pd.DataFrame, quota: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["draw", "doc_id", "size"], kind="stable").reset_index(drop=True)
        if len(rows):
            draw = zlib.crc32(f"{seed}/{key[0]}/{key[1]}".encode())
            rows["taken"] = take_blocks(rows["size"].to_numpy(), int(quota["quota"].iloc[0]), block_words, max_repeat, draw)
        return rows[list(out)] if len(rows) else pd.DataFrame({c: [] for c in out})
    kinds = dict(sized.dtypes)
    out = {"doc_id": kinds["doc_id"], "source": "string", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"}
    schema = ", ".join(f"{c} {t}" for c, t in out.items())
    chosen = filled.groupBy("source", "shard").cogroup(quotas.groupBy("source", "shard")).applyInPandas(select_blocks, schema)
    empty = dealt.filter("size = 0").select("doc_id", "source", "size", "source_size", "target", F.lit(0).cast("bigint").alias("taken"))
    return chosen.unionByName(empty)
