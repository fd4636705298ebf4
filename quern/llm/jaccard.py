"""Near-duplicate components by a token-group matrix over word shingles.

Texts with equal shingle sets form a *class* and only classes are compared. Classes that share two
min-hashes form a *group* of probably similar documents. The matrix holds, per shingle, the groups in whose
token union it stands. A document bounds its overlap with a group by the matrix rows of its own
shingles and only groups that reach the bound are opened, i.e. compared set by set.

What makes this exact and small: let sets be ordered rarest shingle first (frequent ones, known from a count
over all documents, last; else by hash). Two sets with an overlap of at least ``o`` share at least
``min(K, o)`` of their first ``size - o + K`` shingles. So the matrix needs these prefixes only (a tenth of a set
at 90 %), and a group with fewer than ``min(K, o)`` common prefix shingles cannot qualify. For a group of one document the sizes
of both sets are known, hence ``o``: both prefixes shrink (to a twentieth at equal sizes), and what either set holds
up to the last common shingle without the other is a part of their difference, which must not be too large.

Groups are opened in three rounds, each in chunks of at most about ``CHUNK`` documents. First every group for itself, with a
union-find that stops when all are connected; leaders of a group's chunks are compared with each other. Then every document asks
one chunk of its *hub*, the largest group among those with which it shares enough shingles. So a family of near copies, however large,
becomes one component with about as many comparisons as it has documents. Only then the matrix is read again with
these components as groups, and a document is sent to all chunks of every other component that qualifies, at first as a sketch, whose distance bounds that of
the sets from below, and as a whole set where that leaves a link possible. No partner or
candidate is ever cut off. Links become components by large-star / small-star steps on tables; nothing about
documents reaches the driver but the frequent shingles (in at least 1/8000 of all documents, so at most 8000 mean set sizes).

Shingles are 64-bit hashes; so are the digests of sets. Equal hashes count as equal.
Null, empty and blank texts have an empty set and are linked with nothing. A text of fewer than ``width`` words has one
shingle. Repeated rows are copies. A null id is no component's smallest id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.text import folded_words, map_chunks, text_bytes
from quern.session import ship_package, stage

K = 5
CHUNK = 512
CHUNK_BYTES = 8 << 20
FREQUENT = 8000
PAIRS_AT_ONCE = 2_000_000

_U = np.uint64
# Odd multipliers for mixing hashes.
_MIX = [_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9), _U(0xD6E8FEB86659FD93), _U(0xFF51AFD7ED558CCD)]


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def _mixed(h: np.ndarray, seed: int = 0) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _MIX[seed % 5]
    return (h ^ (h >> _U(29))) * _MIX[(seed + 1) % 5]


def shingles(text: str | None, width: int, hashes: dict) -> np.ndarray:
    """The sorted distinct 64-bit shingles of a text."""
    words = folded_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        total = _mixed(total + h[i:len(h) - width + 1 + i], i)
    return np.unique(total)


def overlap_needed(n, percent: int):
    """The least overlap with any set that a set of ``n`` needs."""
    return -(-percent * n // 100)


def _by_group(df: DataFrame, keys: list[str], order: list[str], work: Callable[[list[dict]], Iterator[tuple]], names: list[str],
              schema: str) -> DataFrame:
    """Run ``work`` on the rows of each key, one key after the other within a task."""
    kinds = None

    def run(batches):
        group, held, out = None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                key = tuple(row[k] for k in keys)
                if key != group and held:
                    out.extend(work(held))
                    held = []
                    if len(out) >= 10_000:
                        yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema=kinds)
                        out = []
                group = key
                if not held or held[-1]["cls"] != row["cls"]:
                    held.append(row)
        if held:
            out.extend(work(held))
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema=kinds)
    kinds = pa.schema([(n, pa.int64()) for n in names])
    ship_package(df.sparkSession)
    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


class _Opened:
    """Sets of one chunk, indexed by shingle."""

    def __init__(self, rows: list[dict]):
        self.sets = [np.frombuffer(r["tokens"], np.uint64) for r in rows]
        self.sizes = np.array([len(s) for s in self.sets])
        tokens = np.concatenate(self.sets)
        order = np.argsort(tokens, kind="stable")
        self.tokens = tokens[order]
        self.owner = np.repeat(np.arange(len(rows)), self.sizes)[order]

    def linked(self, tokens: np.ndarray, percent: int) -> np.ndarray:
        """Members whose set is similar enough to ``tokens``."""
        low, high = np.searchsorted(self.tokens, tokens, "left"), np.searchsorted(self.tokens, tokens, "right")
        count = high - low
        at = np.arange(int(count.sum())) + np.repeat(low - (np.cumsum(count) - count), count)
        common = np.bincount(self.owner[at], minlength=len(self.sizes))
        return np.flatnonzero(100 * common >= percent * (self.sizes + len(tokens) - common))


def _root(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def _connect(rows: list[dict], percent: int) -> list[int]:
    """For each row the number of the first row of its component."""
    parent, left = list(range(len(rows))), len(rows) - 1
    opened = _Opened(rows)
    for i in range(len(rows)):
        if not left:
            break
        for j in opened.linked(opened.sets[i], percent):
            a, b = _root(parent, i), _root(parent, int(j))
            if a != b:
                parent[max(a, b)] = min(a, b)
                left -= 1
    return [_root(parent, i) for i in range(len(rows))]


def _frequent(docs: DataFrame, width: int) -> np.ndarray:
    """Shingles in at least one of ``FREQUENT`` documents, as far as chunks show them (a shingle counts in a chunk of texts
    from two different sets on); this only orders sets."""
    def work(chunk: pa.Table) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        sets = {s.tobytes(): s for s in (shingles(t, width, hashes) for t in chunk.column("text").to_pylist())}
        tokens, counts = np.unique(np.concatenate(list(sets.values())), return_counts=True)
        often = counts >= 2
        yield pa.RecordBatch.from_arrays([pa.array(tokens[often].view(np.int64)), pa.array(counts[often])], names=["token", "docs"])
    found = map_chunks(docs, ["text"], text_bytes("text"), CHUNK_BYTES, work, "token bigint, docs bigint")
    least = max(16, docs.count() // FREQUENT)
    rows = found.groupBy("token").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= least).select("token").toPandas()
    return np.sort(rows["token"].to_numpy(dtype=np.int64).view(np.uint64))


def _profiles(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Per document: set size, digest of the set, group key, prefix (given for one of equal sets in a chunk of texts)."""
    frequent = docs.sparkSession.sparkContext.broadcast(_frequent(docs, width))
    kind = dict(docs.dtypes)["doc_id"]

    def work(chunk: pa.Table) -> Iterator[pa.RecordBatch]:
        hashes, hot, given = _WordHashes(), frequent.value, {}
        sizes, digests, groups, prefixes = [], [], [], []
        for text in chunk.column("text").to_pylist():
            s = shingles(text, width, hashes)
            n = len(s)
            sizes.append(n)
            if not n:
                digests.append(0)
                groups.append(0)
                prefixes.append(b"")
                continue
            digests.append(_signed(xxhash.xxh64_intdigest(s.tobytes())))
            if digests[-1] in given:
                groups.append(given[digests[-1]])
                prefixes.append(b"")
                continue
            groups.append(_signed(xxhash.xxh64_intdigest(_mixed(s, 1).min().tobytes() + _mixed(s, 3).min().tobytes())))
            given[digests[-1]] = groups[-1]
            at = np.minimum(np.searchsorted(hot, s), max(0, len(hot) - 1))
            often = hot[at] == s if len(hot) else np.zeros(n, bool)
            prefixes.append(np.concatenate([s[~often], s[often]])[:n - overlap_needed(n, percent) + K].tobytes())
        yield pa.RecordBatch.from_arrays(
            [chunk.column("doc_id").combine_chunks(), chunk.column("row_key").combine_chunks(), pa.array(sizes, pa.int64()),
             pa.array(digests, pa.int64()), pa.array(groups, pa.int64()), pa.array(prefixes, pa.binary())],
            names=["doc_id", "row_key", "n", "cls", "grp", "prefix"])
    return map_chunks(docs, ["doc_id", "row_key", "text"], text_bytes("text"), CHUNK_BYTES, work,
                      f"doc_id {kind}, row_key bigint, n bigint, cls bigint, grp bigint, prefix binary")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _least(n: Column, percent: int) -> Column:
    """How many prefix shingles a set of ``n`` must share with a group that it may have a link into."""
    return F.least(F.lit(K), F.ceil(n * percent / 100))


def _matrix(profiles: DataFrame) -> DataFrame:
    """``(token, cls, grp, n, pos)`` for the prefix shingles of all classes; a class may come from several chunks of texts."""
    def explode(batches):
        for batch in batches:
            prefixes = [np.frombuffer(p, np.int64) for p in batch.column("prefix").to_pylist()]
            lengths = np.array([len(p) for p in prefixes], dtype=np.int64)
            columns = [np.repeat(batch.column(c).to_numpy(), lengths) for c in ("cls", "grp", "n")]
            tokens = np.concatenate(prefixes) if len(prefixes) else np.zeros(0, np.int64)
            places = (np.arange(len(tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
            for start in range(0, len(tokens), 100_000):
                part = slice(start, start + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(c[part]) for c in (tokens, *columns, places)], names=["token", "cls", "grp", "n", "pos"])
    return profiles.select("cls", "grp", "n", "prefix").mapInArrow(explode, "token bigint, cls bigint, grp bigint, n bigint, pos int")


def _by_token(matrix: DataFrame, work: Callable[[list[np.ndarray]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Run ``work`` on whole matrix rows: columns token, cls, grp and the others, sorted by shingle, group and class, each row once."""
    def run(batches):
        held = None
        for batch in batches:
            part = [column.to_numpy(zero_copy_only=False) for column in batch.columns]
            if held is not None:
                part = [np.concatenate(x) for x in zip(held, part)]
            last = int(np.searchsorted(part[0], part[0][-1], "left")) if len(part[0]) else 0
            held = [x[last:] for x in part]
            yield from work(once([x[:last] for x in part]))
        if held is not None:
            yield from work(once(held))

    def once(rows: list[np.ndarray]) -> list[np.ndarray]:
        keep = np.ones(len(rows[0]), dtype=bool)
        keep[1:] = (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])
        return [x[keep] for x in rows]
    others = [c for c in matrix.columns if c not in ("token", "cls", "grp")]
    return matrix.select("token", "cls", "grp", *others).repartition("token").sortWithinPartitions("token", "grp", "cls").mapInArrow(run, schema)


def _shared(percent: int) -> Callable[[list[np.ndarray]], Iterator[pa.RecordBatch]]:
    """Rows of shingles that several groups have, with the largest of these groups as ``hub`` (the own group if sizes cannot match)."""
    def work(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        token, cls, grp, n, pos = rows
        if len(token) < 2:
            return
        new_token = np.concatenate([[True], token[1:] != token[:-1]])
        new_group = new_token | np.concatenate([[True], grp[1:] != grp[:-1]])
        starts, run = np.flatnonzero(new_group), np.cumsum(new_token) - 1
        run_of = run[starts]
        size = np.diff(np.append(starts, len(token)))
        order = np.lexsort((np.arange(len(starts)), -size, run_of))
        hub = order[np.searchsorted(run_of, np.arange(run[-1] + 1))]
        at = np.flatnonzero(np.bincount(run_of)[run] > 1)
        least, most = np.minimum.reduceat(n, starts), np.maximum.reduceat(n, starts)
        to = hub[run[at]]
        fits = (100 * most[to] >= percent * n[at]) & (percent * least[to] <= 100 * n[at])
        target = np.where(fits, grp[starts[to]], grp[at])
        for i in range(0, len(at), 100_000):
            part = at[i:i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (token[part], cls[part], grp[part], n[part], pos[part], target[i:i + 100_000])],
                                             names=["token", "cls", "grp", "n", "pos", "hub"])
    return work


def _qualifying(matrix: DataFrame, percent: int) -> DataFrame:
    """``(cls, grp)``: documents and the groups they must open. A pair of groups is met once.

    ``matrix`` has the columns ``token, cls, grp, n, pos, alone``; the last says that a group has one document only.
    """
    hits = _by_token(matrix, lambda rows: _meetings(rows, percent), "cls bigint, grp bigint, n bigint, pos int, other_n bigint, other_pos int")
    met = hits.groupBy("cls", "grp", "n").agg(F.count(F.lit(1)).alias("common"), F.max("pos").alias("pos"), F.max("other_n").alias("other_n"),
                                              F.max("other_pos").alias("other_pos"))
    # What the two sets do not share up to their last common shingle; groups of several have no position (-1).
    apart = F.col("pos") + F.col("other_pos") + 2 - 2 * F.col("common")
    close = (F.col("other_pos") < 0) | (apart * (100 + percent) <= (F.col("n") + F.col("other_n")) * (100 - percent))
    return met.filter((F.col("common") >= _least(F.col("n"), percent)) & close).select("cls", "grp")


def _meetings(rows: list[np.ndarray], percent: int) -> Iterator[pa.RecordBatch]:
    token, cls, grp, n, pos, alone = rows
    if len(token) < 2:
        return
    new_token = np.concatenate([[True], token[1:] != token[:-1]])
    new_group = new_token | np.concatenate([[True], grp[1:] != grp[:-1]])
    starts = np.flatnonzero(new_group)
    group = np.cumsum(new_group) - 1
    least, most = np.minimum.reduceat(n, starts), np.maximum.reduceat(n, starts)
    first = group[np.flatnonzero(new_token)][np.cumsum(new_token) - 1]
    place, single = pos[starts].astype(np.int64), alone[starts].astype(bool)
    earlier = group - first
    cuts = np.concatenate([[0], np.cumsum(earlier)])
    at = 0
    while at < len(token):
        stop = max(at + 1, int(np.searchsorted(cuts, cuts[at] + PAIRS_AT_ONCE, "right")) - 1)
        count = earlier[at:stop]
        if count.sum():
            row = np.repeat(np.arange(at, stop), count)
            other = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]
            fits = (100 * most[other] >= percent * n[row]) & (percent * least[other] <= 100 * n[row])
            row, other = row[fits], other[fits]
            # Both shingles must stand in the prefixes that the two sizes leave; of a group of several only the least size is known.
            size = np.maximum(least[other], overlap_needed(n[row], percent))
            needed = -(-percent * (n[row] + size) // (100 + percent))
            near = (pos[row] < n[row] - needed + K) & (~single[other] | (place[other] < size - needed + K))
            row, other, size = row[near], other[near], size[near]
            for i in range(0, len(row), 100_000):
                r, o = row[i:i + 100_000], other[i:i + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cls[r]), pa.array(grp[starts[o]]), pa.array(n[r]), pa.array(pos[r].astype(np.int32)), pa.array(size[i:i + 100_000]),
                     pa.array(np.where(single[o], place[o], -1).astype(np.int32))], names=["cls", "grp", "n", "pos", "other_n", "other_pos"])
        at = stop


def components(links: DataFrame) -> DataFrame:
    """``(node, comp)`` for all nodes of ``links(a, b)``: the smallest node reachable."""
    edges = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links")
    before = None
    while True:
        # Large star: all greater neighbours of a node go to its least neighbour (or itself).
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: a node and its lesser neighbours go to the least of them.
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = stage(large.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", "m"))
                      .filter("u <> v").distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(edges.select("v", "v").distinct())


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` per row: component is the smallest id reachable by links."""
    return _located(docs, width, percent, id_col, text_col).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows and columns of ``docs`` without near duplicates: of each component the row of smallest
    id stays (of several such rows one); rows with an empty set all stay."""
    found = _located(docs, width, percent, id_col, text_col)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key")).alias("first")
    kept = found.filter("n_shingles > 0").groupBy("comp").agg(first).select("first.row_key", F.lit(False).alias("blank"))
    kept = kept.unionByName(found.filter("n_shingles = 0").select("row_key", F.lit(True).alias("blank")).distinct())
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("row_key")).join(kept, "row_key")
    once = rows.withColumn("copy", F.when(F.col("blank"), F.monotonically_increasing_id()).otherwise(F.lit(-1)))
    return once.dropDuplicates(["row_key", "copy"]).select("row.*")


def _located(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Per row ``doc_id, row_key, n_shingles, component_id`` and ``comp``, the component's inner number."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.xxhash64(F.col(id_col), F.col(text_col)).alias("row_key"))
    profiles = stage(_profiles(docs, width, percent), "profiles")
    classes = profiles.filter("n > 0").groupBy("cls").agg(
        F.min("doc_id").alias("doc_id"), F.min("row_key").alias("row_key"), F.first("n").alias("n"), F.first("grp").alias("grp"))
    classes = stage(classes, "classes")

    shared = stage(_by_token(_matrix(profiles), _shared(percent), "token bigint, cls bigint, grp bigint, n bigint, pos int, hub bigint"), "shared")
    sizes = classes.groupBy("grp").agg(F.count(F.lit(1)).alias("members"))
    hubs = shared.filter("hub <> grp").groupBy("cls", "n", "hub").count().filter(F.col("count") >= _least(F.col("n"), percent))
    hubs = stage(hubs.groupBy("cls").agg(F.max_by("hub", F.struct("count", "hub")).alias("grp")).join(
        sizes.select("grp", F.ceil(F.col("members") / CHUNK).alias("chunks")), "grp"), "hubs")
    opened = sizes.filter("members > 1").select("grp").union(hubs.select("grp")).distinct()
    needed = classes.select("cls", "grp").join(opened, "grp", "left_semi").select("cls").union(hubs.select("cls")).distinct()
    placed = classes.select("cls", "grp", "row_key").join(needed, "cls", "left_semi").join(sizes, "grp").select(
        "cls", "grp", "row_key", F.ceil(F.col("members") / CHUNK).alias("chunks"), F.pmod("cls", F.ceil(F.col("members") / CHUNK)).alias("chunk"))
    sets = stage(_sets(docs, placed, width), "sets")

    # Round 1: every group for itself, then the leaders of its chunks.
    outcome = (["cls", "root", "size"], "cls bigint, root bigint, size bigint")
    first = stage(_by_group(sets, ["grp", "chunk"], ["cls"], _first_round(percent), *outcome), "first-round")
    leaders = first.groupBy("root").agg(F.first("size").alias("size")).join(sets.filter("chunks > 1").withColumnRenamed("cls", "root"), "root")
    leaders = leaders.groupBy("grp", "chunk").agg(F.max_by(F.struct(F.col("root").alias("cls"), "n", "tokens"), F.struct("size", "root")).alias("s"))
    between = _by_group(leaders.select("grp", "s.*"), ["grp"], ["cls"], _first_round(percent), *outcome)

    # Round 2: every document asks one chunk of its hub.
    asked = _ask(sets, hubs.select("cls", "grp", F.pmod("cls", "chunks").alias("chunk")), ["grp", "chunk"], percent)
    early = first.select(F.col("cls").alias("a"), F.col("root").alias("b")).union(between.select("cls", "root")).union(asked)
    joined = stage(components(early), "early")

    # Round 3: the matrix again, with the components so far as groups, and their members in chunks.
    known = classes.select("cls", "n").join(joined, F.col("cls") == F.col("node"), "left").select("cls", "n", F.coalesce("comp", "cls").alias("grp"))
    counted = known.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks"), (F.count(F.lit(1)) == 1).alias("alone"))
    known = stage(known.join(counted, "grp"), "known")
    rows = shared.select("token", "cls", "n", "pos").join(known.select("cls", "grp", "alone"), "cls")
    hits = _qualifying(rows, percent)
    home = known.select("cls", "grp", F.pmod("cls", "chunks").alias("chunk"))
    spans = known.groupBy("grp", F.pmod("cls", "chunks").alias("chunk")).agg(F.min("n").alias("least"), F.max("n").alias("most"))
    across = hits.join(known.select("cls", "n"), "cls").join(spans, "grp")
    # A group of several chunks whose leaders did not connect all: those outside its largest component ask the group's other chunks.
    origin = sets.filter("chunks > 1").select("cls", F.col("grp").alias("origin")).distinct().join(known.select("cls", "grp", "n"), "cls")
    main = origin.groupBy("origin", "grp").count().groupBy("origin").agg(F.max_by("grp", F.struct("count", "grp")).alias("main"))
    rest = origin.select("origin", F.col("grp").alias("other")).distinct()
    within = origin.join(main, "origin").filter("grp <> main").select("cls", "n", "origin", F.col("grp").alias("own")).join(rest, "origin").filter(
        "own <> other").join(spans, F.col("other") == F.col("grp"))
    columns = ["cls", "grp", "chunk", "n", "least", "most"]
    ask = across.select(columns).unionByName(within.select(columns)).filter(
        f"100 * most >= {percent} * n AND {percent} * least <= 100 * n").select("cls", "grp", "chunk").distinct()
    ask = stage(ask, "late-asked")
    # Sets of documents that come up only now.
    more = home.join(ask.select("grp", "chunk").distinct(), ["grp", "chunk"], "left_semi").select("cls").union(ask.select("cls")).distinct()
    more = more.join(sets.select("cls"), "cls", "left_anti").join(classes.select("cls", "grp", "row_key"), "cls")
    extra = _sets(docs, more.select("cls", "grp", "row_key", F.lit(1).cast("bigint").alias("chunks"), F.lit(0).cast("bigint").alias("chunk")), width)
    every = sets.select("cls", "tokens").unionByName(stage(extra, "late-sets").select("cls", "tokens"))
    every = every.join(home, "cls")
    late = _ask(every, _sifted(every, ask, ["grp", "chunk"], percent), ["grp", "chunk"], percent)
    links = joined.select(F.col("node").alias("a"), F.col("comp").alias("b")).union(late)
    comps = components(links)
    named = classes.select("cls", "doc_id").join(comps, F.col("cls") == F.col("node"), "left").select(
        "cls", "doc_id", F.coalesce("comp", "cls").alias("comp"))
    least = named.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    by_class = stage(named.join(least, "comp").select("cls", "component_id", "comp"), "components")
    columns = ["doc_id", "row_key", F.col("n").alias("n_shingles")]
    full = profiles.filter("n > 0").join(by_class, "cls").select(*columns, "component_id", "comp")
    return full.unionByName(profiles.filter("n = 0").select(*columns, F.col("doc_id").alias("component_id"), F.lit(None).cast("bigint").alias("comp")))


def sketch(tokens: np.ndarray) -> np.ndarray:
    """Shingles counted (up to 3) in as many ranges of hashes as there are shingles, a power of two."""
    bits = max(4, (len(tokens) - 1).bit_length())
    return np.minimum(np.bincount((tokens >> _U(64 - bits)).astype(np.int64), minlength=1 << bits), 3).astype(np.int8)


def folded(counts: np.ndarray, ranges: int) -> np.ndarray:
    """Sketches over fewer ranges."""
    while counts.shape[-1] > ranges:
        counts = np.minimum(counts[..., 0::2] + counts[..., 1::2], 3)
    return counts


class _Sketches:
    """Sketches of the members of a chunk, by their number of ranges."""

    def __init__(self, rows: list[dict]):
        self.parts = {}
        for row in rows:
            self.parts.setdefault(len(row["sketch"]), []).append(row)
        self.parts = {ranges: (np.array([r["n"] for r in part]), np.stack([np.frombuffer(r["sketch"], np.int8) for r in part]))
                      for ranges, part in self.parts.items()}

    def may_link(self, n: int, own: np.ndarray, percent: int) -> bool:
        """Whether some member is no further from ``own`` than linked sets can be: sketches differ by no more than sets do."""
        for ranges, (sizes, members) in self.parts.items():
            both = min(ranges, len(own))
            apart = np.abs(folded(members, both) - folded(own, both)).sum(1, dtype=np.int64)
            if (apart * (100 + percent) <= (sizes + n) * (100 - percent)).any():
                return True
        return False


def _sifted(sets: DataFrame, ask: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """The rows of ``ask(cls, *keys)`` whose set may have a link into the chunk, by sketches of a quarter of a set's size at most."""
    def sketched(batches):
        for batch in batches:
            found = [sketch(np.frombuffer(t, np.uint64)).tobytes() for t in batch.column("tokens").to_pylist()]
            lengths = [len(t) // 8 for t in batch.column("tokens").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("cls"), pa.array(lengths, pa.int64()), pa.array(found, pa.binary())], names=["cls", "n", "sketch"])

    def run(batches):
        key, members, opened = None, [], None
        for batch in batches:
            kept = []
            for row in batch.to_pylist():
                if tuple(row[k] for k in keys) != key:
                    key, members, opened = tuple(row[k] for k in keys), [], None
                if not row["role"]:
                    members.append(row)
                    continue
                if members:
                    opened = opened or _Sketches(members)
                    if opened.may_link(row["n"], np.frombuffer(row["sketch"], np.int8), percent):
                        kept.append((row["cls"], *key))
            if kept:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*kept)], names=["cls", *keys])
    light = stage(sets.select("cls", "tokens").mapInArrow(sketched, "cls bigint, n bigint, sketch binary"), "sketches")
    placed = sets.select("cls", *keys).join(ask.select(*keys).distinct(), keys, "left_semi")
    members = placed.join(light, "cls").select(*keys, "cls", "n", "sketch", F.lit(0).alias("role"))
    queries = ask.join(light, "cls").select(*keys, "cls", "n", "sketch", F.lit(1).alias("role"))
    rows = members.unionByName(queries).repartition(*keys).sortWithinPartitions(*keys, "role")
    return rows.mapInArrow(run, ", ".join(f"{c} bigint" for c in ("cls", *keys)))


def _ask(sets: DataFrame, ask: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """Links ``(a, b)`` between the classes of ``ask(cls, *keys)`` and the members of the chunks they ask."""
    ask = stage(ask, "asked")
    members = sets.join(ask.select(*keys).distinct(), keys, "left_semi").select(*keys, "cls", "tokens", F.lit(0).alias("role"))
    queries = ask.join(sets.select("cls", "tokens"), "cls").select(*keys, "cls", "tokens", F.lit(1).alias("role"))
    rows = members.unionByName(queries).repartition(*keys).sortWithinPartitions(*keys, "role")
    return rows.mapInArrow(_answer(keys, percent), "a bigint, b bigint")


def _sets(docs: DataFrame, placed: DataFrame, width: int) -> DataFrame:
    """The full sets of the classes in ``placed``, from the text of the document that stands for each."""
    text = docs.select("row_key", "text").join(placed, "row_key").select("cls", "grp", "chunk", "chunks", "text")

    def work(chunk: pa.Table) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        sets = [shingles(t, width, hashes) for t in chunk.column("text").to_pylist()]
        own = [_signed(xxhash.xxh64_intdigest(s.tobytes())) for s in sets]
        right = pa.array(np.array(own, dtype=np.int64) == chunk.column("cls").to_numpy())
        columns = [chunk.column(c).combine_chunks() for c in ("cls", "grp", "chunk", "chunks")]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
            names=["cls", "grp", "chunk", "chunks", "n", "tokens"]).filter(right)
    found = map_chunks(text, ["cls", "grp", "chunk", "chunks", "text"], text_bytes("text"), CHUNK_BYTES, work,
                       "cls bigint, grp bigint, chunk bigint, chunks bigint, n bigint, tokens binary")
    return found


def _first_round(percent: int) -> Callable[[list[dict]], Iterator[tuple]]:
    def work(rows: list[dict]) -> Iterator[tuple]:
        roots = _connect(rows, percent) if len(rows) > 1 else [0]
        sizes = np.bincount(roots)
        for row, root in zip(rows, roots):
            yield row["cls"], rows[root]["cls"], int(sizes[root])
    return work


def _answer(keys: list[str], percent: int) -> Callable:
    """Rows come sorted by chunk, its members before those who ask; the latter pass one by one."""
    def run(batches):
        key, members, opened, a, b = None, [], None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                if tuple(row[k] for k in keys) != key:
                    key, members, opened = tuple(row[k] for k in keys), [], None
                if not row["role"]:
                    members.append(row)
                    continue
                if not members:
                    continue
                opened = opened or _Opened(members)
                found = opened.linked(np.frombuffer(row["tokens"], np.uint64), percent)
                a.extend([row["cls"]] * len(found))
                b.extend(members[j]["cls"] for j in found)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
                a, b = [], []
    return run
