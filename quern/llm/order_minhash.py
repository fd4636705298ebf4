"""Document fingerprints by Order MinHash. DataFrame operations only.

A text is a sequence of pieces (words, cut after ``PIECE`` code points, so texts without spaces have
pieces too) and its k-mers are ``k`` neighbouring pieces. A k-mer is numbered by how often it came before, so
repetition counts. The numbered k-mers are hashed once and dealt by hash to ``sketches`` bins; in
each bin the ``2`` of smallest hash are selected, put back in text order, and hashed as a tuple. Moving or
exchanging parts changes the order in tuples, so the share of equal tuples follows edit distance and not
only the sets. Likeness is the share of bins with equal tuples among bins that either text fills.

All steps are array functions over one row: two sorts of packed longs, no exchange. Texts of up to 2^28 pieces.
A text of fewer than ``k`` pieces has one k-mer; an empty, blank or null text has an empty fingerprint, which is
like another empty one only (1) and unlike all others (0).
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.text import unused

K = 2
SKETCH_BITS = 6
PIECE = 8
_PLACE = (1 << 28) - 1
_KMER = -1 << 28


def _places(array: Column) -> Column:
    """0, 1, ... for the elements of an array."""
    return F.when(F.size(array) > 0, F.sequence(F.lit(0), F.size(array) - 1)).otherwise(F.array().cast("array<int>"))


def _heads(array: Column, part: Callable[[Column], Column]) -> Column:
    """Places of a sorted array where ``part`` of the element changes."""
    return F.filter(_places(array), lambda j: (j == 0) | (part(F.get(array, j)) != part(F.get(array, j - 1))))


def with_fingerprint(df: DataFrame, text_col: str, name: str, k: int = K, sketch_bits: int = SKETCH_BITS, fill: bool = False) -> DataFrame:
    """Add column ``name``: array<int> of the filled bins' tuple hashes (bin in the lowest bits), in order of bins.
    ``fill`` completes bins of one k-mer; fingerprints with and without it are not comparable.

    Each step is a column of its own because an expression used within a lambda is evaluated per element.
    """
    step = [unused(df, f"{name}_step_{i}") for i in range(5)]
    pieces = F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(rf"[^\x20\x09-\x0D]{{1,{PIECE}}}"), F.lit(0))
    df = df.withColumn(step[0], F.transform(pieces, lambda p: F.xxhash64(p)))
    h = F.col(step[0])

    def kmer(i: Column) -> Column:
        return F.xxhash64(*(F.get(h, i + j) for j in range(k)))
    count = F.when(F.size(h) > 0, F.sequence(F.lit(0), F.greatest(F.size(h) - k, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    df = df.withColumn(step[1], F.sort_array(F.transform(count, lambda i: kmer(i).bitwiseAND(F.lit(_KMER)).bitwiseOR(i.cast("bigint")))))
    s = F.col(step[1])
    df = df.withColumn(step[2], _heads(s, lambda x: x.bitwiseAND(F.lit(_KMER))))
    starts = F.col(step[2])

    def numbered(j: Column, start: Column) -> Column:
        g = F.xxhash64(F.get(s, j).bitwiseAND(F.lit(_KMER)), j - start)
        return F.shiftleft(g.bitwiseAND(F.lit((1 << sketch_bits) - 1)), 63 - sketch_bits).bitwiseOR(
            F.shiftleft(F.shiftrightunsigned(g, 29 + sketch_bits), 28)).bitwiseOR(F.get(s, j).bitwiseAND(F.lit(_PLACE)))

    def run(r: Column) -> Column:
        start = F.get(starts, r)
        return F.transform(F.sequence(start, F.coalesce(F.get(starts, r + 1), F.size(s)) - 1), lambda j: numbered(j, start))
    df = df.withColumn(step[3], F.sort_array(F.flatten(F.transform(_places(starts), run))))
    t = F.col(step[3])
    df = df.withColumn(step[4], _heads(t, lambda x: F.shiftright(x, 63 - sketch_bits)))

    def tuple_hash(i: Column) -> Column:
        first, second = F.get(t, i), F.get(t, i + 1)
        bin_ = F.shiftright(first, 63 - sketch_bits)
        pair = F.shiftright(second, 63 - sketch_bits) == bin_
        if fill:
            second, pair = F.coalesce(second, F.get(t, F.lit(0))), F.size(t) > 1
        a, b = F.shiftright(first, 28), F.shiftright(second, 28)
        ordered = first.bitwiseAND(F.lit(_PLACE)) < second.bitwiseAND(F.lit(_PLACE))
        h = F.when(pair & ordered, F.xxhash64(a, b)).when(pair, F.xxhash64(b, a)).otherwise(F.xxhash64(a))
        low = F.lit((1 << 31) - (1 << sketch_bits))
        return h.bitwiseAND(low).bitwiseOR(bin_).cast("int")
    return df.withColumn(name, F.transform(F.col(step[4]), tuple_hash)).drop(*step)


def likeness(a: Column, b: Column, sketch_bits: int = SKETCH_BITS) -> Column:
    """Share of equal tuples among the bins that either fingerprint fills; two empty ones are alike."""
    bins = F.array_distinct(F.transform(F.concat(a, b), lambda x: x.bitwiseAND(F.lit((1 << sketch_bits) - 1))))
    return F.when(F.size(bins) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(bins))


def as_text(fingerprint: Column) -> Column:
    """Eight hexadecimal digits per filled bin."""
    return F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def _fixed(values: list, kind: str) -> Column:
    """An array as one literal, however long."""
    return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")


def with_next(docs: DataFrame, key: str, tie: str, columns: list[str]) -> DataFrame:
    """Add ``next_<c>``: the columns of the row that follows in descending order of ``key``, an integer or text (ties by ``tie``;
    null keys last, by hash of ``tie``); the first row follows the last.

    Rows are dealt to ranges of the key, found by binary search; a range also gets the first rows of the range behind it. So the order is
    global and no task sees more than a range. The driver sees one boundary and one first key per range.
    """
    ranges = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rank, part, home, guest = (unused(docs, name) for name in ("rank", "part", "home", "guest"))
    value, kind = F.col(key), dict(docs.dtypes)[key]
    if kind == "string":
        ranked = docs.withColumn(rank, F.coalesce(F.concat(F.lit("1"), value), F.concat(F.lit("0"), F.hex(F.xxhash64(tie)))))
        shares = ranked.select(rank).repartitionByRange(ranges, rank).groupBy(F.spark_partition_id().alias("share")).agg(F.min(rank).alias("mark"))
        marks = [r["mark"] for r in shares.collect()]
    else:
        kind = "bigint"
        if docs.filter(value.isNull()).limit(1).count():
            low = docs.agg(F.min(key)).first()[0]
            value = F.coalesce(value, F.lit((low or 0) - 1) - F.pmod(F.xxhash64(tie), F.lit(1 << 40)))
        ranked = docs.withColumn(rank, value.cast("bigint"))
        marks = ranked.agg(F.percentile_approx(rank, [i / ranges for i in range(1, ranges)], 20 * ranges)).first()[0] or []
    marks = sorted(set(marks))
    bounds, number = _fixed(marks, kind), F.lit(0)
    if marks:
        steps = F.array(*(F.lit(1 << i) for i in reversed(range(len(marks).bit_length()))))
        number = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(bounds, at + step - 1) <= F.col(rank), at + step).otherwise(at))
    ranked = ranked.withColumn(part, number)
    heads = dict(ranked.groupBy(part).agg(F.max(rank)).collect())
    order = sorted(heads, reverse=True)
    before = {p: order[i - 1] for i, p in enumerate(order)}
    every = range(len(marks) + 1)
    # The first rows of a range are guests at the end of the range before it.
    first = F.get(_fixed([heads.get(p) for p in every], kind), F.col(part)) == F.col(rank)
    own = F.struct(F.col(part).alias("part"), F.lit(0).alias("guest"))
    other = F.struct(F.get(_fixed([before.get(p) for p in every], "int"), F.col(part)).alias("part"), F.lit(1).alias("guest"))
    placed = ranked.withColumn(home, F.explode(F.when(first, F.array(own, other)).otherwise(F.array(own))))
    placed = placed.withColumns({part: F.col(home)["part"], guest: F.col(home)["guest"]}).drop(home)
    window = Window.partitionBy(part).orderBy(guest, F.col(rank).desc(), F.col(tie))
    placed = placed.withColumns({f"next_{c}": F.lead(c).over(window) for c in columns})
    return placed.filter(F.col(guest) == 0).drop(rank, part, guest)
