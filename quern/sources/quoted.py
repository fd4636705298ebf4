"""Separated files with quotes, read by many tasks per file although quoted fields may hold line breaks.

Whether a line starts a record or continues a quoted field depends on all lines before it. A line maps each of these
two states to the state after it, and such maps compose. So a first pass gives the map of every block of a file, a
prefix composition over the blocks of a file tells each block in which state it starts, and a second pass parses
all blocks independently. Records that cross a block's end are put together from one piece per block.

The first pass sends only lines with quotes to Python. The driver gets 17 bytes per block (some 14 MB for 100 TB in
blocks of 128 MB), which the tasks then share. If files or their splits change between the passes the scan fails.

Records are those of Python's ``csv.reader``: a quote opens a field only at its start, doubled quotes stand for one, what follows a
closing quote is kept, empty lines are skipped. A quote that is never closed ends with the file, without its last line break.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.session import ship_package

ORDER = ["_file", "_block", "_row"]
_MAX_FIELD = 2**31 - 1


def ends_inside(line: str, inside: bool, sep: str = "\t") -> bool:
    """Whether a quoted field is open after ``line``, given whether one was before."""
    at = 0
    while True:
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            if line.startswith('"', at + 1):
                at += 2
                continue
            inside, at = False, at + 1
        elif line.startswith('"', at):
            inside, at = True, at + 1
            continue
        at = line.find(sep, at)
        if at < 0:
            return False
        at += 1


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """The parts of a batch that lie in one block of one file."""
    file, block = batch.column("file").to_numpy(), batch.column("block").to_numpy()
    edges = np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1
    for start, stop in zip([0, *edges], [*edges, batch.num_rows]):
        if stop > start:
            yield (int(file[start]), int(block[start])), batch.slice(start, stop - start)


def _block_maps(lines: DataFrame, sep: str) -> DataFrame:
    """``(file, block, after_outside, after_inside)`` of every block."""
    def run(batches):
        key, maps = None, (False, True)

        def row():
            return pa.RecordBatch.from_pydict({"file": pa.array([key[0]], pa.int64()), "block": pa.array([key[1]], pa.int64()),
                                               "after_outside": [maps[0]], "after_inside": [maps[1]]})
        for batch in batches:
            for place, part in _runs(batch):
                if place != key:
                    if key is not None:
                        yield row()
                    key, maps = place, (False, True)
                for line in part.column("value").drop_null().to_pylist():
                    maps = tuple(ends_inside(line, state, sep) for state in maps)
        if key is not None:
            yield row()
    quoted = F.when(F.col("value").contains('"'), F.col("value")).alias("value")
    return lines.select("file", "block", quoted).mapInArrow(run, "file bigint, block bigint, after_outside boolean, after_inside boolean")


class _Starts:
    """The blocks in order, and whether each starts and ends inside a quoted field."""

    def __init__(self, maps: pa.Table):
        maps = maps.sort_by([("file", "ascending"), ("block", "ascending")])
        self.file, self.block = maps.column("file").to_numpy(), maps.column("block").to_numpy()
        after = (maps.column("after_outside").to_pylist(), maps.column("after_inside").to_pylist())
        self.starts, self.ends, state, last = np.zeros(len(self.file), dtype=bool), np.zeros(len(self.file), dtype=bool), False, None
        for i, file in enumerate(self.file):
            state = state and file == last
            self.starts[i] = state
            self.ends[i] = state = after[int(state)][i]
            last = file

    def of(self, key: tuple[int, int]) -> bool:
        lo, hi = np.searchsorted(self.file, key[0], "left"), np.searchsorted(self.file, key[0], "right")
        at = lo + np.searchsorted(self.block[lo:hi], key[1])
        if at == hi or self.block[at] != key[1]:
            raise RuntimeError("the files or their splits changed while they were read")
        return bool(self.starts[at])


def _fields(record: str, sep: str) -> list[str]:
    csv.field_size_limit(_MAX_FIELD)
    return next(csv.reader([record], delimiter=sep), [])


class _Block:
    """Lines of one block: complete records as rows, and pieces of records that cross its ends."""

    def __init__(self, inside: bool, sep: str):
        self.sep, self.inside, self.entered = sep, inside, inside
        self.row, self.first, self.open = 0, 0, []

    def add(self, values: pa.Array, records: list[tuple[int, list[str]]], pieces: list[tuple[int, bool, str]]) -> np.ndarray:
        """Takes lines in turn; returns the places of those that are whole records without a quote."""
        plain, at = np.ones(len(values), dtype=bool), 0
        for i in np.flatnonzero(pc.match_substring(values, '"').to_numpy(zero_copy_only=False)):
            if self.inside:
                self.open += values.slice(at, i - at).to_pylist()
                plain[at:i] = False
            else:
                self.first = self.row + int(i)
            line = values[int(i)].as_py()
            self.open.append(line)
            plain[i], at = False, i + 1
            self.inside = ends_inside(line, self.inside, self.sep)
            if not self.inside:
                self.close(records, pieces)
        if self.inside:
            self.open += values.slice(at).to_pylist()
            plain[at:] = False
        self.row += len(values)
        return np.flatnonzero(plain)

    def close(self, records, pieces) -> None:
        text = "\n".join(self.open)
        if self.entered:
            pieces.append((0, True, text))
        else:
            records.append((self.first, _fields(text, self.sep)))
        self.entered, self.open = False, []

    def finish(self, pieces) -> None:
        if self.inside:
            pieces.append((0 if self.entered else self.first, self.entered, "\n".join(self.open)))


def _parse(lines: DataFrame, starts, sep: str, crossing: bool) -> DataFrame:
    """Records inside blocks ``(fields, *ORDER)`` or, with ``crossing``, pieces ``(_file, _block, _row, entered, piece)``."""
    def rows(key, path, records, plain, values, first) -> pa.RecordBatch:
        kept = plain[pc.not_equal(values.take(pa.array(plain)), "").to_numpy(zero_copy_only=False)]
        fields = [pc.split_pattern(values.take(pa.array(kept)), sep), pa.array([f for _, f in records], pa.list_(pa.string()))]
        numbers = np.concatenate([kept + first, np.array([r for r, _ in records], dtype=np.int64)])
        return pa.RecordBatch.from_arrays([pa.concat_arrays(fields), pa.array([path] * len(numbers), pa.string()),
                                           pa.array(np.full(len(numbers), key[1])), pa.array(numbers, pa.int64())], names=["fields", *ORDER])

    def fragments(key, path, pieces) -> pa.RecordBatch:
        n = len(pieces)
        return pa.RecordBatch.from_arrays(
            [pa.array([path] * n, pa.string()), pa.array([key[1]] * n, pa.int64()), pa.array([r for r, _, _ in pieces], pa.int64()),
             pa.array([e for _, e, _ in pieces], pa.bool_()), pa.array([t for _, _, t in pieces], pa.string())],
            names=[*ORDER, "entered", "piece"])

    def run(batches):
        key, path, block, pieces = None, None, None, []
        for batch in batches:
            for place, part in _runs(batch):
                if place != key:
                    if block is not None:
                        block.finish(pieces)
                        if crossing:
                            yield fragments(key, path, pieces)
                    key, path, block, pieces = place, part.column("_file")[0].as_py(), _Block(starts.value.of(place), sep), []
                values, first, records = part.column("value"), block.row, []
                plain = block.add(values, records, pieces)
                if not crossing:
                    yield rows(key, path, records, plain, values, first)
                    pieces.clear()
        if crossing and block is not None:
            block.finish(pieces)
            yield fragments(key, path, pieces)
    schema = "_file string, _block bigint, _row bigint, entered boolean, piece string" if crossing else (
        "fields array<string>, _file string, _block bigint, _row bigint")
    return lines.select("file", "block", "_file", "value").mapInArrow(run, schema)


def scan_quoted(spark: SparkSession, paths: str | list[str], sep: str = "\t") -> DataFrame:
    """``(fields, _file, _block, _row)``: every record of the files; the last three order records as they stand."""
    ship_package(spark)
    lines = spark.read.text(paths).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_path").alias("_file"), "value")
    found = _Starts(_block_maps(lines, sep).toArrow())
    starts = spark.sparkContext.broadcast(found)
    whole = _parse(lines, starts, sep, crossing=False)
    touched = found.starts | found.ends
    if not touched.any():
        return whole
    blocks = spark.createDataFrame(pa.table({"file": found.file[touched], "block": found.block[touched]}))
    pieces = _parse(lines.join(F.broadcast(blocks), ["file", "block"], "left_semi"), starts, sep, crossing=True)
    before = Window.partitionBy("_file").orderBy("_block", "_row").rowsBetween(Window.unboundedPreceding, 0)
    head = F.last(F.when(~F.col("entered"), F.struct("_block", "_row")), ignorenulls=True).over(before)
    together = pieces.withColumn("head", head).groupBy("_file", "head").agg(
        F.array_sort(F.collect_list(F.struct("_block", "_row", "piece"))).alias("pieces"))

    def parse(batches):
        for batch in batches:
            fields = [_fields(t, sep) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(fields, pa.list_(pa.string())), *(batch.column(c) for c in ORDER)], names=["fields", *ORDER])
    crossed = together.select(F.array_join("pieces.piece", "\n").alias("text"), "_file", "head._block", "head._row").mapInArrow(parse, whole.schema)
    return whole.unionByName(crossed)
