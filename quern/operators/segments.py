"""A stored lexical index that grows by segments.

Every batch of documents becomes one immutable segment: its postings, the change it makes to each term's document frequency, and to
each field's documents and total length. A document that comes again counts its former terms off, read from the stored
documents, so statistics over segments are plain sums and a search equals one over an index built anew. Postings of
former versions stay in older segments and are skipped by id; ``merge`` folds neighbouring segments of like size, which drops them. A
published version names the live segments (see ``versions``): a load that fails changes nothing, and a named batch is added once.

Postings lie in buckets by term and slice, sorted, so the terms of any number of queries meet them in a merge join that does not
move the index. A task packs the postings of ``CHUNK_TOKENS`` tokens before they move: one row per term, with lists. The lists of a
segment of more than ``HOT`` documents are dealt to slices, so no bucket holds a whole stop word.
One writer at a time; a second one fails when it publishes.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.operators import lexical
from quern.operators.matching import dot_topk
from quern.session import ship_package, stage
from quern.sources.keyed import KeyedTable
from quern.sources.sinks import latest_by_key
from quern.sources.versions import VersionLog

HOT = 1_000_000
CHUNK_TOKENS = 4_000_000
POSTINGS_PER_TASK = 4_000_000  # what a task sorts while a segment is written
BYTES_PER_POSTING = 8  # of text; an estimate that only decides the number of tasks
FANOUT = 4
ROWS = "postings"
TERMS = "terms"
GONE = "gone"


@dataclass
class _Segment:
    folder: str
    number: int
    postings: int
    fields: dict[str, list[int]]  # field -> change of documents, change of total length
    gone: int

    @property
    def tier(self) -> int:
        return int(math.log(max(1, self.postings), FANOUT))


@dataclass
class _Manifest:
    fields: list[str]
    keep: list[str]
    han: str
    buckets: int
    schema: str
    docs_version: int
    segments: list[dict] = field(default_factory=list)
    batches: dict[str, int] = field(default_factory=dict)
    next_number: int = 0

    @property
    def parts(self) -> list[_Segment]:
        return [_Segment(**s) for s in self.segments]


def _write_bucketed(rows: DataFrame, folder: str, buckets: int, columns: Sequence[str], share: int = 1) -> None:
    """Sorted files, ``share`` tasks and files per bucket; the catalog only helps to write and forgets the table."""
    name = f"quern_{uuid.uuid4().hex}"
    (rows.repartition(buckets * share, *columns).write.bucketBy(buckets, *columns).sortBy(*columns).option("path", folder)
     .option("compression", "zstd").format("parquet").saveAsTable(name))
    rows.sparkSession.sql(f"DROP TABLE {name}")


def read_bucketed(spark: SparkSession, folder: str, schema: str, buckets: int, columns: Sequence[str]) -> DataFrame:
    """The bucketed files of a folder as a table whose buckets Spark knows."""
    name, keys = f"quern_{uuid.uuid4().hex}", ", ".join(columns)
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS "
              f"LOCATION '{folder}'")
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def _listed(values: pa.Array, at: np.ndarray, starts: np.ndarray, count: np.ndarray) -> pa.Array:
    """Lists of the values ``at`` some places; of a list of equal values only the first is kept."""
    if not pa.types.is_nested(values.type):
        code = values.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)[at]
        same = np.minimum.reduceat(code, starts) == np.maximum.reduceat(code, starts)
        kept = ~np.repeat(same, count)
        kept[starts] = True
        at, count = at[kept], np.where(same, 1, count)
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(count)), pa.int32()), values.take(pa.array(at)))


def _pack_postings(lists: Sequence[str]):
    """Rows ``(*lists, field, tokens)`` to one row per term and chunk of about ``CHUNK_TOKENS`` tokens, with lists, their
    size, and of a mark the sum of the lengths."""
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, total = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                held.append(part)
                total += len(part.column("tokens").flatten())
                if total >= CHUNK_TOKENS:
                    yield pa.Table.from_batches(held)
                    held, total = [], 0
        if held:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            n, tokens = chunk.num_rows, chunk["tokens"].combine_chunks()
            lengths = pc.list_value_length(tokens).to_numpy().astype(np.int64)
            words = tokens.flatten().dictionary_encode()
            fields = chunk["field"].combine_chunks().dictionary_encode()
            size = len(words.dictionary) + 1  # the last one is the mark that every document of a field has
            row = np.concatenate([np.repeat(np.arange(n), lengths), np.arange(n)])
            code = np.concatenate([words.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.full(n, size - 1)])
            field_of = fields.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            key, tf = np.unique((field_of[row] * size + code) * n + row, return_counts=True)
            term, row = key // n, key % n
            starts = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
            count = np.diff(np.append(starts, len(key)))
            field = fields.dictionary.take(pa.array(term[starts] // size))
            vocabulary = pa.concat_arrays([words.dictionary.cast(pa.string()), pa.array([lexical.LENGTH_MARK])])
            named = pc.binary_join_element_wise(field.cast(pa.string()), vocabulary.take(pa.array(term[starts] % size)), ":")
            columns = [_listed(chunk[c].combine_chunks(), row, starts, count) for c in lists]
            columns += [_listed(pa.array(x, pa.int32()), np.arange(len(key)), starts, count) for x in (lengths[row], tf)]
            marks = term[starts] % size == size - 1
            sums = [pa.array(count), pa.array(np.where(marks, np.add.reduceat(lengths[row], starts), 0))]
            yield pa.RecordBatch.from_arrays([named, field, *columns, *sums],
                                             names=["term", "field", *lists, "field_length", "tf", "n", "length"])
    return run


def _is_mark() -> Column:
    """Rows that tell which documents have a field, and how long it is."""
    return F.col("term") == F.concat_ws(":", "field", F.lit(lexical.LENGTH_MARK))


class SearchIndex:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.log, self.docs = VersionLog(spark, self.path), KeyedTable(spark, f"{self.path}/docs")

    @classmethod
    def create(cls, spark: SparkSession, path: str, docs: DataFrame, fields: Sequence[str], keep: Sequence[str] = (), han: str = "run",
               buckets: int = 32) -> SearchIndex:
        """An empty index for documents shaped like ``docs``; ``keep`` are columns to filter by while searching."""
        index = cls(spark, path)
        if index.log.latest():
            raise FileExistsError(f"an index exists at {path}")
        schema = docs.select("doc_id", *keep, *(f for f in fields if f not in keep)).schema
        KeyedTable.create(spark, f"{index.path}/docs", schema, ["doc_id"], buckets, if_exists="keep")
        index.log.publish(0, asdict(_Manifest(lexical.known_fields(docs, fields), list(keep), han, buckets, schema.json(), index.docs.version)))
        return index

    def _at(self) -> tuple[int, _Manifest]:
        found = self.log.latest()
        if found is None:
            raise FileNotFoundError(f"no index at {self.path}")
        return found[0], _Manifest(**found[1])

    def segments(self) -> list[tuple[int, int]]:
        """Number and postings of the live segments, oldest first."""
        return [(s.number, s.postings) for s in self._at()[1].parts]

    # ---------------------------------------------------------------- writing

    def add(self, docs: DataFrame, version: Sequence[str], source: str | None = None, batch: int = 0) -> int:
        """Add documents, or put new versions in place of those of the same id. Returns the published version."""
        _, manifest = self._at()
        columns = T.StructType.fromJson(json.loads(manifest.schema)).names
        current = latest_by_key(docs.select(*dict.fromkeys([*columns, *version])), ["doc_id"], version).select(*columns)
        return self._apply(stage(current.where("doc_id IS NOT NULL"), "segment-docs", "zstd"), True, source, batch)

    def delete(self, ids: DataFrame, source: str | None = None, batch: int = 0) -> int:
        """Remove the documents of these ids."""
        return self._apply(stage(ids.select("doc_id").where("doc_id IS NOT NULL").distinct(), "segment-deletes"), False, source, batch)

    def _apply(self, rows: DataFrame, added: bool, source: str | None, batch: int) -> int:
        version, manifest = self._at()
        if source is not None and manifest.batches.get(source, -1) >= batch:
            return version
        if self.docs.version != manifest.docs_version:  # a former writer was cut short after storing its documents
            self.docs.restore(manifest.docs_version)
        former = self.docs.matching(rows)  # of the version before, whose files stay
        off = self._packed(former, manifest).groupBy("term", "field").agg(F.sum("n").alias("n"), F.sum("length").alias("length"))
        off = stage(off, "segment-off")
        change = self.docs.load(rows, ["doc_id"], single=True) if added else self.docs.delete(rows)
        folder, number = f"segments/{uuid.uuid4().hex}", manifest.next_number
        if added:
            new, (docs, size) = self._packed(rows, manifest), rows.agg(F.count("*"), F.coalesce(F.sum(sum(
                F.coalesce(F.octet_length(lexical.field_text(rows, f).cast("string")), F.lit(0)) for f in manifest.fields)), F.lit(0))).first()
        else:
            new, docs, size = self.spark.createDataFrame([], self._lists(manifest)), 0, 0
        segment = self._write(folder, number, manifest, new, docs, size // BYTES_PER_POSTING, off, former.select("doc_id"))
        segments = [*manifest.segments, asdict(segment)]
        batches = manifest.batches | ({source: batch} if source is not None else {})
        self.log.publish(version + 1, asdict(_Manifest(manifest.fields, manifest.keep, manifest.han, manifest.buckets, manifest.schema, change,
                                                       segments, batches, number + 1)))
        return version + 1

    def _packed(self, docs: DataFrame, manifest: _Manifest) -> DataFrame:
        """Postings and the marks of the fields as lists; neither the texts nor their tokens leave the task that reads them."""
        ship_package(self.spark)
        kinds = self._ddl(manifest)
        rows = lexical.analysed(docs, manifest.fields, manifest.keep, manifest.han)
        return rows.mapInArrow(_pack_postings(list(kinds)), self._lists(manifest))

    def _lists(self, manifest: _Manifest) -> str:
        own = ", ".join(f"`{c}` array<{kind}>" for c, kind in self._ddl(manifest).items())
        return f"term string, field string, {own}, field_length array<int>, tf array<int>, n bigint, length bigint"

    def _write(self, folder: str, number: int, manifest: _Manifest, lists: DataFrame, docs: int, postings: int, off: DataFrame, gone: DataFrame,
               fields: dict[str, list[int]] | None = None) -> _Segment:
        """Lists of about ``postings`` postings of ``docs`` documents; ``off`` are counts to take off, ``fields`` the changes if known."""
        base, slices = f"{self.path}/{folder}", max(1, -(-docs // HOT))
        cut = F.pmod(F.xxhash64(F.element_at("doc_id", 1)), F.lit(slices)).cast("int")
        known = lists.select("term", cut.alias("slice"), *(f"`{c}`" for c in lists.columns if c != "term"))
        share = -(-postings // (manifest.buckets * POSTINGS_PER_TASK))
        _write_bucketed(known, f"{base}/{ROWS}", manifest.buckets, ["term", "slice"], max(1, share))
        written = self.spark.read.schema("term string, field string, n bigint, length bigint").parquet(f"{base}/{ROWS}")
        signed = written.select("*", F.col("n").alias("here")).unionByName(
            off.select("term", "field", (-F.col("n")).alias("n"), (-F.col("length")).alias("length"), F.lit(0).alias("here")))
        terms = signed.where(~_is_mark()).groupBy("term").agg(F.sum("n").alias("df"), F.sum("here").alias("here"))
        terms = terms.where("df <> 0 OR here > 0").select("term", "df", F.lit(slices).alias("slices"), "here")
        _write_bucketed(terms, f"{base}/{TERMS}", manifest.buckets, ["term"])
        gone.write.parquet(f"{base}/{GONE}")
        if fields is None:
            sums = {r["field"]: [r["docs"], r["length"]] for r in signed.where(_is_mark()).groupBy("field").agg(
                F.sum("n").alias("docs"), F.sum("length").alias("length")).collect()}
            fields = {f: sums.get(f, [0, 0]) for f in manifest.fields}
        here = self.spark.read.schema("here bigint").parquet(f"{base}/{TERMS}").agg(F.coalesce(F.sum("here"), F.lit(0)).alias("n")).first()
        return _Segment(folder, number, here["n"], fields, self.spark.read.parquet(f"{base}/{GONE}").count())

    def merge(self, fanout: int = FANOUT) -> int:
        """Fold the newest segments while ``fanout`` neighbours are of like size; returns how many merges were made.

        So a posting is rewritten a logarithmic number of times and few segments stay. Former versions of documents go."""
        made = 0
        while True:
            version, manifest = self._at()
            parts = manifest.parts
            run = len(parts)
            while run and parts[run - 1].tier <= max((p.tier for p in parts[-fanout:]), default=0):
                run -= 1
            if len(parts) - run < fanout:
                return made
            self._fold(version, manifest, run)
            made += 1

    def fold_all(self) -> None:
        """All segments into one."""
        version, manifest = self._at()
        if len(manifest.segments) > 1:
            self._fold(version, manifest, 0)

    def _fold(self, version: int, manifest: _Manifest, start: int) -> None:
        older, folded = manifest.parts[:start], manifest.parts[start:]
        rows = reduce(DataFrame.unionByName, [self._unpacked(self._rows(s, manifest, ROWS, False).where(~_is_mark()), manifest)
                                              .withColumn("segment", F.lit(s.number)) for s in folded])
        live = stage(self._live(rows, manifest).drop("slice", "segment"), "merge-postings")
        postings = live.count()
        part = F.pmod(F.xxhash64("doc_id"), F.lit(-(-postings // CHUNK_TOKENS) or 1))
        one = F.struct(*(F.col(f"`{c}`") for c in self._ddl(manifest)), *(F.col(c).cast("int").alias(c) for c in ("field_length", "tf")))
        lists = live.groupBy("term", "field", part).agg(F.collect_list(one).alias("p")).select(
            "term", "field", *(F.col(f"p.`{c}`").alias(c) for c in [*self._ddl(manifest), "field_length", "tf"]),
            F.size("p").cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("length"))
        counts = [self._rows(s, manifest, TERMS, False).select("term", (-F.col("df")).alias("n")) for s in folded]
        off = reduce(DataFrame.unionByName, [*counts, live.groupBy("term").agg(F.count("*").alias("n"))]).groupBy("term").agg(F.sum("n").alias("n"))
        off = off.select("term", F.lit(None).cast("string").alias("field"), "n", F.lit(0).cast("bigint").alias("length"))
        gone = reduce(DataFrame.unionByName, [self._gone(s) for s in folded]).select("doc_id").distinct()
        fields = {f: [sum(s.fields[f][i] for s in folded) for i in (0, 1)] for f in manifest.fields}
        docs = live.select("doc_id").distinct().count()
        merged = self._write(f"segments/{uuid.uuid4().hex}", folded[-1].number, manifest, lists, docs, postings, off,
                             gone if older else gone.limit(0), fields)
        segments = [asdict(s) for s in older] + [asdict(merged)]
        self.log.publish(version + 1, asdict(_Manifest(**{**asdict(manifest), "segments": segments})))

    def vacuum(self) -> int:
        """Remove all but the newest version and the segments it does not name; returns how many segments went. Not beside a writer."""
        live = {s.folder.split("/")[-1] for s in self._at()[1].parts}
        dead = [s for s in self.log.children(f"{self.path}/segments") if s not in live]
        for v in self.log.versions()[:-1]:
            self.log.forget(v)
        for s in dead:
            self.log.remove(f"{self.path}/segments/{s}")
        self.docs.vacuum(keep=1)
        return len(dead)

    # ---------------------------------------------------------------- reading

    def _ddl(self, manifest: _Manifest) -> dict[str, str]:
        kinds = {f.name: f.dataType.simpleString() for f in T.StructType.fromJson(json.loads(manifest.schema)).fields}
        return {"doc_id": kinds["doc_id"], **{c: kinds[c] for c in manifest.keep}}

    def _rows(self, segment: _Segment, manifest: _Manifest, part: str, bucketed: bool) -> DataFrame:
        """Postings or terms of a segment. Buckets are made known only where a join uses them at once: Spark may read them as
        plain files below a union, and must then not take the union to be dealt out by term."""
        schema, columns = {ROWS: (f"{self._lists(manifest)}, slice int", ["term", "slice"]),
                           TERMS: ("term string, df bigint, slices int", ["term"])}[part]
        folder = f"{self.path}/{segment.folder}/{part}"
        if bucketed:
            return read_bucketed(self.spark, folder, schema, manifest.buckets, columns)
        return self.spark.read.schema(schema).parquet(folder)

    def _unpacked(self, lists: DataFrame, manifest: _Manifest) -> DataFrame:
        """One row per posting."""
        names = [*self._ddl(manifest), "field_length", "tf"]
        whole = {c: F.when(F.size(f"`{c}`") < F.col("n"), F.array_repeat(F.element_at(f"`{c}`", 1), F.col("n").cast("int")))
                 .otherwise(F.col(f"`{c}`")) for c in names}
        each = F.inline(F.arrays_zip(*(F.col(f"`{c}`") for c in names)))
        return (lists.withColumns(whole).select("term", "slice", "field", each).withColumn("field_length", F.col("field_length").cast("bigint"))
                .withColumn("tf", F.col("tf").cast("bigint")))

    def _gone(self, segment: _Segment) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{segment.folder}/{GONE}").withColumn("until", F.lit(segment.number))

    def _live(self, postings: DataFrame, manifest: _Manifest) -> DataFrame:
        """Postings whose document did not come again, and was not removed, after their segment."""
        later = [self._gone(s) for s in manifest.parts if s.gone]
        if not later:
            return postings
        last = reduce(DataFrame.unionByName, later).groupBy("doc_id").agg(F.max("until").alias("until"))
        return postings.join(last, "doc_id", "left").where(F.col("until").isNull() | (F.col("until") <= F.col("segment"))).drop("until")

    def field_stats(self) -> DataFrame:
        """``(field, n_docs, avg_length)`` from the sums of the segments."""
        _, manifest = self._at()
        rows = []
        for f in manifest.fields:
            docs, length = (sum(s.fields[f][i] for s in manifest.parts) for i in (0, 1))
            if docs:
                rows.append((f, docs, length / docs))
        return self.spark.createDataFrame(rows, "field string, n_docs bigint, avg_length double")

    def term_stats(self) -> DataFrame:
        """``(term, df)`` of the terms that live documents hold."""
        _, manifest = self._at()
        parts = [self._rows(s, manifest, TERMS, False).select("term", "df") for s in manifest.parts]
        if not parts:
            return self.spark.createDataFrame([], "term string, df bigint")
        return reduce(DataFrame.unionByName, parts).groupBy("term").agg(F.sum("df").alias("df")).where("df > 0")

    def touched(self, terms: DataFrame, condition=None) -> DataFrame:
        """Live postings of the distinct ``terms(term)``, met bucket by bucket; ``condition`` filters by the kept columns."""
        _, manifest = self._at()
        parts = []
        for segment in manifest.parts:
            found = self._rows(segment, manifest, TERMS, True).join(terms, "term").select(
                "term", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
            rows = self._unpacked(self._rows(segment, manifest, ROWS, True).join(found, ["term", "slice"], "left_semi"), manifest)
            parts.append((rows if condition is None else rows.where(condition)).withColumn("segment", F.lit(segment.number)))
        if not parts:
            own = ", ".join(f"`{c}` {kind}" for c, kind in self._ddl(manifest).items())
            return self.spark.createDataFrame([], f"term string, slice int, field string, {own}, field_length bigint, tf bigint, segment int")
        return self._live(reduce(DataFrame.unionByName, parts), manifest)

    def search(self, queries: DataFrame, boosts: Mapping[str, float], k: int, allowed=None) -> DataFrame:
        """BM25 top-k as ``lexical.bm25_topk`` gives it on the live documents; ``allowed`` is a condition on kept columns."""
        _, manifest = self._at()
        unknown = sorted(set(boosts) - set(manifest.fields))
        if unknown:
            raise ValueError(f"fields that are not indexed: {unknown}")
        terms = stage(lexical.query_terms(queries, boosts, manifest.han), "asked-terms")
        distinct = terms.select("term").distinct()
        postings = stage(self.touched(distinct, allowed).select("doc_id", "term", "field", "field_length", "tf"), "postings")
        stats = self.field_stats()
        df = self.term_stats().join(distinct, "term", "left_semi")
        idf = F.log1p((F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
        asked = terms.join(df, "term").join(F.broadcast(stats), "field").select("query_id", "term", (F.col("query_weight") * idf).alias("query_weight"))
        weighted = lexical.saturation(postings, stats).select("doc_id", "term", "doc_weight")
        return dot_topk(asked, weighted, k, terms.count(), postings.count())
