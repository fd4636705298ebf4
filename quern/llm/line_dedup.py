"""Line dedup over levelled sorted runs of line hashes. DataFrame operations only.

The store of known lines is a list of *runs*: tables ``(h1, h2, docs)`` bucketed and sorted by
line hash, each saying in how many documents of its batches a line stands. A batch is reduced
to its own counts, merge-anti-joined with the lines that the runs already hold often enough
(they need no more counting) and added as a run of level 0. When a level has ``fanout`` runs
they are compacted into one run of the next level, so a key is rewritten a logarithmic number
of times and a batch costs what it holds. Runs are bucketed by hash: merging and
anti-joining them shuffles nothing but the new batch.

A line's key is the line without white space at both ends, A-Z lower-cased. A key is hashed to
128 bits; equal hashes count as equal lines. Null text is empty text, which is one empty line.
Empty keys are never dropped. Every row is a document, so repeated rows count each.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.text import WHITESPACE, digest, fold
from quern.session import new_folder, stage

MIN_DOCS = 10
BATCHES = 4
FANOUT = 4


def line_key(line: Column) -> Column:
    return fold(F.trim(line, F.lit(WHITESPACE)))


def _hashed_lines(text: Column) -> Column:
    """Per line a struct ``(h1, h2)``, null for an empty key."""
    def hashed(line: Column) -> Column:
        key = line_key(line)
        return F.when(F.length(key) > 0, F.struct(*(h.alias(n) for h, n in zip(digest(key), ("h1", "h2")))))
    return F.transform(F.split(text, "\n"), hashed)


def keyed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its row key ``(r1, r2)`` and the hashes of its lines, staged."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    r1, r2 = digest(F.col(id_col), text)
    return stage(docs.select(r1.alias("r1"), r2.alias("r2"), _hashed_lines(text).alias("keys")), "line-keys")


class LineRuns:
    """The levelled runs of one store. The driver keeps their table names only."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def tables(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def _write(self, counts: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (counts.repartition(self.buckets, "h1").write.bucketBy(self.buckets, "h1").sortBy("h1", "h2")
         .saveAsTable(name, path=new_folder(self.spark, "line-run")))
        return name

    def counts(self, names: list[str] | None = None) -> DataFrame:
        """Documents per line: the runs merge-joined on their buckets, counts summed."""
        merged, *rest = [self.spark.table(n) for n in (self.tables() if names is None else names)]
        for part in rest:
            merged = merged.join(part.withColumnRenamed("docs", "more"), ["h1", "h2"], "full_outer").select(
                "h1", "h2", (F.coalesce("docs", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("docs"))
        return merged

    def add(self, keyed: DataFrame, min_docs: int = MIN_DOCS) -> None:
        """Count a batch of ``keyed_lines`` and add it as a run."""
        own = keyed.select(F.explode(F.array_distinct(F.filter("keys", lambda k: k.isNotNull()))).alias("k"))
        own = own.groupBy(F.col("k.h1").alias("h1"), F.col("k.h2").alias("h2")).agg(F.count(F.lit(1)).alias("docs"))
        if self.levels:
            own = own.join(self.counts().filter(F.col("docs") >= min_docs), ["h1", "h2"], "left_anti")
        self._place(self._write(own), 0)

    def _place(self, name: str, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            old, self.levels[level] = self.levels[level], []
            self._place(self._write(self.counts(old)), level + 1)
            self._forget(old)

    def _forget(self, names: list[str]) -> None:
        for n in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {n}")

    def close(self) -> None:
        self._forget(self.tables())
        self.levels = []


def frequent_lines(keyed: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """Hashes ``(h1, h2)`` of the lines that stand in at least ``min_docs`` documents, staged."""
    runs = LineRuns(keyed.sparkSession)
    for i in range(batches):
        runs.add(keyed.filter(F.pmod("r1", F.lit(batches)) == i), min_docs)
    found = stage(runs.counts().filter(F.col("docs") >= min_docs).select("h1", "h2"), "frequent-lines")
    runs.close()
    return found


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, id_col: str = "doc_id", text_col: str = "text",
                batches: int = BATCHES, report: tuple[str, str] = ("n_lines", "n_dropped")) -> DataFrame:
    """Drop every line whose key stands in at least ``min_docs`` documents, in all of them.

    Returns the input's columns with the text replaced by the other lines joined by a line
    feed (null only where the text was null), and the lines before and the lines dropped under the
    names ``report`` (input columns of these names are replaced). Rows are kept, repeated and null ids as well; an empty table
    gives an empty one.
    """
    keyed = keyed_lines(docs, id_col, text_col)
    frequent = frequent_lines(keyed, min_docs, batches).withColumn("hot", F.lit(True))
    lines = keyed.select("r1", "r2", F.posexplode("keys").alias("pos", "k")).select(
        "r1", "r2", "pos", F.col("k.h1").alias("h1"), F.col("k.h2").alias("h2"))
    marks = lines.join(frequent, ["h1", "h2"], "left").select(
        "r1", "r2", F.struct("pos", F.coalesce("hot", F.lit(False)).alias("hot")).alias("mark"))
    marks = marks.groupBy("r1", "r2").agg(F.sort_array(F.collect_set("mark"))["hot"].alias("hot"))

    text = F.coalesce(F.col(text_col), F.lit(""))
    r1, r2 = digest(F.col(id_col), text)
    rows = docs.select(F.struct("*").alias("row"), r1.alias("r1"), r2.alias("r2")).join(marks, ["r1", "r2"], "left")
    pairs = F.arrays_zip(F.split(F.coalesce(F.col("row")[text_col], F.lit("")), "\n").alias("line"), F.col("hot").alias("hot"))
    kept = F.array_join(F.filter(pairs, lambda p: ~p["hot"])["line"], "\n")
    done = rows.select("row", F.size("hot").cast("bigint").alias(report[0]),
                       F.size(F.filter("hot", lambda h: h)).cast("bigint").alias(report[1]), kept.alias("kept"))
    columns = [F.when(F.col("row")[c].isNotNull(), F.col("kept")).alias(c) if c == text_col else F.col("row")[c].alias(c)
               for c in docs.columns if c not in report]
    return done.select(*columns, *report)
