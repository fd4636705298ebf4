"""A stored table with one row per key, changed by copy on write.

Rows lie in folders by a hash of their key. A load writes new folders for the buckets it touches and nothing else, then
publishes a version that names the live folder of every bucket (see ``versions``). Until then readers see the version
before, so a failed or half-done load changes nothing, and an older version stays readable until ``vacuum``.

Loads may run side by side: one that comes second keeps its folders if the other touched different buckets, else it starts again
on the new version. A load named by ``(source, batch)`` is applied once. Nulls in a key are equal to each other. The driver
holds one entry per bucket.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.schemas import SchemaConflict, conform, evolve
from quern.session import stage
from quern.sources.sinks import latest_by_key
from quern.sources.versions import VersionConflict, VersionLog

BUCKET = "_bucket"
LOAD = "_load"
ATTEMPTS = 8


@dataclass
class _Manifest:
    schema: str
    keys: list[str]
    buckets: int
    sort: list[str]
    live: dict[str, str] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)
    touched: list[int] = field(default_factory=list)
    made: str = ""

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.log = VersionLog(spark, self.path)

    @classmethod
    def create(cls, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int = 64,
               sort: Sequence[str] = (), if_exists: str = "error") -> KeyedTable:
        """A new empty table; one that exists is an ``error``, is ``keep``-t as it is, or ``replace``-d by a new version.

        A load rewrites the buckets it touches; Spark shares a large one among tasks. Rows of a file are sorted by ``sort``, so that
        filters on these columns skip row groups.
        """
        if if_exists not in ("error", "keep", "replace"):
            raise ValueError(f"if_exists is error, keep or replace, not {if_exists}")
        missing = sorted({*keys, *sort} - set(schema.names))
        if missing or not keys:
            raise ValueError(f"no such columns: {missing}" if missing else "a table needs keys")
        table = cls(spark, path)
        found = table.log.latest()
        if found and if_exists == "keep":
            return table
        if found and if_exists == "error":
            raise FileExistsError(f"a table exists at {path}")
        nullable = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
        empty = _Manifest(nullable.json(), list(keys), buckets, list(sort), made=uuid.uuid4().hex)
        try:
            table.log.publish(found[0] + 1 if found else 0, asdict(empty))
        except VersionConflict:
            if if_exists == "error":
                raise FileExistsError(f"a table exists at {path}") from None
            return cls.create(spark, path, schema, keys, buckets, sort, if_exists)
        return table

    def exists(self) -> bool:
        return self.log.latest() is not None

    def _at(self, version: int | None = None) -> tuple[int, _Manifest]:
        found = self.log.latest() if version is None else (version, self.log.read(version))
        if found is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return found[0], _Manifest(**found[1])

    @property
    def version(self) -> int:
        return self._at()[0]

    def _scan(self, manifest: _Manifest, buckets: Sequence[int] | None = None) -> DataFrame:
        """Rows of the live folders, with their bucket."""
        wanted = manifest.live.items() if buckets is None else ((str(b), manifest.live.get(str(b))) for b in buckets)
        folders = [f"{self.path}/{folder}" for _, folder in wanted if folder]
        schema = T.StructType([*manifest.struct.fields, T.StructField(BUCKET, T.IntegerType())])
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*folders).select(*schema.names)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of the newest version, or of an older one that is still kept."""
        _, manifest = self._at(version)
        return self._scan(manifest).drop(BUCKET)

    def _bucket_of(self, manifest: _Manifest) -> Column:
        return F.pmod(F.xxhash64(*manifest.keys), F.lit(manifest.buckets)).cast("int")

    def _change(self, incoming: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], schema: T.StructType | None,
                source: str | None, batch: int) -> int:
        """Rewrite the buckets ``incoming`` touches by ``merge(stored, incoming)`` and publish."""
        written: tuple[str, _Manifest, list[int]] | None = None
        for _ in range(ATTEMPTS):
            version, manifest = self._at()
            if source is not None and manifest.batches.get(source, -1) >= batch:
                return version
            touched = sorted(r[0] for r in incoming.select(BUCKET).distinct().collect())
            changed = evolve(manifest.struct, schema) if schema else manifest.struct
            if written is None or self._overlap(written[1], manifest, written[2]):
                load = f"data/{LOAD}={uuid.uuid4().hex}"
                if touched:
                    stored = conform(self._scan(manifest, touched), T.StructType([*changed.fields, T.StructField(BUCKET, T.IntegerType())]))
                    rows = merge(stored, incoming).hint("rebalance", BUCKET).sortWithinPartitions(
                        BUCKET, *manifest.sort, *manifest.keys)
                    rows.write.partitionBy(BUCKET).option("maxRecordsPerFile", 1_000_000).parquet(
                        f"{self.path}/{load}", compression="zstd")
                written = load, manifest, touched
            load = written[0]
            full = {int(c.removeprefix(f"{BUCKET}=")) for c in self.log.children(f"{self.path}/{load}") if c.startswith(f"{BUCKET}=")}
            live = {b: folder for b, folder in manifest.live.items() if int(b) not in touched}
            live |= {str(b): f"{load}/{BUCKET}={b}" for b in touched if b in full}  # a bucket may have become empty
            batches = manifest.batches | ({source: batch} if source is not None else {})
            try:
                self.log.publish(version + 1, asdict(_Manifest(
                    changed.json(), manifest.keys, manifest.buckets, manifest.sort, live, batches, touched, manifest.made)))
                return version + 1
            except VersionConflict:
                continue
        raise VersionConflict(f"{ATTEMPTS} other loads of {self.path} came first")

    def _overlap(self, before: _Manifest, now: _Manifest, touched: list[int]) -> bool:
        """Whether what was written on ``before`` is stale now."""
        return before.made != now.made or before.schema != now.schema or any(
            before.live.get(str(b)) != now.live.get(str(b)) for b in touched)

    def load(self, rows: DataFrame, version: Sequence[str], source: str | None = None, batch: int = 0, single: bool = False) -> int:
        """Upsert: the incoming row of highest ``version`` replaces the stored row of its key. Returns the published version.

        New columns and fields are added to the table (see ``schemas.evolve``). With a ``source``, a ``batch`` not beyond the last
        applied one of that source is skipped. ``single`` says that ``rows`` are a stored table with one row per key, which need not
        be reduced and stored again.
        """
        _, manifest = self._at()
        keys = manifest.keys
        if missing := sorted(set(keys) - set(rows.columns)):
            raise ValueError(f"rows without the keys {missing}")
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
        changed = evolve(manifest.struct, schema)
        rehashed = [(k, manifest.struct[k].dataType.simpleString(), schema[k].dataType.simpleString())
                    for k in keys if changed[k].dataType != manifest.struct[k].dataType]
        if rehashed:
            raise SchemaConflict(rehashed)  # a wider key would lie in another bucket
        current = conform(rows if single else latest_by_key(rows, keys, version), changed)
        incoming = current.withColumn(BUCKET, self._bucket_of(manifest))
        incoming = incoming if single else stage(incoming, "incoming")

        def merge(stored: DataFrame, new: DataFrame) -> DataFrame:
            return _without(stored, new, keys).unionByName(conform(new, stored.schema))
        return self._change(incoming, merge, schema, source, batch)

    def delete(self, rows: DataFrame, source: str | None = None, batch: int = 0) -> int:
        """Remove the keys of ``rows``; keys the table does not have are ignored."""
        _, manifest = self._at()
        kinds = {f.name: f.dataType for f in manifest.struct.fields}
        gone = rows.select(*(F.col(k).cast(kinds[k]).alias(k) for k in manifest.keys)).distinct()
        incoming = stage(gone.withColumn(BUCKET, self._bucket_of(manifest)), "deleted")
        return self._change(incoming, lambda stored, new: _without(stored, new, manifest.keys), None, source, batch)

    def matching(self, rows: DataFrame, version: int | None = None) -> DataFrame:
        """Stored rows whose key is among those of ``rows``; only the buckets of these keys are read."""
        _, manifest = self._at(version)
        kinds = {f.name: f.dataType for f in manifest.struct.fields}
        wanted = rows.select(*(F.col(k).cast(kinds[k]).alias(k) for k in manifest.keys)).distinct().withColumn(BUCKET, self._bucket_of(manifest))
        touched = sorted(r[0] for r in wanted.select(BUCKET).distinct().collect())
        return _by_key(self._scan(manifest, touched), wanted, manifest.keys, "left_semi").drop(BUCKET)

    def restore(self, version: int) -> int:
        """Publish an older version again as the newest."""
        now, _ = self._at()
        self.log.publish(now + 1, self.log.read(version))
        return now + 1

    def changed_buckets(self, version: int) -> list[int]:
        return self._at(version)[1].touched

    def vacuum(self, keep: int = 2) -> int:
        """Remove all but the newest ``keep`` versions and the folders that none of these names; returns how many folders went.

        Run it while no load is under way: folders of an unpublished load are removed too.
        """
        versions = self.log.versions()
        old, kept = versions[:-keep], versions[-keep:]
        named = {folder for v in kept for folder in self._at(v)[1].live.values()}
        for v in old:
            self.log.forget(v)
        removed = 0
        for load in self.log.children(f"{self.path}/data"):
            buckets = [b for b in self.log.children(f"{self.path}/data/{load}") if b.startswith(BUCKET)]
            dead = [b for b in buckets if f"data/{load}/{b}" not in named]
            for b in dead:
                self.log.remove(f"{self.path}/data/{load}/{b}")
            if len(dead) == len(buckets):
                self.log.remove(f"{self.path}/data/{load}")
            removed += len(dead)
        return removed


def _without(stored: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows whose key is not among ``gone``."""
    return _by_key(stored, gone, keys, "left_anti")


def _by_key(stored: DataFrame, others: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """A semi or anti join on bucket and key, where nulls are equal."""
    other = others.select(*(F.col(c).alias(f"_other_{i}") for i, c in enumerate([BUCKET, *keys])))
    same = F.lit(True)
    for i, c in enumerate([BUCKET, *keys]):
        same = same & F.col(c).eqNullSafe(F.col(f"_other_{i}"))
    return stored.join(other, same, how)
