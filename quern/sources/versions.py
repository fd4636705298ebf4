"""A log of published versions: the one file whose appearance makes a load visible.

Version ``n`` is the file ``_versions/<n>.json`` below a table's folder. It is written under another name and renamed without
overwriting, so that readers see it whole or not at all and of two writers of one version the second fails. This is as
strict as the file system's rename without overwriting (atomic on HDFS, checked and then done on a local disk).
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class VersionConflict(RuntimeError):
    """Another writer published this version first."""


class VersionLog:
    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._fs_names = self._jvm.org.apache.hadoop.fs
        self.folder = f"{path.rstrip('/')}/_versions"
        self._folder = self._fs_names.Path(self.folder)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._folder.getFileSystem(conf)
        self._context = self._fs_names.FileContext.getFileContext(self._fs.makeQualified(self._folder).toUri(), conf)

    def prepare(self) -> None:
        """Make the folder, so that a table without versions can be read as an empty one."""
        self._fs.mkdirs(self._folder)

    def _file(self, name: str):
        return self._fs.makeQualified(self._fs_names.Path(f"{self.folder}/{name}"))

    def versions(self) -> list[int]:
        """Published versions, ascending."""
        if not self._fs.exists(self._folder):
            return []
        names = [status.getPath().getName() for status in self._fs.listStatus(self._folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())

    def read(self, version: int) -> dict:
        stream = self._fs.open(self._file(f"{version:012}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> tuple[int, dict] | None:
        """The newest version and its entry."""
        found = self.versions()
        return (found[-1], self.read(found[-1])) if found else None

    def publish(self, version: int, entry: dict) -> None:
        """Make ``entry`` the given version, or raise ``VersionConflict``."""
        self.prepare()
        draft = self._file(f"draft-{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(json.dumps(entry).encode()))
        finally:
            stream.close()
        strict = self._gateway.new_array(getattr(self._fs_names, "Options$Rename"), 0)
        try:
            self._context.rename(draft, self._file(f"{version:012}.json"), strict)
        except Py4JJavaError as e:
            self._fs.delete(draft, False)
            if "FileAlreadyExistsException" in str(e.java_exception.getClass().getName()):
                raise VersionConflict(f"version {version} of {self.folder} exists") from e
            raise

    def forget(self, version: int) -> None:
        """Remove an old entry; what it named can then be removed too."""
        self._fs.delete(self._file(f"{version:012}.json"), False)

    def remove(self, folder: str) -> None:
        self._fs.delete(self._fs_names.Path(folder), True)

    def children(self, folder: str) -> list[str]:
        path = self._fs_names.Path(folder)
        return [status.getPath().getName() for status in self._fs.listStatus(path)] if self._fs.exists(path) else []
