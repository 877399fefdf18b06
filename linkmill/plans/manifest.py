"""Versions of a stored table.

A table that is rewritten in part consists of folders. A small file per version names
them; it is put in place last and in one step, so a reader sees the table before a change
or after it, and a job that dies half-way leaves the old version as it was.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

_FOLDER = "_versions"


class Manifest:
    """The versions of the table in `path`, on any file system that Spark can write."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(conf)
        root = self._fs.makeQualified(self._path(self.path))
        self._files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(root.toUri(), conf)
        self._rename = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        self._read = jvm.org.apache.commons.io.IOUtils.toString

    def _file(self, name: str):
        return self._fs.makeQualified(self._path(f"{self.path}/{_FOLDER}/{name}"))

    def versions(self) -> list[int]:
        folder = self._file("")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def state(self, version: int | None = None) -> tuple[int, dict | None]:
        """(version, what it holds); version 0 is the table before its first change."""
        if version is None:
            version = max(self.versions(), default=0)
        if version == 0:
            return 0, None
        stream = self._fs.open(self._file(f"{version:010d}.json"))
        try:
            return version, json.loads(self._read(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, state: dict, after: int) -> int:
        """Make `state` the version that follows `after`; fails if another writer was faster."""
        draft = self._file(f"draft-{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        stream.write(bytearray(json.dumps(state).encode()))
        stream.close()
        self._files.rename(draft, self._file(f"{after + 1:010d}.json"), self._rename)
        return after + 1

    def new_folder(self, name: str) -> str:
        return f"{name}-{uuid.uuid4().hex[:12]}"

    def vacuum(self, used, keep: int = 2) -> list[str]:
        """Delete folders that none of the last `keep` versions uses, and older versions.

        `used(state)` gives the folders of a version. Only for times without writers: a
        folder that is being written belongs to no version yet.
        """
        versions = self.versions()
        kept = versions[-keep:]
        alive = {f for v in kept for f in used(self.state(v)[1])}
        gone = []
        for status in self._fs.listStatus(self._path(self.path)):
            name = status.getPath().getName()
            if status.isDirectory() and name != _FOLDER and name not in alive:
                self._fs.delete(status.getPath(), True)
                gone.append(name)
        for version in versions[:-keep]:
            self._fs.delete(self._file(f"{version:010d}.json"), False)
        return sorted(gone)
