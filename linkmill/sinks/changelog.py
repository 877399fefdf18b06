"""A loaded table as a change log that stays cheap to read.

Batches are merged level by level: as soon as a level has `fanout` folders, they are folded
into one folder of the next level, one row per key. A row is therefore rewritten once per
level, and reading opens a few folders, however many batches there were.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkmill.plans.manifest import Manifest
from linkmill.sinks.upsert import fold_changes


class ChangeLog:
    """Changes of a table in `path`, in the order of their batches.

    `schema` has the columns of the rows, `seq` among them, which orders the rows of a batch.
    A version lists the folders from the oldest to the newest; each covers a range of batches.
    The last batch can be repeated and replaces itself, so it is never merged.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, update_cols: Sequence[str],
                 seq: str = "seq", fanout: int = 8):
        self.spark, self.manifest = spark, Manifest(spark, path)
        self.schema, self.key, self.update_cols, self.seq, self.fanout = schema, key, list(update_cols), seq, fanout

    def folders(self, version: int | None = None) -> list[dict]:
        """The folders of a version: name, first and last batch, level."""
        _, state = self.manifest.state(version)
        return state["folders"] if state else []

    def append(self, batch: DataFrame, batch_id: int) -> None:
        """Write a batch. The cost is that of the batch, whatever the size of the table behind it."""
        version, state = self.manifest.state()
        folders = state["folders"] if state else []
        if folders and folders[-1]["last"] == batch_id and folders[-1]["level"] == 0:
            folders = folders[:-1]
        if folders and folders[-1]["last"] >= batch_id:
            raise ValueError(f"batch {batch_id} is not the last one")
        name = self.manifest.new_folder("batch")
        batch.select(*self.schema.names).write.parquet(f"{self.manifest.path}/{name}")
        self.manifest.commit({"folders": [*folders, {"name": name, "first": batch_id, "last": batch_id, "level": 0}]}, version)

    def _read(self, folders: Sequence[dict]) -> DataFrame:
        rows = self.spark.createDataFrame([], self.schema).withColumn("_folder", F.lit(0))
        for i, folder in enumerate(folders):
            one = self.spark.read.schema(self.schema).parquet(f"{self.manifest.path}/{folder['name']}")
            rows = rows.union(one.withColumn("_folder", F.lit(i)))
        return rows

    def _fold(self, folders: Sequence[dict]) -> DataFrame:
        """One row per key: a fold of folds is the fold of all, as the order of the folders is that of their rows."""
        return fold_changes(self._read(folders), self.key, self.update_cols, ["_folder", self.seq])

    def current(self, version: int | None = None) -> DataFrame:
        """The table after all batches."""
        return self._fold(self.folders(version))

    def _merge(self, folders: list[dict], first: int, end: int, level: int) -> list[dict]:
        name = self.manifest.new_folder(f"level{level}")
        # A key stands once in a merged folder, so its rows need no order any more.
        rows = self._fold(folders[first:end]).withColumn(self.seq, F.lit(None).cast(self.schema[self.seq].dataType))
        rows.select(*self.schema.names).write.parquet(f"{self.manifest.path}/{name}")
        whole = {"name": name, "first": folders[first]["first"], "last": folders[end - 1]["last"], "level": level}
        return [*folders[:first], whole, *folders[end:]]

    def compact(self, whole: bool = False) -> None:
        """Merge full levels, or with `whole` everything but the last batch into one folder.

        Every merge is a version of its own; a crash loses the merge at hand and nothing else.
        """
        version, state = self.manifest.state()
        folders = state["folders"] if state else []
        while True:
            done = folders[:-1]
            if whole:
                run = (0, len(done)) if len(done) > 1 else None
                level = max((f["level"] for f in done), default=0) + 1
            else:
                run = self._full_level(done)
                level = done[run[0]]["level"] + 1 if run else 0
            if run is None:
                return
            folders = self._merge(folders, *run, level)
            version = self.manifest.commit({"folders": folders}, version)

    def _full_level(self, folders: list[dict]) -> tuple[int, int] | None:
        """The oldest run of `fanout` neighbouring folders of one level; low levels first."""
        for level in sorted({f["level"] for f in folders}):
            places = [i for i, f in enumerate(folders) if f["level"] == level]
            if len(places) >= self.fanout:
                return places[0], places[0] + self.fanout
        return None

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete what only older versions used."""
        return self.manifest.vacuum(lambda s: [f["name"] for f in s["folders"]], keep)
