"""Seeds that are consumed in order, with a cursor instead of a rewritten table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkmill.plans.manifest import Manifest


class SeedQueue:
    """A list of seeds in `path`, ordered by `seq`, which is unique and not null.

    A push is written in pieces of neighbouring `seq`, and the range and size of each piece are
    noted. So a batch reads the pieces it can come from, whose files the statistics choose,
    and taking it moves the cursor: the seeds that stay are neither read nor written.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, seq: str = "seq"):
        self.spark, self.manifest, self.schema, self.seq = spark, Manifest(spark, path), schema, seq

    def _state(self) -> tuple[int, dict]:
        version, state = self.manifest.state()
        return version, state or {"pieces": [], "cursor": None}

    def push(self, seeds: DataFrame, pieces: int = 200) -> None:
        """Add seeds behind the cursor; those that come before it would never be taken and are refused."""
        version, state = self._state()
        name = self.manifest.new_folder("seeds")
        path = f"{self.manifest.path}/{name}"
        (seeds.select(*self.schema.names).repartitionByRange(pieces, self.seq).sortWithinPartitions(self.seq)
         .write.parquet(path))
        written = self.spark.read.schema(self.schema).parquet(path)
        sizes = written.groupBy(F.input_file_name()).agg(F.min(self.seq).alias("low"), F.max(self.seq).alias("high"),
                                                         F.count("*").alias("rows"), F.count(self.seq).alias("known"))
        found = [r.asDict() for r in sizes.collect()]  # a row per piece
        cursor = state["cursor"]
        if any(r["known"] < r["rows"] or (cursor is not None and r["low"] <= cursor) for r in found):
            raise ValueError("a seed has no number, or one that was already passed")
        added = [{"folder": name, "low": r["low"], "high": r["high"], "rows": r["rows"]} for r in found]
        ordered = sorted([*state["pieces"], *added], key=lambda p: (p["low"], p["high"]))
        self.manifest.commit(state | {"pieces": ordered}, version)

    def _rows(self, state: dict, upto: int | None = None) -> DataFrame:
        """Waiting seeds, up to a number."""
        folders = sorted({p["folder"] for p in state["pieces"] if upto is None or p["low"] <= upto})
        paths = [f"{self.manifest.path}/{f}" for f in folders]
        rows = self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)
        if state["cursor"] is not None:
            rows = rows.where(F.col(self.seq) > state["cursor"])
        return rows if upto is None else rows.where(F.col(self.seq) <= upto)

    def waiting(self) -> DataFrame:
        return self._rows(self._state()[1])

    def peek(self, n: int) -> DataFrame:
        """The next `n` seeds in order; they stay."""
        _, state = self._state()
        pieces = state["pieces"]
        # Rows that the pieces hold up to each end at least; a piece that the cursor has cut may have none left.
        sure, upto = 0, None
        for piece in sorted(pieces, key=lambda p: p["high"]):
            if state["cursor"] is None or piece["low"] > state["cursor"]:
                sure += piece["rows"]
            if sure >= n:
                upto = piece["high"]
                break
        return self._rows(state, upto).orderBy(self.seq).limit(n)

    def take(self, n: int) -> DataFrame:
        """The next `n` seeds in order, which are then gone from the queue."""
        version, state = self._state()
        name = self.manifest.new_folder("taken")
        path = f"{self.manifest.path}/{name}"
        self.peek(n).write.parquet(path)
        batch = self.spark.read.schema(self.schema).parquet(path)
        last = batch.agg(F.max(self.seq)).first()[0]
        if last is not None:
            waiting = [p for p in state["pieces"] if p["high"] > last]
            self.manifest.commit({"pieces": waiting, "cursor": last, "taken": name}, version)
        return batch

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete pushes that were consumed, and batches older than the kept versions."""
        return self.manifest.vacuum(lambda s: [*(p["folder"] for p in s["pieces"]), *([s["taken"]] if "taken" in s else [])], keep)
