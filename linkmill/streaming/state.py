"""Exact first arrival in a stream, with the seen-set as state."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def stream_admit_state(requests: DataFrame, key: Sequence[str] = ("spider", "fp"), seq: str = "seq",
                       dont_filter: str | None = "dont_filter", forget_after: int | None = None) -> DataFrame:
    """Requests whose key the stream has not seen; of equal ones in a micro-batch the smallest `seq` passes.

    The state is one number per key, the time of its first arrival. `forget_after`
    milliseconds later the key is forgotten and may pass again, which bounds the state; else
    it grows with the keys (use the RocksDB state store). Such a query has times to wait for
    and does not end by itself, whatever its trigger. Requests with `dont_filter` always
    pass and leave no state behind. One without a key is not admitted.

    Rows of a key are reduced to the first one within each task before they are shuffled, so
    a key that holds a third of a micro-batch sends a few rows to its task.
    """
    *scope, last = key
    kind = requests.schema[seq].dataType
    order = [F.col(f"{seq}.{f}") for f in kind.names] if isinstance(kind, T.StructType) else [F.col(seq)]
    passes = F.lit(False) if dont_filter is None else F.coalesce(F.col(dont_filter), F.lit(False))
    own = F.when(passes, F.to_json(F.struct(seq))).otherwise(F.col(last).cast("string"))
    groups = [f"_scope{i}" for i in range(len(scope))]
    places = [f"_order{i}" for i in range(len(order))]
    keyed = requests.select(
        *(F.col(c).alias(g) for c, g in zip(scope, groups)), own.alias("_key"), passes.alias("_passes"),
        *(c.alias(p) for c, p in zip(order, places)), F.to_json(F.struct(*requests.columns)).alias("_row"))
    keyed = keyed.where(F.col("_key").isNotNull())
    grouping = [*groups, "_passes", "_key"]

    def first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pandas().sort_values(places, kind="stable").drop_duplicates(grouping)
            yield pa.RecordBatch.from_pandas(rows, schema=batch.schema, preserve_index=False)

    def admit(names: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(parts))
        passing = bool(names[-2])
        if passing:
            yield rows[["_row"]]
            return
        now = state.getCurrentProcessingTimeMs() if forget_after else 0
        since = state.get[0] if state.exists else now
        if not state.exists or (forget_after and now - since >= forget_after):  # a time may be over before it is told
            since = now
            state.update((now,))
            yield rows.sort_values(places, kind="stable")[["_row"]].head(1)
        if forget_after:
            state.setTimeoutDuration(max(1, since + forget_after - now))

    timeout = GroupStateTimeout.ProcessingTimeTimeout if forget_after else GroupStateTimeout.NoTimeout
    reduced = keyed.mapInArrow(first_of_each, keyed.schema)
    fresh = reduced.groupBy(*grouping).applyInPandasWithState(admit, "_row string", "since long", "append", timeout)
    return fresh.select(F.from_json("_row", requests.schema).alias("row")).select("row.*")
