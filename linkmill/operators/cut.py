"""The next requests of each spider by cut values, without ranking the frontier.

The place of the n-th request is narrowed by histograms: each pass counts the rows of the
range that is left in bins and goes on with the bin that holds the n-th. What is shuffled is
a row per spider, bin and task; the same plan serves a batch of ten and one of millions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from linkmill.plans.staging import stage

#: Bins of a pass. A range of 64-bit numbers takes seven passes, one of a billion three.
BINS = 1024
#: Most spiders whose cut values are sent to every executor.
BROADCAST_ROWS = 1_000_000
_END = 1 << 61


def _keys(order: str, seq: str, priority: str) -> list[Column]:
    """The order as ascending integers; a null priority comes last, a null `seq` first (newest first: last)."""
    number = F.col(seq).cast("bigint")
    oldest = F.coalesce(number, F.lit(-_END))
    return {
        "fifo": [oldest],
        "lifo": [-oldest],
        "priority": [F.coalesce(-F.col(priority).cast("bigint"), F.lit(_END)), oldest],
    }[order]


def _narrowed(rows: DataFrame, need: DataFrame, key: str) -> DataFrame:
    """`_spider, _cut, _need`: the value of `key` where the batch ends, and how many rows of that value it takes.

    `need` has the spiders whose batch ends among `rows`, and the number of rows to take.
    """
    ends = rows.groupBy("_spider").agg(F.min(key).alias("_low"), F.max(key).alias("_high"))
    state = stage(ends.join(need, ends["_spider"].eqNullSafe(need["_of"])).select("_spider", "_low", "_high", "_need"), "cut")
    while not state.where("_low < _high").isEmpty():
        width = F.ceil((F.col("_high") - F.col("_low") + 1) / F.lit(BINS)).cast("bigint")
        ranges = state.select(F.col("_spider").alias("_of"), "_low", "_high", "_need", F.greatest(width, F.lit(1)).alias("_width"))
        inside = rows.join(F.broadcast(ranges), F.col("_spider").eqNullSafe(F.col("_of"))
                           & F.col(key).between(F.col("_low"), F.col("_high")))
        bins = inside.groupBy("_spider", F.expr(f"({key} - _low) div _width").alias("_bin"), "_low", "_high", "_width",
                              "_need").count()
        upto = F.sum("count").over(W.partitionBy("_spider").orderBy("_bin"))
        found = bins.withColumn("_upto", upto).where("_upto >= _need and _upto - count < _need")
        low = F.col("_low") + F.col("_bin") * F.col("_width")
        state = stage(found.select("_spider", low.alias("_low"), F.least(low + F.col("_width") - 1, F.col("_high")).alias("_high"),
                                   (F.col("_need") - F.col("_upto") + F.col("count")).alias("_need")), "cut")
    return state.select("_spider", F.col("_low").alias("_cut"), "_need")


def batch_cut(frontier: DataFrame, n: int, order: str = "priority", spider: str = "spider", seq: str = "seq",
              priority: str = "priority") -> tuple[DataFrame, DataFrame]:
    """`(batch, rest)`: the next `n` requests of each spider and what stays, as `select_batch` gives them.

    `seq` is a unique integer, within 2**61 either way. Spiders are counted as they are, null
    included; cut values go to the rows, one per spider.
    """
    keys = _keys(order, seq, priority)
    names = [f"_key{i}" for i in range(len(keys))]
    rows = stage(frontier.select(F.col(spider).alias("_spider"), *(k.alias(x) for k, x in zip(keys, names))), "keys")
    cuts = rows.groupBy("_spider").count().where(F.col("count") > n).select("_spider")
    need = cuts.select(F.col("_spider").alias("_of"), F.lit(n).cast("bigint").alias("_need"))
    left = rows
    values = []
    for i, key in enumerate(names):
        cut = _narrowed(left, need, key)
        values.append(cut.select(F.col("_spider").alias("_of"), F.col("_cut").alias(f"_cut{i}")))
        at = cut.select(F.col("_spider").alias("_of"), F.col("_cut"), "_need")
        if i + 1 < len(names):
            left = left.join(F.broadcast(at.select("_of", "_cut")), F.col("_spider").eqNullSafe(F.col("_of"))
                             & (F.col(key) == F.col("_cut"))).select(*rows.columns)
            need = at.select("_of", "_need")
    table = values[0]
    for more in values[1:]:
        table = table.alias("a").join(more.alias("b"), F.col("a._of").eqNullSafe(F.col("b._of"))).select(
            "a.*", *(F.col(f"b.{c}") for c in more.columns if c != "_of"))
    table = stage(table, "cuts")
    if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        table = F.broadcast(table)
    marked = frontier.join(table, F.col(spider).eqNullSafe(F.col("_of")), "left")
    inside = F.lit(False)
    for i in reversed(range(len(keys))):
        cut = F.col(f"_cut{i}")
        last = keys[i] <= cut if i == len(keys) - 1 else keys[i] < cut
        inside = last | ((keys[i] == cut) & inside) if i < len(keys) - 1 else last
    # A spider without a cut has no more than n requests.
    taken = F.col("_cut0").isNull() | inside
    return marked.where(taken).select(*frontier.columns), marked.where(~taken).select(*frontier.columns)
