"""Mixing sources to target weights by cube-method balanced sampling.

Every document of a source is to be taken equally often: a whole number of times and, with
the probability that is left, once more. The cube method moves these probabilities to 0
or 1 along directions that change neither the words nor the documents taken in all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkmill.llm.common import Staged, column_or_null

WEIGHTS = (5, 2, 1)
MOST = 3
WORD = "[^\\x20\\x09-\\x0D]+"
# Units of a source that one task of the flight handles; each leaves at most two undecided.
BLOCK = 8_192
LANDING = 10
_EPS = 1e-9


def source_targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, n, target of each source of (source, size) rows.

    Sources in code-point order, null last, get the weights in turn and share the sum of all
    sizes by them, but none more than `most` times its size; what is over is shared anew by
    weight. Sources are ranked by range, so no task orders all of them, and each round of
    sharing brings two sums to the driver.
    """
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    order = F.col("source").asc_nulls_last()
    dealt = sums.repartitionByRange(order).sortWithinPartitions(order).select(
        "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        .alias("at"))
    dealt = Staged(dealt, "sources").df
    before = dealt.groupBy("part").count().select("part", F.sum("count").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    ranked = dealt.join(before, "part").select("source", "source_size", "n", F.get(
        F.array(*map(F.lit, weights)), F.pmod(F.col("at") + F.coalesce("before", F.lit(0)), F.lit(len(weights)))
        .cast("int")).alias("weight"))
    ranked = Staged(ranked, "sources").df
    share, limit = None, F.lit(most) * F.col("source_size")
    while True:
        full = F.lit(False) if share is None else F.col("weight") * F.lit(share) > limit
        s = ranked.agg(F.sum("source_size").alias("total"), F.sum(F.when(full, limit)).alias("full"),
                       F.sum(F.when(~full, F.col("weight"))).alias("weight"),
                       F.count(F.when(full, 1)).alias("n")).first()
        if not s.weight:
            break
        new = ((s.total or 0) - (s.full or 0)) / s.weight
        if share is not None and (s.n == n_full or new <= share):
            break
        share, n_full = new, s.n
    target = F.least(F.col("weight") * F.lit(float(share or 0)), limit.cast("double"))
    return ranked.select("source", "source_size", "n", target.alias("target"))


def _move(p: list[float], c: list[float], s: list[float], draw: float) -> None:
    """One step of the flight of three units: c and s stay balanced, and one of them reaches 0 or 1."""
    u = [c[1] * s[2] - c[2] * s[1], c[2] * s[0] - c[0] * s[2], c[0] * s[1] - c[1] * s[0]]
    if not any(u):
        u = [c[1], -c[0], 0.0]
    up = down = float("inf")
    for x, d in zip(p, u):
        if d > 0:
            up, down = min(up, (1 - x) / d), min(down, x / d)
        elif d < 0:
            up, down = min(up, x / -d), min(down, (1 - x) / -d)
    step = up if draw * (up + down) < down else -down
    for i in range(3):
        p[i] = p[i] + step * u[i]
        p[i] = 0.0 if p[i] < _EPS else 1.0 if p[i] > 1 - _EPS else p[i]


def flight(p: np.ndarray, rows: np.ndarray, sizes: np.ndarray, seed: list[int]) -> np.ndarray:
    """Move all but at most two probabilities to 0 or 1; rows and rows * sizes taken stay what they are on average."""
    out, draws = p.astype(float).copy(), np.random.default_rng(seed).random(2 * len(p) + 8).tolist()
    todo = [int(i) for i in np.flatnonzero((out > 0) & (out < 1))][::-1]
    c, s = rows.astype(float).tolist(), (rows * sizes).astype(float).tolist()
    at: list[int] = []
    while True:
        while len(at) < 3 and todo:
            at.append(todo.pop())
        if len(at) < 3:
            return out
        now = [float(out[i]) for i in at]
        _move(now, [c[i] for i in at], [s[i] for i in at], draws.pop() if draws else 0.5)
        for i, x in zip(at, now):
            out[i] = x
        at = [i for i, x in zip(at, now) if 0 < x < 1]


def landing(p: np.ndarray, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Decide the few undecided units, at need with `LANDING` decided ones anew.

    Of all choices the one is taken that changes the words taken least, then the documents, then
    the fewest decided units.
    """
    out, open_ = p.copy(), np.flatnonzero((p > 0) & (p < 1))
    if not len(open_):
        return out
    units = np.append(open_, np.setdiff1d(np.arange(len(p)), open_)[-LANDING:])
    choices = (np.arange(1 << len(units))[:, None] >> np.arange(len(units)) & 1).astype(float)
    change = choices - p[units]
    words, docs = np.abs(change @ (rows * sizes)[units]), np.abs(change @ rows[units])
    anew = np.abs(change[:, len(open_):]).sum(1)
    out[units] = choices[np.lexsort((anew, docs.round(6), words.round(6)))[0]]
    return out


def _fly(last: bool):
    def fly(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("order", "ascending"), ("doc_id", "ascending"), ("hash", "ascending")])
        p, rows, sizes = (table[c].to_numpy() for c in ("p", "rows", "size"))
        p = flight(p, rows, sizes, [len(p), int(table["order"][0].as_py()) & (1 << 63) - 1])
        if last:
            p = landing(p, rows, sizes)
        return table.set_column(table.schema.get_field_index("p"), "p", pa.array(p, pa.float64()))

    return fly


KEY = ["doc_id", "source", "size", "hash"]


def sized(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, source, size in words and a hash that tells rows of one id apart, and more columns."""
    text = F.col("text").cast("string")
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), column_or_null(docs, "source", "string").alias("source"),
                       size.alias("size"), F.xxhash64(text).alias("hash"), *more)


def mix_sources(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """How often each document is taken: KEY, source_size, target, copies (one row per distinct KEY).

    Takes what `sized` gives. Equal rows are one unit and are taken alike. A source is dealt to
    blocks by a hash of the id, so that a source with most rows is many tasks; what blocks leave
    undecided meets in fewer blocks, until one of each source is left, whose last two units are
    landed. Draws depend on the data only, so reruns agree. A source without words takes none of its
    words; a null size counts as 0.
    """
    targets = Staged(source_targets(rows, weights, most), "targets").df
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    ratio = F.when(F.abs(ratio - F.round(ratio)) < _EPS, F.round(ratio)).otherwise(ratio)
    known = targets.select("source", "source_size", "target", "n", ratio.alias("ratio")).withColumnRenamed("source", "s")
    units = rows.groupBy(*KEY).agg(F.count("*").alias("rows"))
    units = units.join(known, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    whole = F.floor("ratio")
    units = units.select(*KEY, "rows", "source_size", "target", "n", whole.cast("long").alias("whole"),
                         (F.col("ratio") - whole).alias("p"), F.xxhash64("doc_id", "hash", "size").alias("order"))
    units = Staged(units, "units").df
    largest = targets.agg(F.max("n")).first()[0] or 0
    blocks, done, n = F.greatest(F.lit(1), F.ceil(F.col("n") / BLOCK)), [units.where("p = 0")], -(-largest // BLOCK)
    open_ = units.where("p > 0")
    while True:
        last = n <= 1
        block = F.pmod(F.col("order"), blocks.cast("long"))
        flown = Staged(open_.groupBy("source", block.alias("block")).applyInArrow(_fly(last), units.schema), "flown").df
        done.append(flown.where("p = 0 OR p = 1"))  # in the last round that is all
        if last:
            break
        open_ = flown.where("p > 0 AND p < 1")
        blocks, n = F.greatest(F.lit(1), F.ceil(blocks * 2 / BLOCK)), -(-2 * n // BLOCK)
    decided = done[0]
    for d in done[1:]:
        decided = decided.unionByName(d)
    return decided.select(*KEY, "source_size", "target", (F.col("whole") + F.col("p").cast("long")).alias("copies"))


def _with_copies(rows: DataFrame, decided: DataFrame) -> DataFrame:
    other = decided.select(*(F.col(c).alias(f"_{c}") for c in KEY), "source_size", "target", "copies")
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in KEY]
    return rows.join(other, on).drop(*(f"_{c}" for c in KEY))


def mixture_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row of `docs`."""
    rows = Staged(sized(docs), "sized").df
    return _with_copies(rows, mix_sources(rows)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it; columns stay as they are."""
    rows = Staged(sized(docs), "sized").df
    decided = Staged(mix_sources(rows, weights, most).where("copies > 0"), "decided").df
    names = [f"c{i}" for i in range(len(docs.columns))]
    keyed = sized(docs, F.struct(*(F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names))).alias("row"))
    taken = _with_copies(keyed, decided).withColumn("again", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return taken.select(*(F.col(f"row.{n}").alias(c) for c, n in zip(docs.columns, names)))
