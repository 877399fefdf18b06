"""Joins whose left side has frequent keys.

A join brings all rows of a key into one task. Here the frequent keys of the left side are
found by a sketch; their rows stay where they are and meet the few right rows by broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is frequent from this share of all rows on; so there are at most 1 / SHARE of them.
SHARE = 1 / 128
#: Keys that the sketch counts at a time; its error is far below a share of the rows.
TRACKED = 10_000


def heavy_keys(df: DataFrame, key: str, share: float = SHARE) -> list:
    """Keys that may hold at least `share` of the rows, by a sketch of bounded size.

    One small row comes to the driver. Counts of the sketch are approximate: a key close to
    the share may be in or out, which changes the way of its rows and never a result.
    """
    most = int(1 / share)
    found = df.where(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k(`{key}`, {most}, {max(TRACKED, 4 * most)})").alias("top"), F.count("*").alias("n")).first()
    return [r["item"] for r in found["top"] or [] if r["count"] >= share * found["n"]]


def join_one(left: DataFrame, right: DataFrame, key: str, share: float = SHARE) -> DataFrame:
    """Left join with a side that has one row per key, whatever the frequency of a key on the left.

    Null keys match nothing and are not moved either.
    """
    hot = heavy_keys(left, key, share)
    on_hot = F.col(key).isin(hot) if hot else F.lit(False)
    blanks = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields if f.name != key]
    parts = [left.where(F.col(key).isNotNull() & ~on_hot).join(right.where(~on_hot), key, "left"),
             left.where(F.col(key).isNull()).select(*left.columns, *blanks)]
    if hot:  # as many rows as there are frequent keys
        parts.append(left.where(on_hot).join(F.broadcast(right.where(on_hot)), key, "left"))
    columns = [*left.columns, *(c for c in right.columns if c != key)]
    joined = parts[0].select(*columns)
    for part in parts[1:]:
        joined = joined.unionByName(part.select(*columns))
    return joined
