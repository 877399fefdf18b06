"""Joins that carry context from one record to another."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkmill.operators.ordered import ordered_rank
from linkmill.operators.quality import check_ok
from linkmill.operators.skew import join_one

# Largest pool that is sent to every executor.
BROADCAST_ROWS = 100_000
# Members up to which one row is ranked against all of them.
LIVE_ROWS = 64


def carry_meta(details: DataFrame, listing: DataFrame, key: str = "fp", value: str = "front_image_url",
               seq: str = "seq") -> DataFrame:
    """Give a detail page the image of its first listing entry; an empty one counts as none.

    The listing is reduced to one row per key first (with map-side combine), so the join
    never multiplies rows, and the rows of a frequent detail key stay in their tasks.
    """
    one = listing.groupBy(key).agg(F.min_by(value, seq).alias(value))
    return join_one(details, one.filter(F.col(value) != ""), key)


def attach_image_path(items: DataFrame, results: DataFrame, key: str = "url", images: str = "front_image_url",
                      path: str = "front_image_path") -> DataFrame:
    """Set the path of the last successful image of each item that has images.

    Such an item without a result gets an empty path; items without images keep theirs.
    """
    last = results.filter("ok").groupBy(key).agg(F.max_by("path", "pos").alias("_path"))
    joined = items.join(last, key, "left")
    has_images = F.coalesce(F.size(F.col(images)) > 0, F.lit(False))
    new = F.when(has_images, F.coalesce("_path", F.lit(""))).otherwise(F.col(path))
    return joined.withColumn(path, new).select(*items.columns)


def prune_failed(endpoints: DataFrame, checks: DataFrame, key: str = "ip", status: str = "status") -> DataFrame:
    """Endpoints without a failed check."""
    failed = checks.filter(~check_ok(F.col(status))).select(key).distinct()
    return endpoints.join(failed, key, "left_anti")


def text_hash(c: Column) -> Column:
    """Non-negative integer of a text, the same in every run and engine."""
    return F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("bigint")


def assign_member(df: DataFrame, pool: DataFrame, key: str, order: Sequence[str], name: str, member: str,
                  seed: str = "", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Pick a pool member per row by a seeded hash of `key`; a value already there is kept.

    The pool is counted first. A small one goes to the rows; for a larger one the
    rows are matched by number, which the hash spreads over the whole pool.
    """
    size = pool.count()
    if size == 0:
        return df if name in df.columns else df.withColumn(name, F.lit(None).cast(pool.schema[member].dataType))
    ranked = ordered_rank(pool.select(*dict.fromkeys([*order, member])).withColumn("_all", F.lit(0)), ["_all"],
                          [F.col(c) for c in order], "_number")
    numbered = ranked.select((F.col("_number") - 1).alias("_pick"), F.col(member).alias("_member"))
    if size <= broadcast_rows:
        numbered = F.broadcast(numbered)
    text = F.concat(F.col(key).cast("string"), F.lit(f"|{seed}"))
    picked = df.withColumn("_pick", F.pmod(text_hash(text), F.lit(size))).join(numbered, "_pick", "left")
    value = F.coalesce(F.col(name), F.col("_member")) if name in df.columns else F.col("_member")
    return picked.withColumn(name, value).drop("_pick", "_member").select(
        *df.columns, *([] if name in df.columns else [name]))


def _score(key: Column, seed: str, member: Column) -> Column:
    """How much a row wants a member: the same in every run and engine."""
    return F.md5(F.concat(key, F.lit(f"|{seed}|"), member))


def assign_live(df: DataFrame, pool: DataFrame, key: str, name: str, member: str, alive: str | None = None,
                seed: str = "", few: int = LIVE_ROWS) -> DataFrame:
    """Pick the live member that a row wants most (rendezvous hashing); a value already there is kept.

    Every row ranks all members by a hash of both. If a member dies, only its own rows move,
    each to its next choice, and they come back with it; the others keep their member. With
    `alive`, a boolean column of the pool, members where it is not true are passed over.

    A pool of more than `few` members is ranked in two steps: groups by a hash of the member, as
    many as a group has members, then the members of the chosen group. The groups do not
    depend on who is alive, so again only rows of a dead member move, or of a group of which
    nobody is left. A row without a key has none to rank by and gets no member, as does every
    row of an empty pool.
    """
    everyone = pool.select(F.col(member).cast("string").alias("_member"), F.col(alive) if alive else F.lit(True).alias("_alive"))
    everyone = everyone.toDF("_member", "_alive").where("_member is not null")
    names = everyone.where("_alive").select("_member").distinct()
    size = everyone.select("_member").distinct().count()
    text = F.col(key).cast("string")

    def best(choices: Column, prefix: str = "") -> Column:
        ranked = F.transform(choices, lambda c: F.struct(
            _score(text, seed, F.concat(F.lit(prefix), c.cast("string"))).alias("score"), c.alias("choice")))
        return F.when(text.isNotNull(), F.array_max(ranked)["choice"])

    if size <= few:
        listed = sorted(r[0] for r in names.collect())
        out = df.withColumn("_member", best(F.array(*map(F.lit, listed)).cast("array<string>")))
    else:
        n_groups = math.ceil(math.sqrt(size))
        group = F.pmod(text_hash(F.col("_member")), F.lit(n_groups))
        members = names.groupBy(group.alias("_group")).agg(F.sort_array(F.collect_list("_member")).alias("_members"))
        groups = sorted(r[0] for r in members.select("_group").collect())
        chosen = df.withColumn("_group", best(F.array(*map(F.lit, groups)).cast("array<bigint>"), "group "))
        # A row per group on the right; the rows are hashed evenly over the groups.
        out = chosen.join(members, "_group", "left").withColumn("_member", best(F.col("_members")))
    value = F.col("_member").cast(pool.schema[member].dataType)
    if name in df.columns:
        value = F.coalesce(F.col(name), value)
    return out.withColumn(name, value).select(*df.columns, *([] if name in df.columns else [name]))
