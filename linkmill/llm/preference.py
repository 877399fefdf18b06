"""Preference examples: the turns two conversations share, rendered once, and their two masked endings.

Everything here is a DataFrame expression over arrays of turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of the rendered form. They are broken up where a text holds them.
OPEN, CLOSE, MARK, BROKEN = "<|im_start|>", "<|im_end|>", "<|im_", "< |im_"
TRAINED_ROLE = "assistant"
TURNS = "array<struct<role:string,text:string>>"


def turns_in_order(turn: str = "turn", role: str = "role", text: str = "text", where: Column | None = None) -> Column:
    """Aggregate a conversation's rows into its turns; equal turn numbers go by role and text, nulls first."""
    row = F.struct(F.col(turn).alias("turn"), F.col(role).cast("string").alias("role"),
                   F.col(text).cast("string").alias("text"))
    rows = F.array_sort(F.collect_list(row if where is None else F.when(where, row)), _by_turn)
    return F.transform(rows, lambda t: F.struct(t.role.alias("role"), t.text.alias("text")))


def _by_turn(a: Column, b: Column) -> Column:
    result = F.lit(0)
    for name in ("text", "role", "turn"):
        x, y = a[name], b[name]
        result = (F.when(x.eqNullSafe(y), result).when(x.isNull(), -1).when(y.isNull(), 1)
                  .when(x < y, -1).otherwise(1))
    return result


def _plain(text: Column) -> Column:
    return F.replace(F.coalesce(text, F.lit("")), F.lit(MARK), F.lit(BROKEN))


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), _plain(turn.role), F.lit("\n"))


def _tail(turn: Column) -> Column:
    return F.concat(_plain(turn.text), F.lit(CLOSE), F.lit("\n"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _tail(t))), "")


def trained_spans(turns: Column) -> Column:
    """Character ranges [start, end) of the rendered turns that carry loss: what the assistant says, with its end mark."""
    spans = "array<struct<start:int,end:int>>"

    def add(state: Column, turn: Column) -> Column:
        start = state.at + F.char_length(_head(turn))
        end = start + F.char_length(_tail(turn)) - 1
        mine = F.array(F.struct(start.alias("start"), end.alias("end"))).cast(spans)
        trained = F.coalesce(turn.role == TRAINED_ROLE, F.lit(False))
        return F.struct((end + 1).alias("at"),
                        F.when(trained, F.concat(state.spans, mine)).otherwise(state.spans).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(spans).alias("spans"))
    return F.aggregate(turns, start, add, lambda s: s.spans)


def common_turns(chosen: Column, rejected: Column) -> Column:
    """Number of leading turns that are equal in role and text (a null equals a null)."""
    same = F.zip_with(chosen, rejected, lambda x, y: x.isNotNull() & y.isNotNull() & x.eqNullSafe(y))
    first = F.array_position(same, False)
    return F.when(first > 0, first - 1).otherwise(F.size(same)).cast("int")


def format_preferences(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """Replace two columns of turns by prompt, chosen, rejected, their spans, and n_common.

    A null conversation counts as one without turns. Equal conversations have empty endings
    and no spans. Other columns stay. No shuffle.
    """
    empty = F.array().cast(TURNS)
    a, b = (F.coalesce(F.col(c).cast(TURNS), empty) for c in (chosen, rejected))
    others = [c for c in pairs.columns if c not in (chosen, rejected)]
    rows = pairs.select(*others, F.struct(a.alias("a"), b.alias("b"), common_turns(a, b).alias("n")).alias("_p"))
    n = F.col("_p.n")
    rest = {side: F.slice(F.col(f"_p.{side}"), n + 1, F.greatest(F.size(f"_p.{side}") - n, F.lit(0))) for side in "ab"}
    return rows.select(
        *others, render(F.slice("_p.a", F.lit(1), n)).alias("prompt"), render(rest["a"]).alias(chosen),
        render(rest["b"]).alias(rejected), trained_spans(rest["a"]).alias(f"{chosen}_spans"),
        trained_spans(rest["b"]).alias(f"{rejected}_spans"), n.alias("n_common"))


def pair_conversations(conversations: DataFrame) -> DataFrame:
    """Preference pairs from a table that has none: pair_id, chosen, rejected.

    Conversation 2k is chosen. The rejected one goes along with it for the first half of its
    turns and then ends as conversation 2k + 1 does from that turn on. Rows without a
    conv_id belong to no conversation and are left out; a missing partner has no turns.
    One shuffle, on the pair.
    """
    ids = F.col("conv_id").cast("long")
    even = F.pmod(ids, F.lit(2)) == 0
    pairs = conversations.where(ids.isNotNull()).groupBy(((ids - F.pmod(ids, F.lit(2))) / 2).cast("long").alias("pair_id"))
    pairs = pairs.agg(turns_in_order(where=even).alias("a"), turns_in_order(where=~even).alias("b"))
    half = F.floor(F.size("a") / 2).cast("int")
    after = F.slice("b", half + 1, F.greatest(F.size("b") - half, F.lit(0)))
    return pairs.select("pair_id", F.col("a").alias("chosen"), F.concat(F.slice("a", F.lit(1), half), after).alias("rejected"))


def spans_text(spans: str) -> Column:
    """Spans as `start-end` parted by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s.start, s.end)), ",")
