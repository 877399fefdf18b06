"""Select values from pages: every page is parsed once for all fields."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkmill.functions.html import Selector, Tree, compile_selector


@dataclass(frozen=True)
class Each:
    """A repeated element; `fields` are selected inside every occurrence."""

    node: str
    fields: Mapping[str, str]


Fields = Mapping[str, "str | Each"]

_STRINGS = T.ArrayType(T.StringType())


def _type_of(spec: str | Each) -> T.DataType:
    if isinstance(spec, Each):
        return T.ArrayType(T.StructType([T.StructField(n, _STRINGS) for n in spec.fields]))
    return _STRINGS


def _may_match(html: Column, selectors: list[Selector]) -> Column | None:
    """True for every page that can match; None if that cannot be told from the text.

    A class or id must appear literally in the page, except where it is spelled
    with character references.
    """
    needed = [s.tokens() for s in selectors]
    if not needed or not all(needed):
        return None
    literal = [reduce(Column.__and__, [F.contains(html, F.lit(t)) for t in tokens]) for tokens in needed]
    escaped = html.rlike(r"(?i)(class|id)\s*=\s*[^>]*&")
    return reduce(Column.__or__, [*literal, escaped])


def node_values(html: Column, fields: Fields) -> Column:
    """Struct with the matches of every field, from one parse of the page."""
    plans = {}
    for name, spec in fields.items():
        if isinstance(spec, Each):
            plans[name] = (compile_selector(spec.node), {k: compile_selector(v) for k, v in spec.fields.items()})
        else:
            plans[name] = compile_selector(spec)
    out_type = T.StructType([T.StructField(n, _type_of(s)) for n, s in fields.items()])
    strings = pa.list_(pa.string())
    arrow_type = pa.struct([
        pa.field(n, pa.list_(pa.struct([pa.field(k, strings) for k in s.fields])) if isinstance(s, Each) else strings)
        for n, s in fields.items()])

    def page(source):
        if source is None:
            return None
        tree = Tree(source)
        row = {}
        for name, plan in plans.items():
            if isinstance(plan, Selector):
                row[name] = plan.values(tree)
            else:
                node, inner = plan
                row[name] = [{k: s.values(tree, n) for k, s in inner.items()}
                             for n in node.nodes(tree, tree.root)]
        return row

    @F.arrow_udf(out_type)
    def select(html: pa.Array) -> pa.Array:
        return pa.array((page(v) for v in html.to_pylist()), type=arrow_type)

    # Marked so that the optimizer does not repeat the parse for a filter on its result.
    select = select.asNondeterministic()
    gate = _may_match(html, [p if isinstance(p, Selector) else p[0] for p in plans.values()])
    return select(html if gate is None else F.when(gate, html))


def select_nodes(df: DataFrame, fields: Fields, html: str = "html") -> DataFrame:
    """Replace the page text by one array column per field.

    Only the text travels to Python; the other columns stay in the JVM. Filter the
    pages beforehand: a later filter is not moved in front of the parse.
    """
    keep = [c for c in df.columns if c != html]
    found = df.select(*keep, node_values(F.col(html), fields).alias("_found"))
    columns = [F.coalesce(F.col(f"_found.{n}"), F.array().cast(_type_of(s))).alias(n) for n, s in fields.items()]
    return found.select(*keep, *columns)


def tag_texts(html: Column, tag: str) -> Column:
    """Texts of the elements of one tag that hold nothing but text (native, no parse)."""
    return F.regexp_extract_all(html, F.lit(rf"(?i)<{tag}(?:\s[^>]*)?>([^<]*)</{tag}\s*>"), F.lit(1))
