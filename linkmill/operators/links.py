"""Links of pages: extraction, routing, listing and pager rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkmill.functions import urls as U
from linkmill.operators.nodes import Each, select_nodes
from linkmill.operators.skew import join_one

# Largest domain table that is sent to every executor.
DOMAIN_ROWS = 1_000_000

# Link targets that are no pages.
DENIED_EXTENSIONS = (
    "7z 7zip bz2 rar tar gz xz zip "
    "mng pct bmp gif jpg jpeg png pst psp tif tiff ai drw dxf eps ps svg cdr ico webp "
    "mp3 wma ogg wav ra aac mid au aiff "
    "3gp asf asx avi mov mp4 mpg qt rm swf wmv m4a m4v flv webm "
    "xls xlsx ppt pptx pps doc docx odt ods odg odp "
    "css pdf exe bin rss dmg iso apk"
).split()
# Schemes a link may have.
LINK_SCHEMES = ["http", "https", "file", "ftp"]

# One pass over the text: comments, scripts and styles match without a group, so links
# inside them are not found; where their end is missing they reach to the end of the page.
# The repeats are possessive, so a tag of any length is matched without recursion and in
# linear time: a quote without its partner has none after it either, and ends the tag.
_TAG = (
    r"""(?is)<(?:!--.*?(?:-->|\z)|script\b.*?(?:</script|\z)|style\b.*?(?:</style|\z)|"""
    r"""(a(?:rea)?\s(?:[^>"']++|"[^"]*+"|'[^']*+')*+))"""
)
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'>]++)"""
_HREF = (
    rf"""(?is)^a(?:rea)?(?:\s++(?!href\s*+=)[^\s"'>=]++(?:\s*+=\s*+{_VALUE})?+)*+"""
    rf"""\s++href\s*+=\s*+({_VALUE})"""
)
_BASE = r"""(?is)<base\s[^>]*href\s*=\s*["']\s*([^"'\s]+)"""
_PIECE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,7});|[^&]++|&"


def _attribute_text(c: Column) -> Column:
    """Quotes and outer blanks removed; numeric and common named references decoded once, from left to right."""
    bare = F.regexp_replace(c, r"""^["']?\s*|\s*["']?$""", "")
    names = F.create_map(*(F.lit(x) for name, code in sorted(name2codepoint.items()) for x in (f"&{name};", chr(code))))

    def decoded(piece: Column) -> Column:
        digits = F.regexp_extract(piece, "^&#([0-9]+);$", 1)
        hexed = F.regexp_extract(piece, "^&#[xX]([0-9a-fA-F]+);$", 1)
        code = F.when(hexed != "", F.conv(hexed, 16, 10)).otherwise(digits).try_cast("int")
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return (F.when(~F.startswith(piece, F.lit("&")) | (F.length(piece) < 3), piece)
                .when(F.startswith(piece, F.lit("&#")), F.when(valid, char).otherwise(piece))
                .otherwise(F.coalesce(F.try_element_at(names, piece), piece)))

    out = F.array_join(F.transform(F.regexp_extract_all(bare, F.lit(_PIECE), F.lit(0)), decoded), "")
    return F.when(F.contains(bare, F.lit("&")), out).otherwise(bare)


def _link_allowed() -> Column:
    url = F.col("abs_url")
    extension = F.lower(F.regexp_extract(url, r"^[^?#]*\.([A-Za-z0-9]+)(?:[?#]|$)", 1))
    path_only = U.url_path("abs_url")
    denied = F.contains(path_only, F.lit(".")) & extension.isin(DENIED_EXTENSIONS)
    return F.lower(F.regexp_extract(url, r"^([A-Za-z]+)://", 1)).isin(LINK_SCHEMES) & ~denied


def extract_links(pages: DataFrame, unique: bool = True) -> DataFrame:
    """`page_id, url, pos, href, abs_url`, one row per distinct target of a page.

    Works inside the row: no shuffle, and the page text is gone before the rows
    multiply. `pos` counts the links of the page from 0. `unique=False` keeps
    every occurrence of a target.
    """
    tags = F.filter(F.regexp_extract_all("html", F.lit(_TAG), F.lit(1)), lambda t: t != "")
    raw = F.transform(tags, lambda t: F.regexp_extract(t, _HREF, 1))
    found = pages.select("page_id", "url", raw.alias("_raw"), F.regexp_extract("html", _BASE, 1).alias("_tag"))
    hrefs = F.transform(F.filter("_raw", lambda x: x != ""), _attribute_text)
    found = found.select("page_id", "url", hrefs.alias("_texts"), U.base_from_tag("url", "_tag").alias("_base"))
    safe = F.expr(f"transform(_texts, h -> {U.safe_url_sql('h')})")
    found = found.select("page_id", "url", safe.alias("_hrefs"), *U.BaseUrl.of("_base").columns("_base_"))
    target = U.resolve_sql(U.BaseUrl.from_columns("_base_"), "h")
    links = F.expr(f"transform(_hrefs, (h, n) -> struct({target} AS abs_url, CAST(n AS BIGINT) AS pos, h AS href))")
    if unique:
        # Sorted by target, so that a repeated target follows its first occurrence.
        found = found.select("page_id", "url", F.sort_array(links).alias("_links"))
        links = F.filter("_links", lambda s, i: (i == 0) | (s["abs_url"] != F.get("_links", i - 1)["abs_url"]))
    rows = found.select("page_id", "url", F.explode(links).alias("_l"))
    return rows.select("page_id", "url", "_l.pos", "_l.href", "_l.abs_url").filter(_link_allowed())


@dataclass(frozen=True)
class LinkRule:
    """A pattern searched in the absolute URL, and what a matching link is for."""

    name: str
    pattern: str
    callback: str | None = None
    follow: bool = True
    options: Mapping[str, str] = field(default_factory=dict)


# What a rendered request asks for.
RENDER = {"endpoint": "render.html", "wait": "1"}
# The link rules of the job crawl, in order.
JOB_LINK_RULES = [
    LinkRule("job", r"jobs/\d+\.html", callback="parse_item", options=RENDER),
    LinkRule("city", r"guangzhou-zhaopin/.*"),
    LinkRule("company", r"gongsi/j\d+\.html", callback="parse_item", options=RENDER),
]
# The same with two defects kept, loose ends and a company rule that matches hardly any company.
JOB_LINK_RULES_PARITY = [
    LinkRule("job", r"jobs/\d+.html*", callback="parse_item", options=RENDER),
    LinkRule("city", r"guangzhou-zhaopin/.*"),
    LinkRule("company", r"gongsi/j\.*.html", callback="parse_item", options=RENDER),
]


def route_links(links: DataFrame, rules: Sequence[LinkRule]) -> DataFrame:
    """Give every link to the first rule that matches; drop links without a rule.

    `links` holds every target once per page, as `extract_links` returns it.
    """
    if not rules:
        raise ValueError("at least one rule is needed")
    index = None
    for i, rule in enumerate(rules):
        hit = F.col("abs_url").rlike(rule.pattern)
        index = F.when(hit, F.lit(i)) if index is None else index.when(hit, F.lit(i))

    def pick(values: list[Column]) -> Column:
        return F.element_at(F.array(*values), F.col("rule_index") + 1)

    def options(rule: LinkRule) -> Column:
        pairs = [F.lit(x) for kv in sorted(rule.options.items()) for x in kv]
        return (F.create_map(*pairs) if pairs else F.create_map()).cast("map<string,string>")

    routed = links.withColumn("rule_index", index).filter(F.col("rule_index").isNotNull())
    return routed.withColumns({
        "rule": pick([F.lit(r.name) for r in rules]),
        "callback": pick([F.lit(r.callback).cast("string") for r in rules]),
        "follow": pick([F.lit(r.follow) for r in rules]),
        "options": pick([options(r) for r in rules]),
    })


def domain_list(text: str) -> list[str]:
    """Comma separated domains without the empty ones."""
    return [d.strip().lower() for d in text.split(",") if d.strip()]


def filter_domains(df: DataFrame, domains: Sequence[str] | str, url: str = "url") -> DataFrame:
    """Keep URLs on one of the domains or below it; an empty list keeps all.

    The host is looked up together with all its parent domains in one literal
    set, so a long list costs no more per row than a short one and nothing moves.
    """
    names = domain_list(domains) if isinstance(domains, str) else [d.lower() for d in domains if d]
    if not names:
        return df
    host = U.url_host(url)
    labels = F.split(host, r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return df.filter(F.exists(parents, lambda d: d.isin(names)))


def filter_domains_table(df: DataFrame, domains: DataFrame, url: str = "url", domain: str = "domain",
                         broadcast_rows: int = DOMAIN_ROWS) -> DataFrame:
    """`filter_domains` with the domains as a table, however long; an empty table keeps all.

    The distinct hosts are matched, not the rows: every host is expanded to itself and its
    parents and semi-joined with the domains, which are counted and sent to every executor
    only if they are few. The hosts that match then select the rows; a host with very many
    rows stays in their tasks (`join_one`).
    """
    names = domains.select(F.lower(F.trim(domain)).alias("_domain")).where("_domain <> ''").distinct()
    size = names.limit(broadcast_rows + 1).count()
    if size == 0:
        return df
    keyed = df.withColumn("_host", U.url_host(url))
    hosts = keyed.select("_host").where("_host is not null").distinct()
    labels = F.split("_host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    expanded = hosts.select("_host", F.explode(parents).alias("_domain"))
    listed = expanded.join(F.broadcast(names) if size <= broadcast_rows else names, "_domain", "left_semi")
    allowed = listed.select("_host").distinct().withColumn("_allowed", F.lit(True))
    return join_one(keyed, allowed, "_host").where("_allowed").select(*df.columns)


@dataclass(frozen=True)
class ListingSpec:
    """A listing page: the repeated element and what is read inside it."""

    node: str = ".post-item .post-item-text"
    link: str = ".post-item-text a::attr(href)"
    image: str = ".post-item-text .post-item-summary img::attr(src)"


@dataclass(frozen=True)
class PagerSpec:
    text: str = "div.pager a:last-child::text"
    link: str = "div.pager a:last-child::attr(href)"


def extract_listing(pages: DataFrame, spec: ListingSpec = ListingSpec()) -> DataFrame:
    """`page_id, url, pos, abs_url, front_image_url`, one row per listed element."""
    found = select_nodes(pages.select("page_id", "url", "html"),
                         {"_items": Each(spec.node, {"link": spec.link, "image": spec.image})})
    items = found.select("page_id", "url", F.posexplode("_items").alias("pos", "_item"))
    href = F.coalesce(F.get(F.col("_item.link"), 0), F.lit(""))
    image = F.coalesce(F.get(F.col("_item.image"), 0), F.lit(""))
    items = items.select("page_id", "url", "pos", href.alias("_href"), image.alias("_image"))
    return items.select("page_id", "url", "pos", U.resolve_url("url", "_href").alias("abs_url"),
                        U.fix_scheme(F.col("_image")).alias("front_image_url"))


def listing_requests(pages: DataFrame, listing: ListingSpec = ListingSpec(), pager: PagerSpec = PagerSpec(),
                     marker: str = ">") -> DataFrame:
    """What `extract_listing` and `next_page` find, each page parsed once for both.

    `page_id, url, pos, abs_url, front_image_url`; the next page has no `pos` and an empty image.
    """
    found = select_nodes(pages.select("page_id", "url", "html"), {
        "_items": Each(listing.node, {"link": listing.link, "image": listing.image}),
        "_text": pager.text, "_link": pager.link})
    items = F.transform("_items", lambda item, i: F.struct(
        i.cast("bigint").alias("pos"), F.coalesce(F.get(item["link"], 0), F.lit("")).alias("href"),
        F.coalesce(F.get(item["image"], 0), F.lit("")).alias("image")))
    more = F.array(F.struct(F.lit(None).cast("bigint").alias("pos"), F.coalesce(F.get("_link", 0), F.lit("")).alias("href"),
                            F.lit("").alias("image")))
    hits = F.when(F.get("_text", 0) == marker, more).otherwise(F.slice(more, 1, 0))
    rows = found.select("page_id", "url", F.explode(F.concat(items, hits)).alias("_row")).select("page_id", "url", "_row.*")
    return rows.select("page_id", "url", "pos", U.resolve_url("url", "href").alias("abs_url"),
                       U.fix_scheme(F.col("image")).alias("front_image_url"))


def next_page(pages: DataFrame, spec: PagerSpec = PagerSpec(), marker: str = ">") -> DataFrame:
    """`page_id, url, abs_url, dont_filter` of the pages whose last pager link is the marker."""
    found = select_nodes(pages.select("page_id", "url", "html"), {"_text": spec.text, "_link": spec.link})
    hits = found.filter(F.get("_text", 0) == marker)
    href = F.coalesce(F.get("_link", 0), F.lit(""))
    hits = hits.select("page_id", "url", href.alias("_href"))
    return hits.select("page_id", "url", U.resolve_url("url", "_href").alias("abs_url"), F.lit(True).alias("dont_filter"))
