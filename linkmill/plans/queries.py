"""The operators as queries over the given tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmill import schemas
from linkmill.functions import fields as C
from linkmill.functions import urls as U
from linkmill.operators import enrich, frontier, quality, records, stats
from linkmill.operators.bloom import BloomSize, bloom_build, bloom_maybe_contains
from linkmill.operators.cut import batch_cut
from linkmill.operators.dedup import admit, fingerprint, merge_pending, merge_seen
from linkmill.operators.links import (JOB_LINK_RULES, ListingSpec, LinkRule, PagerSpec, extract_links, extract_listing,
                                      filter_domains, filter_domains_table, next_page, route_links)
from linkmill.operators.nodes import select_nodes, tag_texts
from linkmill.operators.records import FieldSpec, each, extract_articles, extract_jobs, extract_table
from linkmill.plans import crawls
from linkmill.plans.staging import staging_path
from linkmill.sinks import bucketed, files, upsert as up
from linkmill.sinks.changelog import ChangeLog
from linkmill.sinks.seen import SeenStore, admit_stored
from linkmill.sources.pages import read_pages, spread, stream_pages, stream_seeds
from linkmill.sources.queue import SeedQueue
from linkmill.sources.seeds import decode_seeds, parse_seed_json, take_seeds
from linkmill.streaming.admission import admit_batches, stream_admit
from linkmill.streaming.counters import read_counts
from linkmill.streaming.loading import stream_load
from linkmill.streaming.state import stream_admit_state

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

START = dt.datetime(2024, 1, 1)
DEFAULT_DATE = dt.date(2000, 1, 1)
BATCH = 100
LARGE_BATCH = 5_000
STEP = 5
BLOOM = BloomSize.of(capacity=100_000, fpp=1e-8)
# The link rules of the routing query, by words that occur in the test links.
RULES = [
    LinkRule("article", r"/[a-m][a-z]*$", callback="parse_item", options={"wait": "1"}),
    LinkRule("escaped", r"%[0-9A-F]{2}", follow=False),
    LinkRule("other", r"https://.*"),
]
DOMAINS = "example.com,,example.org"
MARKER = "the"
DROP_LINE = "Home"


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return read_pages(spark, f"{folder}/pages.parquet")


def page_stream(spark: SparkSession, folder: str) -> DataFrame:
    # A pattern, because a stream takes a single file only from one.
    return stream_pages(spark, f"{folder}/pages.parque[t]")


def requests(pages_: DataFrame) -> DataFrame:
    """The links of pages as requests of the page's host."""
    links = extract_links(pages_).select(
        F.struct("page_id", "pos").alias("seq"), U.url_host("url").alias("spider"),
        F.col("abs_url").alias("url"), (-F.col("pos")).cast("int").alias("priority"),
        (F.col("pos") == 0).alias("dont_filter"))
    return fingerprint(links)


def seen_pages(pages_: DataFrame) -> DataFrame:
    """A seen-set: one fixed path on every host that has a page."""
    urls = pages_.select(U.url_host("url").alias("spider"), F.concat(U.url_origin("url"), F.lit("/the")).alias("the"))
    return urls.select("spider", U.request_fingerprint("the").alias("fp")).distinct()


def iso(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


# Seeds

def _seed_rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("seq"),
        F.concat(F.lit("http://seed.example.com/"), F.col("o_custkey")).alias("member"),
        F.col("o_totalprice").alias("score"))


@query
def seeds_list(spark, folder):
    return take_seeds(_seed_rows(spark, folder), BATCH)[0]


@query
def seeds_list_rest(spark, folder):
    return take_seeds(_seed_rows(spark, folder), BATCH)[1]


@query
def seeds_scored(spark, folder):
    return take_seeds(_seed_rows(spark, folder), BATCH, "scored")[0]


@query
def seeds_set(spark, folder):
    return take_seeds(_seed_rows(spark, folder), BATCH, "set", seed=7)[0]


@query
def seeds_cursor(spark, folder):
    """The second batch of a queue that is consumed by moving a cursor."""
    rows = _seed_rows(spark, folder)
    queue = SeedQueue(spark, staging_path(spark, "queue"), rows.schema)
    queue.push(rows)
    queue.take(BATCH)
    return queue.take(BATCH)


@query
def decode_seeds_(spark, folder):
    data = F.encode(F.when(F.col("url").contains("#"), F.lit("")).otherwise(F.col("url")), "UTF-8")
    return decode_seeds(pages(spark, folder).select(F.col("page_id").alias("seq"), data.alias("data")))


@query
def parse_seed_json_(spark, folder):
    url = F.concat(F.lit("http://seed.example.com/"), F.col("o_custkey"))
    message = F.concat(F.lit('["'), url, F.lit('", '), F.substring("o_orderpriority", 1, 1), F.lit(', "parse_'),
                       F.lower("o_orderstatus"), F.lit('"]'))
    return parse_seed_json(table(spark, folder, "orders").select(F.col("o_orderkey").alias("seq"),
                                                                 message.alias("message")))


# Links and URLs

@query
def extract_links_(spark, folder):
    return extract_links(pages(spark, folder))


@query
def extract_links_all(spark, folder):
    return extract_links(pages(spark, folder), unique=False)


@query
def route_links_(spark, folder):
    routed = route_links(extract_links(pages(spark, folder)), RULES)
    return routed.select("page_id", "abs_url", "rule", "callback", "follow",
                         F.coalesce(F.try_element_at("options", F.lit("wait")),
                                    F.lit("")).alias("wait"))


@query
def route_links_default(spark, folder):
    """The default job rules over targets of all kinds, one per order."""
    key = F.col("o_orderkey")
    kinds = ["jobs/{}.html", "gongsi/j{}.html", "guangzhou-zhaopin/{}", "jobs/{}xhtml", "about/{}"]
    path = F.lit(None).cast("string")
    for i, kind in enumerate(kinds):
        before, after = kind.split("{}")
        path = F.when(key % len(kinds) == i, F.concat(F.lit(before), key, F.lit(after))).otherwise(path)
    links = table(spark, folder, "orders").select(key.alias("page_id"), F.concat(F.lit("https://h.example/"), path).alias(
        "abs_url"))
    return route_links(links, JOB_LINK_RULES).select("page_id", "abs_url", "rule", "callback", "follow")


@query
def resolve_url_(spark, folder):
    hrefs = F.array(*[F.lit(h) for h in ("c", "../c", "./d/../e", "?q=2", "#z", "//k.example.com/y", "/r", "",
                                         "https://k.example.com/x#", "mailto:a@b")])
    rows = pages(spark, folder).select("page_id", "url", F.explode(hrefs).alias("href"))
    return rows.withColumn("abs_url", U.resolve_url("url", "href"))


@query
def fix_scheme_(spark, folder):
    bare = F.regexp_replace("url", "^http:", "")
    return pages(spark, folder).select("page_id", U.fix_scheme(bare).alias("fixed"))


def _variant() -> Column:
    """A page URL with two more parameters, one of which needs encoding."""
    plain = F.regexp_replace("url", "#.*$", "")
    mark = F.when(F.contains(plain, F.lit("?")), F.lit("&")).otherwise(F.lit("?"))
    return F.concat(plain, mark, F.lit("zz="), F.col("page_id"), F.lit("&a=x y#f"))


@query
def canonical_url_(spark, folder):
    rows = pages(spark, folder).select("page_id", "url", _variant().alias("variant"))
    return rows.select("page_id", U.canonical_url("url").alias("canonical"),
                       U.canonical_url("variant", keep_fragments=True).alias("canonical_variant"))


@query
def fingerprint_(spark, folder):
    rows = pages(spark, folder).select("page_id", "url", F.create_map(
        F.lit("wait"), F.lit("1"), F.lit("url"), F.col("url")).alias("options"))
    rows = fingerprint(fingerprint(rows), options_col="options", name="fp_options")
    return rows.select("page_id", "fp", "fp_options")


@query
def filter_domains_(spark, folder):
    return filter_domains(pages(spark, folder), DOMAINS).select("page_id", "url")


@query
def filter_domains_table_(spark, folder):
    """Pages on the domains, one label below the host, of every third page."""
    p = pages(spark, folder)
    domains = p.where("page_id % 3 = 0").select(F.substring_index(U.url_host("url"), ".", -3).alias("domain"))
    return filter_domains_table(p.select("page_id", "url"), domains)


@query
def extract_listing_(spark, folder):
    spec = ListingSpec("nav li", "a::attr(href)", "img::attr(src)")
    return extract_listing(pages(spark, folder), spec)


@query
def next_page_(spark, folder):
    spec = PagerSpec("nav li:last-child a::text", "nav li:last-child a::attr(href)")
    return next_page(pages(spark, folder), spec, MARKER)


# Records

@query
def select_nodes_(spark, folder):
    found = select_nodes(pages(spark, folder), {
        "title": "title::text", "h1": "h1::text", "nav": "nav li a::text", "second": "nav li:nth-child(2) a::attr(href)",
        "ad": "div.ad ::text", "content": "article"})
    return found.select("page_id", F.get("title", 0).alias("title"), F.get("h1", 0).alias("h1"),
                        F.array_join("nav", "|").alias("nav"), F.get("second", 0).alias("second"),
                        F.array_join("ad", "|").alias("ad"), F.md5(F.get("content", 0)).alias("content_md5"))


@query
def extract_articles_(spark, folder):
    spec = {
        "title": FieldSpec("h1::text", (each(lambda c: C.append_suffix(c, "-x", "y")),)),
        "content": FieldSpec("article"),
        "create_date": FieldSpec("h1::text", (each(lambda c: C.parse_date_or(c, default=DEFAULT_DATE)),)),
        "tags": FieldSpec("nav li a::text", (each(C.first_token),)),
        "comment_nums": FieldSpec("footer::text", (each(C.first_int),)),
    }
    items = C.with_defaults(extract_articles(pages(spark, folder), spec), schemas.ARTICLE_LOAD_DEFAULTS)
    return items.select("page_id", "title", "url", "url_object_id", "front_image_url", "praise_nums", "comment_nums",
                        "tags", F.md5("content").alias("content_md5"),
                        F.col("create_date").cast("string").alias("create_date"))


def job_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Job pages written from the part table, in the layout the job record expects."""
    html = F.format_string(
        '<div class="job-name" title="%1$s"></div><dd class="job_request"><h3><span class="salary">%2$dk-%3$dk</span>'
        '<span>/%4$s /</span><span>%2$d-%3$d /</span><span>%5$s /</span><span>%4$s</span></h3>'
        '<ul class="position-label"><li>%5$s</li><li>%4$s</li></ul><p class="publish_time">%2$d:02 on site</p></dd>'
        '<dd class="job-advantage"><p>%5$s</p></dd><dd class="job_bt"><div><p>%1$s</p></div></dd>'
        '<div class="work_addr">\n<a>%4$s</a> -\n<a> %5$s</a>\n<a>' + records.MAP_LINK + '</a>\n</div>'
        '<dl id="job_company"><dt><a href="http://c.example.com/%2$d"><img alt="%5$s"></a></dt></dl>',
        F.col("p_name"), F.col("p_size"), F.col("p_size") + 10, F.col("p_type"), F.col("p_brand"))
    part = spread(table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"))
    return part.select(
        F.col("p_partkey").alias("page_id"),
        F.concat(F.lit("http://jobs.example.com/jobs/"), F.col("p_partkey"), F.lit(".html")).alias("url"),
        html.alias("html"))


@query
def extract_jobs_(spark, folder):
    jobs = extract_jobs(job_pages(spark, folder), at=START)
    return jobs.withColumn("crawl_time", iso(F.col("crawl_time")))


def endpoint_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Endpoint lists written from the customer table, three rows each."""
    html = F.format_string(
        '<div id="list"><table><tr><th>IP</th></tr>'
        '<tr><td>%1$s</td><td>%2$d</td><td>x</td><td>%3$s</td><td>y</td><td>%4$s秒</td></tr>'
        '<tr><td>%1$s-b</td><td>81</td><td>x</td><td>%3$s</td><td>y</td><td></td></tr>'
        '<tr><td>%1$s-c</td><td>82</td><td>x</td><td>%3$s</td><td>y</td><td>abc</td></tr></table></div>',
        F.col("c_name"), F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_acctbal").cast("string"))
    customer = spread(table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal"))
    return customer.select(
        F.col("c_custkey").alias("page_id"), F.lit("http://list.example.com/").alias("url"), html.alias("html"))


@query
def extract_table_(spark, folder):
    return extract_table(endpoint_pages(spark, folder)).drop("url")


@query
def append_endpoints_(spark, folder):
    path = staging_path(spark, "endpoints")
    files.append_endpoints(extract_table(endpoint_pages(spark, folder)), path)
    return spark.read.schema(schemas.ENDPOINT).parquet(path)


# The crawls as a whole

def listing_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Listing pages written from the part table: an entry with and one without an image."""
    html = F.format_string(
        '<div class="post-item"><div class="post-item-text"><a href="/p/%1$d.html">%2$s</a>'
        '<p class="post-item-summary"><img src="//img.example.com/%1$d.png">Text</p></div></div>'
        '<div class="post-item"><div class="post-item-text"><a href="%1$d-b.html">B</a></div></div>'
        '<div class="pager"><a href="/list/0">1</a><a href="/list/%3$d">&gt;</a></div>',
        F.col("p_partkey"), F.col("p_name"), F.col("p_partkey") + 1)
    part = spread(table(spark, folder, "part").select("p_partkey", "p_name"))
    return part.select(
        F.col("p_partkey").alias("page_id"),
        F.concat(F.lit("http://list.example.com/p/list-"), F.col("p_partkey")).alias("url"), html.alias("html"))


def detail_pages(spark: SparkSession, folder: str) -> DataFrame:
    html = F.format_string(
        '<a id="cb_post_title_url"><span>%1$s</span></a><div id="cnblogs_post_body"><p>%2$s</p></div>'
        '<div class="postDesc"><span id="post-date">2020/04/22</span> <span id="post_view_count">%3$d</span>'
        '<span id="post_comment_count">(%4$d)</span> <a href="#">%2$s,x</a><a href="#">y</a></div>',
        F.col("p_name"), F.col("p_brand"), F.col("p_size"), F.col("p_partkey"))
    name = F.explode(F.array(F.lit(".html"), F.lit("-b.html")))
    part = spread(table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_size"))
    rows = part.select("*", name.alias("ending"))
    return rows.select(F.col("p_partkey").alias("page_id"), F.concat(
        F.lit("http://list.example.com/p/"), F.col("p_partkey"), F.col("ending")).alias("url"), html.alias("html"))


@query
def article_requests(spark, folder):
    return crawls.article_requests(listing_pages(spark, folder)).select(
        "page_id", "url", "callback", "dont_filter", "front_image_url")


@query
def article_crawl(spark, folder):
    requests_ = crawls.article_requests(listing_pages(spark, folder))
    items = crawls.article_records(detail_pages(spark, folder), requests_)
    items = C.with_defaults(items, schemas.ARTICLE_LOAD_DEFAULTS)
    return items.drop("page_id").withColumn("create_date", F.col("create_date").cast("string"))


@query
def job_crawl(spark, folder):
    admitted, _ = crawls.job_frontier(pages(spark, folder), rules=RULES)
    return admitted.select("url", "rule", "fp")


@query
def endpoint_crawl(spark, folder):
    checks = table(spark, folder, "customer").select(
        F.col("c_name").alias("ip"), F.when(F.col("c_acctbal") > 0, F.lit(204)).alias("status"))
    pool = crawls.endpoint_pool(endpoint_pages(spark, folder), checks, fill_speed=True)
    return pool.select("page_id", "ip", "port", "speed")


# Cleaning

@query
def map_compose_(spark, folder):
    values = C.map_compose(F.split("p_name", " "), F.upper, lambda x: F.when(F.length(x) > 3, x),
                           lambda x: F.concat(x, F.lit("!")))
    return table(spark, folder, "part").select("p_partkey", F.array_join(values, "|").alias("value"))


@query
def take_first_(spark, folder):
    values = F.concat(F.array(F.lit(None).cast("string"), F.lit("")), tag_texts(F.col("html"), "a"))
    return pages(spark, folder).select("page_id", C.take_first(values).alias("value"))


@query
def join_tags(spark, folder):
    return pages(spark, folder).select("page_id", C.join_values(tag_texts(F.col("html"), "a")).alias("value"))


@query
def append_suffix_(spark, folder):
    return table(spark, folder, "part").select("p_partkey", C.append_suffix(F.col("p_name"), *records.TITLE_SUFFIXES)
                                               .alias("value"))


@query
def parse_date_or_(spark, folder):
    good = F.date_format("o_orderdate", "yyyy/M/d")
    bad = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm")
    text = F.when(F.col("o_orderstatus") == "P", bad).otherwise(good)
    return table(spark, folder, "orders").select(
        "o_orderkey", C.parse_date_or(text, default=DEFAULT_DATE).cast("string").alias("value"),
        C.parse_date_or(text, default=DEFAULT_DATE, parity=True).cast("string").alias("parity_value"))


@query
def first_int_(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", C.first_int(F.col("p_brand")).alias("brand"), C.first_int(F.col("p_name")).alias("name"),
        C.first_int(F.concat(F.lit("a\n"), F.col("p_brand"))).alias("second_line"))


@query
def salary_floor_(spark, folder):
    text = F.concat(F.col("p_size"), F.lit("k-"), F.col("p_size") + 5, F.lit("k"))
    return table(spark, folder, "part").select("p_partkey", C.salary_floor(text).alias("salary"),
                                               C.salary_floor(F.col("p_type")).alias("none"))


@query
def first_token_(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.md5(C.first_token(F.col("text"))).alias("value_md5"))


@query
def remove_char_(spark, folder):
    return pages(spark, folder).select("page_id", C.remove_char(F.col("url")).alias("value"))


@query
def split_once_(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", C.take_first(C.split_once(F.col("p_name"))).alias("value"),
        C.take_first(C.split_once(F.concat(F.lit(" "), F.col("p_name")))).alias("after_blank"))


@query
def strip_tags_(spark, folder):
    text = C.strip_tags(F.col("html"))
    return pages(spark, folder).select("page_id", F.md5(text).alias("text_md5"), F.length(text).alias("n_chars"))


@query
def clean_lines_(spark, folder):
    text = C.clean_lines(F.col("text"), DROP_LINE)
    return table(spark, folder, "documents").select("doc_id", F.md5(text).alias("text_md5"),
                                                    F.length(text).alias("n_chars"))


@query
def md5_id_(spark, folder):
    return pages(spark, folder).select("page_id", C.md5_id(F.col("url")).alias("url_object_id"))


@query
def number_before_(spark, folder):
    text = F.when(F.col("event_type") == "error", F.lit("abc")).otherwise(
        F.concat(F.col("value").cast("string"), F.lit(records.SECONDS)))
    return table(spark, folder, "events").select("event_id", C.number_before(text, records.SECONDS).alias("speed"))


@query
def with_defaults_(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderstatus",
                                                   F.to_date("o_orderdate").alias("o_orderdate"))
    joined = table(spark, folder, "customer").select("c_custkey").join(
        orders, F.col("c_custkey") == F.col("o_custkey"), "left").drop("o_custkey")
    filled = C.with_defaults(joined, {"o_orderkey": 0, "o_orderstatus": "", "o_orderdate": "1970-07-01"})
    return filled.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


# Filters

@query
def filter_html_(spark, folder):
    return quality.filter_html(pages(spark, folder)).select("page_id", "url")


@query
def url_has_digit(spark, folder):
    return quality.filter_url_has_digit(extract_links(pages(spark, folder)), "abs_url").select("page_id", "abs_url")


@query
def split_valid_(spark, folder):
    labels = table(spark, folder, "labels").select(
        F.col("doc_id").alias("page_id"), "quality", F.when(F.col("quality") == 1, F.col("toxic")).alias("toxic"))
    rows = pages(spark, folder).select("page_id").join(labels, "page_id", "left")
    good, rejects = quality.split_valid(rows, ["quality", "toxic"])
    return (good.select("page_id", F.lit("").alias("missing"))
            .unionByName(rejects.select("page_id", F.array_join("missing", ",").alias("missing"))))


@query
def filter_status_ok_(spark, folder):
    status = F.when(F.col("event_type") != "error", F.get_json_object("props", "$.k").cast("int") * 10)
    return quality.filter_status_ok(table(spark, folder, "events").select("event_id", status.alias("status")))


# De-duplication

@query
def admit_(spark, folder):
    p = pages(spark, folder)
    admitted, _ = admit(requests(p), seen_pages(p), ("spider", "fp"))
    return admitted.select("seq.page_id", "seq.pos", "spider", "url", "fp", "dont_filter")


@query
def admit_bloom(spark, folder):
    p = pages(spark, folder)
    admitted, _ = admit(requests(p), seen_pages(p), ("spider", "fp"), dedup="bloom+exact", capacity=100_000)
    return admitted.select("seq.page_id", "seq.pos", "spider", "url", "fp", "dont_filter")


@query
def merge_seen_(spark, folder):
    p = pages(spark, folder)
    seen = seen_pages(p)
    _, new_seen = admit(requests(p), seen, ("spider", "fp"))
    return merge_seen(seen, new_seen)


def _page_part(spark: SparkSession, folder: str, parts: int, i: int) -> DataFrame:
    return pages(spark, folder).where(F.col("page_id") % parts == i)


def _new_keys(spark: SparkSession, folder: str, parts: int, i: int) -> DataFrame:
    return requests(_page_part(spark, folder, parts, i)).where("not dont_filter").select("spider", "fp")


@query
def seen_clear(spark, folder):
    """A stored set of two batches after its first spider has been cleared."""
    store = SeenStore(spark, staging_path(spark, "seen"))
    for i in range(2):
        store.add(_new_keys(spark, folder, 2, i), i)
    store.clear(store.read().agg(F.min("spider")).first()[0])
    return store.read()


@query
def seen_compact(spark, folder):
    """A stored set whose first batches were merged before the last one came."""
    store = SeenStore(spark, staging_path(spark, "seen"))
    for i in range(4):
        store.add(_new_keys(spark, folder, 4, i), i)
        if i % 2:
            store.compact()
    return store.read()


@query
def admit_stored_(spark, folder):
    """Two batches admitted one after the other against a stored set."""
    store = SeenStore(spark, staging_path(spark, "seen"))
    parts = [admit_stored(requests(_page_part(spark, folder, 2, i)), store, i) for i in range(2)]
    return parts[0].union(parts[1]).select("seq.page_id", "seq.pos", "spider", "url", "fp", "dont_filter")


@query
def admit_bucketed(spark, folder):
    p = pages(spark, folder)
    path = staging_path(spark, "buckets")
    name = "seen_" + path.rpartition("-")[2]
    bucketed.write_bucketed_seen(seen_pages(p), name, path, buckets=16)
    admitted, _ = bucketed.admit_bucketed(requests(p), name)
    return admitted.select("seq.page_id", "seq.pos", "spider", "url", "fp", "dont_filter")


@query
def bloom_build_(spark, folder):
    return bloom_build(pages(spark, folder).select("url"), "url", BLOOM)


@query
def bloom_probe(spark, folder):
    p = pages(spark, folder)
    bloom = bloom_build(p.select("url"), "url", BLOOM)
    keys = p.select("url").unionByName(extract_links(p).select(F.col("abs_url").alias("url")))
    return bloom_maybe_contains(keys, bloom, "url", BLOOM)


def _frontier(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("seq"), F.col("o_orderstatus").alias("spider"),
        F.concat(F.lit("http://seed.example.com/"), F.col("o_custkey")).alias("request_key"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"), F.col("o_orderdate").alias("at"))


@query
def merge_pending_(spark, folder):
    rows = _frontier(spark, folder)
    early = F.col("at") < F.lit("1997-01-01").cast("timestamp_ntz")
    return merge_pending(rows.filter(early), rows.filter(~early))


# Frontier

def _batch(order: str, part: int) -> Query:
    def run(spark, folder):
        return frontier.select_batch(_frontier(spark, folder).drop("at"), BATCH, order)[part]
    return run


REGISTRY["batch_fifo"] = _batch("fifo", 0)
REGISTRY["batch_lifo"] = _batch("lifo", 0)
REGISTRY["batch_priority"] = _batch("priority", 0)
REGISTRY["batch_rest"] = _batch("priority", 1)


@query
def batch_large(spark, folder):
    """A batch beyond the size at which ranks are cut before the shuffle."""
    frontier_ = _frontier(spark, folder).drop("at")
    return frontier.select_batch(frontier_, LARGE_BATCH)[0]


@query
def batch_cut_(spark, folder):
    return batch_cut(_frontier(spark, folder).drop("at"), BATCH)[0]


@query
def batch_cut_rest(spark, folder):
    return batch_cut(_frontier(spark, folder).drop("at"), BATCH)[1]


@query
def pending_count(spark, folder):
    return frontier.pending_count(_frontier(spark, folder))


@query
def plan_fetch(spark, folder):
    planned = frontier.plan_fetch(requests(pages(spark, folder)), 2, F.lit(START))
    return planned.select("seq.page_id", "seq.pos", "host", iso(F.col("fetch_at")).alias("fetch_at"))


@query
def plan_fetch_split(spark, folder):
    """The same plan with every host treated as too large for one task."""
    planned = frontier.plan_fetch(requests(pages(spark, folder)), 2, F.lit(START), task_rows=0)
    return planned.select("seq.page_id", "seq.pos", "host", iso(F.col("fetch_at")).alias("fetch_at"))


# Joins

@query
def carry_meta(spark, folder):
    p = pages(spark, folder)
    image = F.when(F.col("priority") == 0, F.lit("")).otherwise(F.concat(F.col("url"), F.lit(".png")))
    listing = requests(p).select("seq", "fp", image.alias("front_image_url"))
    details = p.select("page_id", F.concat(U.url_origin("url"), F.lit("/the")).alias("the"))
    details = details.select("page_id", U.request_fingerprint("the").alias("fp"))
    return enrich.carry_meta(details, listing)


@query
def attach_image_path(spark, folder):
    images = F.when(F.col("lang") == "en", F.array(F.lit("i.png"))).when(F.col("lang") == "fr", F.array().cast(
        "array<string>"))
    items = table(spark, folder, "documents").select(
        F.col("doc_id").alias("url"), images.alias("front_image_url"), F.col("source").alias("front_image_path"))
    results = table(spark, folder, "labels").select(
        F.col("doc_id").alias("url"), (F.col("quality") == 1).alias("ok"), F.col("toxic").alias("pos"),
        F.concat(F.lit("full/"), F.col("doc_id"), F.lit("-"), F.col("toxic")).alias("path"))
    return enrich.attach_image_path(items, results).select("url", "front_image_path")


@query
def prune_failed(spark, folder):
    endpoints = table(spark, folder, "documents").select(F.col("doc_id").alias("ip"), "source")
    status = F.when(F.col("toxic") == 0, F.when(F.col("quality") == 1, F.lit(200)).otherwise(F.lit(500)))
    checks = table(spark, folder, "labels").select(F.col("doc_id").alias("ip"), status.alias("status"))
    return enrich.prune_failed(endpoints, checks)


@query
def assign_member(spark, folder):
    rows = table(spark, folder, "customer").select(
        "c_custkey", F.when(F.col("c_mktsegment") == "BUILDING", F.lit("own")).alias("agent"))
    return enrich.assign_member(rows, table(spark, folder, "nation"), "c_custkey", ["n_nationkey"], "agent", "n_name",
                                seed="7")


def _assign_live(few: int) -> Query:
    def run(spark, folder):
        rows = table(spark, folder, "customer").select(
            "c_custkey", F.when(F.col("c_mktsegment") == "BUILDING", F.lit("own")).alias("agent"))
        pool = table(spark, folder, "nation").select("n_name", (F.col("n_nationkey") % 4 != 0).alias("alive"))
        return enrich.assign_live(rows, pool, "c_custkey", "agent", "n_name", "alive", seed="7", few=few)
    return run


REGISTRY["assign_live"] = _assign_live(enrich.LIVE_ROWS)
# The same with the pool treated as too large to be ranked in one step.
REGISTRY["assign_live_grouped"] = _assign_live(0)


# Statistics

@query
def crawl_stats(spark, folder):
    outcome = F.when(F.col("value") > 10, F.lit("admitted")).otherwise(F.lit("filtered"))
    return stats.crawl_stats(table(spark, folder, "events").select(F.col("event_type").alias("spider"),
                                                                   outcome.alias("outcome")))


def _speeds(spark: SparkSession, folder: str) -> DataFrame:
    speed = F.when(F.col("event_type") != "error", F.col("value"))
    return table(spark, folder, "events").select("event_id", "user_id", speed.alias("speed"))


@query
def carry_forward(spark, folder):
    return stats.carry_forward(_speeds(spark, folder), "speed", ["event_id"], ["user_id"])


@query
def carry_forward_split(spark, folder):
    """The same with every user treated as too large for one task."""
    return stats.carry_forward(_speeds(spark, folder), "speed", ["event_id"], ["user_id"], task_rows=0)


# Sinks

@query
def json_roundtrip(spark, folder):
    rows = table(spark, folder, "part")
    path = staging_path(spark, "json")
    files.write_json(rows, path)
    return spark.read.schema(rows.schema).json(path)


@query
def item_feed(spark, folder):
    path = staging_path(spark, "feed")
    files.write_item_feed(files.to_item_feed(table(spark, folder, "part"), "parts"), path)
    feed = spark.read.schema("value string, key string").parquet(path)

    def read(name: str) -> Column:
        return F.get_json_object("value", f"$.{name}")

    return feed.select("key", read("p_partkey").cast("bigint").alias("p_partkey"), read("p_name").alias("p_name"),
                       read("p_size").cast("int").alias("p_size"),
                       read("p_retailprice").cast("double").alias("p_retailprice"))


@query
def item_feed_custom(spark, folder):
    """A feed with a serializer of one's own."""
    def line(item: Column) -> Column:
        return F.concat_ws("|", item["p_partkey"].cast("string"), item["p_name"])

    return files.to_item_feed(table(spark, folder, "part"), "parts", line)


def _upsert(spark: SparkSession, folder: str, update_cols: list[str]) -> DataFrame:
    value = F.when(F.col("event_type") != "error", F.col("value"))
    rows = table(spark, folder, "events").select(F.col("event_id").alias("seq"), "user_id", "event_type", "props",
                                                 value.alias("value"), "ts")
    cut = F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz")
    target = up.fold_changes(rows.filter(cut).drop("ts"), "user_id", [], ["seq"])
    return up.upsert(target, rows.filter(~cut).drop("ts"), "user_id", update_cols)


@query
def upsert_articles(spark, folder):
    return _upsert(spark, folder, ["value"])


@query
def upsert_jobs(spark, folder):
    return _upsert(spark, folder, ["value", "props"])


@query
def compact_changes(spark, folder):
    """Eight batches of changes, merged level by level as they come, read as one table."""
    value = F.when(F.col("event_type") != "error", F.col("value"))
    rows = table(spark, folder, "events").select(F.col("event_id").alias("seq"), "user_id", "event_type", "props",
                                                 value.alias("value"))
    first, last = rows.agg(F.min("seq"), F.max("seq")).first()
    log = ChangeLog(spark, staging_path(spark, "changes"), rows.schema, "user_id", ["value"], fanout=2)
    for i in range(8):
        batch = F.expr(f"least((seq - {first}) * 8 div {max(1, last - first)}, 7)")
        log.append(rows.where(batch == i), i)
        log.compact()
    return log.current()


# Streams, run until the given files are read

@query
def stream_pages_(spark, folder):
    path, check = staging_path(spark, "pages"), staging_path(spark, "check")
    stream = page_stream(spark, folder)
    rows = stream.select("page_id", "url", F.md5("html").alias("html_md5"))
    _finish(rows.writeStream.format("parquet").option("checkpointLocation", check).trigger(availableNow=True)
            .start(path))
    return spark.read.schema(rows.schema).parquet(path)


def _finish(running) -> None:
    running.awaitTermination()
    if running.exception() is not None:
        raise running.exception()


@query
def stream_admit_(spark, folder):
    path, check = staging_path(spark, "admitted"), staging_path(spark, "check")
    rows = stream_admit(requests(page_stream(spark, folder)), dont_filter=None).select("spider", "fp")
    _finish(rows.writeStream.format("parquet").option("checkpointLocation", check).trigger(availableNow=True)
            .start(path))
    return spark.read.schema(rows.schema).parquet(path)


@query
def stream_admit_batches(spark, folder):
    out = staging_path(spark, "admitted")
    rows = requests(page_stream(spark, folder))
    _finish(admit_batches(rows, staging_path(spark, "seen"), out, staging_path(spark, "check")))
    return spark.read.parquet(out).select("seq.page_id", "seq.pos", "spider", "url", "fp", "dont_filter")


@query
def stream_admit_state_(spark, folder):
    path, check = staging_path(spark, "admitted"), staging_path(spark, "check")
    rows = stream_admit_state(requests(page_stream(spark, folder)))
    _finish(rows.writeStream.format("parquet").option("checkpointLocation", check).trigger(availableNow=True)
            .start(path))
    admitted = spark.read.schema(rows.schema).parquet(path)
    return admitted.select("seq.page_id", "seq.pos", "spider", "url", "fp", "dont_filter")


@query
def stream_stats(spark, folder):
    """Requests enqueued, filtered and dequeued by each of two micro-batches."""
    source, out, seen, check, counts = (staging_path(spark, n) for n in ("pages", "admitted", "seen", "check", "counts"))

    def pop(admitted: DataFrame, batch_id: int) -> dict[str, int]:
        return {"dequeued": frontier.select_batch(admitted, STEP)[0].count()}

    for half in (0, 1):
        _page_part(spark, folder, 2, half).write.mode("append").parquet(source)
        _finish(admit_batches(requests(stream_pages(spark, source)), seen, out, check, after=pop, counts_path=counts))
    return read_counts(spark, counts)


@query
def resume(spark, folder):
    """Admission stopped after the first pages and started again when others have come."""
    source, out = staging_path(spark, "pages"), staging_path(spark, "admitted")
    seen, check = staging_path(spark, "seen"), staging_path(spark, "check")
    for half in (0, 1):
        pages(spark, folder).where(F.col("page_id") % 2 == half).write.mode("append").parquet(source)
        _finish(admit_batches(requests(stream_pages(spark, source)), seen, out, check))
    return spark.read.parquet(out).select("seq.page_id", "seq.pos", "spider", "url", "fp", "dont_filter")


@query
def stream_seeds_(spark, folder):
    """Seed messages as they come in, decoded."""
    source, path, check = (staging_path(spark, n) for n in ("seeds", "decoded", "check"))
    _seed_rows(spark, folder).select("seq", F.encode("member", "UTF-8").alias("data"), "score").write.parquet(source)
    rows = decode_seeds(stream_seeds(spark, source)).select("seq", "url", "dont_filter")
    _finish(rows.writeStream.format("parquet").option("checkpointLocation", check).trigger(availableNow=True)
            .start(path))
    return spark.read.schema(rows.schema).parquet(path)


@query
def stream_load_(spark, folder):
    feed, changes, rejects = (staging_path(spark, n) for n in ("feed", "changes", "rejects"))
    stream = page_stream(spark, folder)
    items = records.extract_records(stream.withColumn("seq", F.col("page_id")).withColumn(
        "url_object_id", C.md5_id(F.col("url"))).drop("page_id"), {
            "title": FieldSpec("h1::text"), "tags": FieldSpec("nav li:nth-child(6) a::text")})
    _finish(stream_load(items, "articles", ["title", "tags"], feed, changes, rejects, staging_path(spark, "check")))
    return up.read_current(spark, changes, items.schema, "url_object_id", ["title"])


def named_queries() -> dict[str, Query]:
    return {name.rstrip("_"): fn for name, fn in REGISTRY.items()}
