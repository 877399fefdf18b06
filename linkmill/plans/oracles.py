"""The queries in SQL, written independently of the operators, for comparison."""

from __future__ import annotations

# What the queries are called with, and marks of the pages.
BATCH = 100
BLOOM_BLOCKS = 23188
MARKER, DROP_LINE = "the", "Home"
TITLE_ENDING, SECONDS = "-风骚男", "秒"

_ORIGIN = "regexp_extract(url, '^(https?://[^/?#]*)', 1)"
_HOST = "lower(regexp_extract({}, '^https?://([^/?#:]*)', 1))"
_ENCODE = """array_to_string(list_transform(regexp_extract_all({}, '(?s).'), lambda c:
    CASE WHEN regexp_full_match(c, '[A-Za-z0-9._~:/?#@!$&''()*+,;=|%-]|\\[|\\]') THEN c ELSE url_encode(c) END), '')"""

_OCCURRENCES = f"""
occurrences AS (
  SELECT page_id, url, pos, {_ENCODE.format("raw")} AS href FROM (
    SELECT page_id, url, unnest(h) AS raw, CAST(generate_subscripts(h, 1) - 1 AS BIGINT) AS pos FROM (
      SELECT page_id, url, list_transform(regexp_extract_all(html, '<a href="([^"]*)"', 1),
                                          lambda x: replace(x, '&amp;', '&')) AS h FROM pages))),
all_links AS (SELECT page_id, url, pos, href, {_ORIGIN} || href AS abs_url FROM occurrences)"""
_LINKS = f"""{_OCCURRENCES},
links AS (SELECT * FROM all_links QUALIFY row_number() OVER (PARTITION BY page_id, abs_url ORDER BY pos) = 1)"""
_REQUESTS = f"""{_LINKS},
requests AS (SELECT page_id, pos, {_HOST.format("url")} AS spider, abs_url AS url,
             CAST(-pos AS INTEGER) AS priority, pos = 0 AS dont_filter, sha1('GET' || abs_url) AS fp FROM links)"""
_SEEN = f"""{_REQUESTS},
seen AS (SELECT DISTINCT {_HOST.format("url")} AS spider, sha1('GET' || {_ORIGIN} || '/the') AS fp FROM pages),
fresh AS (SELECT * FROM (SELECT * FROM requests WHERE NOT dont_filter
                         QUALIFY row_number() OVER (PARTITION BY spider, fp ORDER BY page_id, pos) = 1) r
          ANTI JOIN seen USING (spider, fp))"""
_ADMIT = f"""WITH {_SEEN}
SELECT page_id, pos, spider, url, fp, dont_filter FROM fresh
UNION ALL SELECT page_id, pos, spider, url, fp, dont_filter FROM requests WHERE dont_filter"""

_RESUME = f"""WITH {_REQUESTS}
SELECT page_id, pos, spider, url, fp, dont_filter FROM requests WHERE NOT dont_filter
QUALIFY row_number() OVER (PARTITION BY spider, fp ORDER BY page_id % 2, page_id, pos) = 1
UNION ALL SELECT page_id, pos, spider, url, fp, dont_filter FROM requests WHERE dont_filter"""

_NAV = "regexp_extract_all(html, '<a href=\"[^\"]*\">([^<]*)</a>', 1)"


def _text(x: str) -> str:
    """The character references that occur in the test pages, decoded; some are cut short."""
    return f"regexp_replace(regexp_replace({x}, '&quot;?', '\"', 'g'), '&amp;?', '&', 'g')"


_NAV_TEXT = f"list_transform({_NAV}, lambda x: {_text('x')})"
_H1 = _text("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")

_WORDS = ", ".join(
    f"""CAST(CASE WHEN w{i} >= 9223372036854775808 THEN w{i}::HUGEINT - 18446744073709551616 ELSE w{i}::HUGEINT END
    AS BIGINT) AS w{i}""" for i in range(8))
_MASKS = ", ".join(f"1::UBIGINT << (('0x' || substr(md5(url), {17 + 2 * i}, 2))::BIGINT & 63)::UBIGINT AS m{i}"
                   for i in range(8))
_BLOCK = f"('0x' || substr(md5(url), 1, 15))::BIGINT % {BLOOM_BLOCKS} AS block"
_BLOOM = f"""bloom AS (SELECT block, {", ".join(f"bit_or(m{i}) AS w{i}" for i in range(8))}
  FROM (SELECT {_BLOCK}, {_MASKS} FROM pages) GROUP BY block)"""

_SEEDS = ("seeds AS (SELECT o_orderkey AS seq, 'http://seed.example.com/' || o_custkey AS member, "
          "o_totalprice AS score FROM orders)")
_FRONTIER = """frontier AS (SELECT o_orderkey AS seq, o_orderstatus AS spider,
  'http://seed.example.com/' || o_custkey AS request_key, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority,
  o_orderdate AS at FROM orders)"""

# An expression for the canonical form of a page URL with the given query pairs.
_PLAIN = "split_part(split_part(url, '#', 1), '?', 1)"
_PAIRS = "list_filter(string_split(split_part(split_part(url, '#', 1), '?', 2), '&'), lambda x: x <> '')"
_CANONICAL = f"""{_PLAIN} || CASE WHEN contains(split_part(url, '#', 1), '?')
  THEN '?' || array_to_string(list_sort({_PAIRS}), '&') ELSE '' END"""
_FRAGMENT = "CASE WHEN contains(url, '#') THEN '#' || split_part(url, '#', 2) ELSE '' END"


def _batch(order: str, keep: str, n: int = BATCH) -> str:
    return f"""WITH {_FRONTIER}
SELECT seq, spider, request_key, priority FROM frontier
QUALIFY row_number() OVER (PARTITION BY spider ORDER BY {order}) {keep} {n}"""


def _plan() -> str:
    return f"""WITH {_REQUESTS}, hosted AS (SELECT page_id, pos, {_HOST.format("url")} AS host, priority FROM requests)
SELECT page_id, pos, host, strftime(TIMESTAMP '2024-01-01' + to_seconds(2 * (row_number() OVER
  (PARTITION BY host ORDER BY priority DESC, page_id, pos) - 1)), '%Y-%m-%d %H:%M:%S') AS fetch_at FROM hosted"""


def _carry() -> str:
    return """SELECT event_id, user_id, last_value(CASE WHEN event_type <> 'error' THEN value END IGNORE NULLS)
  OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS speed
FROM events"""


def _upsert(update: list[str]) -> str:
    picks = []
    for c in ("event_type", "props", "value"):
        how, rows = ("arg_max_null", "") if c in update else ("arg_min_null", "")
        # A known key keeps what the target holds, which is its first early row; a column that
        # the batch may change comes from the last late row, or stays.
        if c in update:
            picks.append(f"""CASE WHEN count(*) FILTER (late) > 0 THEN {how}({c}, seq) FILTER (late)
              ELSE arg_min_null({c}, seq) FILTER (NOT late) END AS {c}""")
        else:
            picks.append(f"{how}({c}, seq){rows} AS {c}")
    return f"""SELECT user_id, {", ".join(picks)} FROM (
  SELECT event_id AS seq, user_id, event_type, props, ts >= TIMESTAMP '2024-01-10' AS late,
         CASE WHEN event_type <> 'error' THEN value END AS value FROM events) GROUP BY user_id"""


def sql() -> dict[str, str]:
    good_date = "strftime(o_orderdate, '%Y/%-m/%-d')"
    date_text = f"CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M') ELSE {good_date} END"
    parsed = f"CAST(try_strptime({date_text}, '%Y/%m/%d') AS DATE)"
    path = "regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1)"
    folder = f"regexp_replace({path}, '[^/]*$', '')"
    parent = f"regexp_replace(regexp_replace({folder}, '/$', ''), '[^/]*$', '')"
    parent = f"CASE WHEN {parent} = '' THEN '/' ELSE {parent} END"
    query_part = "regexp_extract(url, '^[^?#]*([?][^#]+)', 1)"
    hrefs = ["c", "../c", "./d/../e", "?q=2", "#z", "//k.example.com/y", "/r", "", "https://k.example.com/x#",
             "mailto:a@b"]
    href_rows = ", ".join(f"('{h}')" for h in hrefs)
    variant_pairs = f"list_sort(list_concat({_PAIRS}, ['a=x+y', 'zz=' || page_id]))"
    trim = r"regexp_replace(x, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')"
    return {
        "seeds_list": f"WITH {_SEEDS} SELECT * FROM seeds ORDER BY seq LIMIT {BATCH}",
        "seeds_list_rest": f"WITH {_SEEDS} SELECT * FROM seeds ORDER BY seq OFFSET {BATCH}",
        "seeds_cursor": f"WITH {_SEEDS} SELECT * FROM seeds ORDER BY seq LIMIT {BATCH} OFFSET {BATCH}",
        "seeds_scored": f"""WITH {_SEEDS} SELECT member, arg_max_null(score, seq) AS score FROM seeds
            GROUP BY member ORDER BY score DESC, member DESC LIMIT {BATCH}""",
        "seeds_set": f"""WITH {_SEEDS} SELECT DISTINCT member FROM seeds
            ORDER BY md5(member || '|7'), member LIMIT {BATCH}""",
        "decode_seeds": """SELECT page_id AS seq, url, true AS dont_filter FROM pages
            WHERE NOT contains(url, '#') AND url <> ''""",
        "parse_seed_json": """SELECT o_orderkey AS seq, 'http://seed.example.com/' || o_custkey AS url,
            CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority, 'parse_' || lower(o_orderstatus) AS callback,
            false AS dont_filter FROM orders""",
        "extract_links": f"WITH {_LINKS} SELECT page_id, url, pos, href, abs_url FROM links",
        "extract_links_all": f"WITH {_OCCURRENCES} SELECT page_id, url, pos, href, abs_url FROM all_links",
        "route_links_default": """SELECT page_id, abs_url, rule, CASE WHEN rule <> 'city' THEN 'parse_item' END AS callback,
            true AS follow FROM (SELECT o_orderkey AS page_id, 'https://h.example/' || CASE o_orderkey % 5
              WHEN 0 THEN 'jobs/' || o_orderkey || '.html' WHEN 1 THEN 'gongsi/j' || o_orderkey || '.html'
              ELSE 'guangzhou-zhaopin/' || o_orderkey END AS abs_url,
              CASE o_orderkey % 5 WHEN 0 THEN 'job' WHEN 1 THEN 'company' ELSE 'city' END AS rule
            FROM orders WHERE o_orderkey % 5 < 3)""",
        "route_links": f"""WITH {_LINKS}, routed AS (SELECT page_id, abs_url, CASE
              WHEN regexp_matches(abs_url, '/[a-m][a-z]*$') THEN 'article'
              WHEN regexp_matches(abs_url, '%[0-9A-F]{{2}}') THEN 'escaped'
              WHEN regexp_matches(abs_url, 'https://.*') THEN 'other' END AS rule FROM links)
            SELECT page_id, abs_url, rule, CASE WHEN rule = 'article' THEN 'parse_item' END AS callback,
              rule <> 'escaped' AS follow, CASE WHEN rule = 'article' THEN '1' ELSE '' END AS wait
            FROM routed WHERE rule IS NOT NULL""",
        "resolve_url": f"""SELECT page_id, url, href, CASE href
              WHEN 'c' THEN {_ORIGIN} || {folder} || 'c'
              WHEN '../c' THEN {_ORIGIN} || {parent} || 'c'
              WHEN './d/../e' THEN {_ORIGIN} || {folder} || 'e'
              WHEN '?q=2' THEN {_ORIGIN} || {path} || '?q=2'
              WHEN '#z' THEN {_ORIGIN} || {path} || {query_part} || '#z'
              WHEN '//k.example.com/y' THEN split_part(url, '/', 1) || href
              WHEN '/r' THEN {_ORIGIN} || href
              WHEN '' THEN url
              WHEN 'mailto:a@b' THEN href
              ELSE CASE WHEN starts_with(url, 'https:') THEN 'https://k.example.com/x' ELSE href END END AS abs_url
            FROM pages, (VALUES {href_rows}) h(href)""",
        "fix_scheme": """SELECT page_id, CASE WHEN starts_with(url, 'http:') THEN 'https:' || substr(url, 6) ELSE url END
            AS fixed FROM pages""",
        "canonical_url": f"""SELECT page_id, {_CANONICAL} AS canonical,
            {_PLAIN} || '?' || array_to_string({variant_pairs}, '&') || '#f' AS canonical_variant FROM pages""",
        "fingerprint": f"""SELECT page_id, sha1('GET' || {_CANONICAL}) AS fp, sha1(sha1('GET' || {_CANONICAL}) ||
            '{{"url":"' || {_CANONICAL} || {_FRAGMENT} || '","wait":"1"}}') AS fp_options FROM pages""",
        "filter_domains": f"""SELECT page_id, url FROM pages
            WHERE regexp_matches({_HOST.format("url")}, '(^|[.])example[.](com|org)$')""",
        "filter_domains_table": f"""WITH hosts AS (SELECT page_id, url, {_HOST.format("url")} AS host FROM pages),
            domains AS (SELECT DISTINCT coalesce(nullif(regexp_extract(host, '([^.]*[.][^.]*[.][^.]*)$', 1), ''), host) AS d
                        FROM hosts WHERE page_id % 3 = 0)
            SELECT page_id, url FROM hosts SEMI JOIN domains ON host = d OR ends_with(host, '.' || d)""",
        "extract_listing": f"""WITH {_OCCURRENCES.replace(_ENCODE.format("raw"), "raw")}
            SELECT page_id, url, CAST(pos AS INTEGER) AS pos, abs_url, '' AS front_image_url FROM all_links""",
        "next_page": f"""SELECT page_id, url, {_ORIGIN} || regexp_extract_all(html, '<a href="([^"]*)"', 1)[-1]
            AS abs_url, true AS dont_filter FROM pages WHERE {_NAV_TEXT}[-1] = '{MARKER}'""",
        "select_nodes": f"""SELECT page_id, {_text("regexp_extract(html, '<title>([^<]*)</title>', 1)")}
            AS title, {_H1} AS h1, array_to_string({_NAV_TEXT}, '|') AS nav,
            regexp_extract_all(html, '<a href="([^"]*)"', 1)[2] AS second,
            {_text("""regexp_extract(html, '<div class="ad">([^<]*)</div>', 1)""")} AS ad,
            md5(regexp_extract(html, '(?s)<article>.*</article>')) AS content_md5 FROM pages""",
        "extract_articles": f"""SELECT page_id, {_H1} || '-xy' AS title, url, md5(url) AS url_object_id,
            '' AS front_image_url, CAST(0 AS BIGINT) AS praise_nums,
            coalesce(try_cast(regexp_extract(regexp_replace(regexp_extract(html, '<footer>([^<]*)', 1),
              '&[a-z]+;', '_', 'g'), '^.*?([0-9]+)', 1) AS BIGINT), 0) AS comment_nums,
            list_filter(list_transform({_NAV_TEXT}, lambda x: split_part(x, ',', 1)), lambda x: x <> '')[1] AS tags,
            md5(regexp_extract(html, '(?s)<article>.*</article>')) AS content_md5, '2000-01-01' AS create_date
            FROM pages WHERE regexp_matches(url, '[0-9]')""",
        "extract_jobs": """SELECT p_partkey AS page_id, p_name AS title,
            'http://jobs.example.com/jobs/' || p_partkey || '.html' AS url,
            md5('http://jobs.example.com/jobs/' || p_partkey || '.html') AS url_object_id,
            CAST(p_size AS BIGINT) * 1000 AS salary, p_type || ' ' AS job_city,
            p_size || '-' || (p_size + 10) || ' ' AS work_years, p_brand || ' ' AS degree_need, p_type AS job_type,
            p_size || ':02' AS publish_time, p_brand AS job_advantage, '<div><p>' || p_name || '</p></div>' AS job_desc,
            p_type || ' -' || p_brand AS job_addr, p_brand AS company_name, 'http://c.example.com/' || p_size
            AS company_url, p_brand || ',' || p_type AS tags, '2024-01-01 00:00:00' AS crawl_time FROM part""",
        "extract_table": """SELECT c_custkey AS page_id, pos, CASE pos WHEN 1 THEN c_name WHEN 2 THEN c_name || '-b'
            ELSE c_name || '-c' END AS ip, CASE pos WHEN 1 THEN c_custkey::VARCHAR WHEN 2 THEN '81' ELSE '82' END AS port,
            c_mktsegment AS proxy_type, CASE WHEN pos = 1 THEN c_acctbal END AS speed
            FROM customer, (VALUES (1), (2), (3)) r(pos)""",
        "append_endpoints": """SELECT CASE pos WHEN 1 THEN c_name WHEN 2 THEN c_name || '-b' ELSE c_name || '-c' END AS ip,
            CASE pos WHEN 1 THEN c_custkey::VARCHAR WHEN 2 THEN '81' ELSE '82' END AS port,
            CASE WHEN pos = 1 THEN c_acctbal END AS speed, 'HTTP' AS proxy_type
            FROM customer, (VALUES (1), (2), (3)) r(pos)""",
        "article_requests": """SELECT p_partkey AS page_id, 'http://list.example.com' || CASE n
              WHEN 1 THEN '/p/' || p_partkey || '.html' WHEN 2 THEN '/p/' || p_partkey || '-b.html'
              ELSE '/list/' || (p_partkey + 1) END AS url, CASE WHEN n < 3 THEN 'parse_detail' ELSE 'parse' END AS callback,
              n = 3 AS dont_filter, CASE n WHEN 1 THEN 'https://img.example.com/' || p_partkey || '.png' ELSE '' END
              AS front_image_url FROM part, (VALUES (1), (2), (3)) r(n)""",
        "article_crawl": f"""WITH details AS (SELECT *, 'http://list.example.com/p/' || p_partkey || ending AS url
              FROM part, (VALUES ('.html'), ('-b.html')) r(ending))
            SELECT p_name || '{TITLE_ENDING}' AS title, url, md5(url) AS url_object_id,
              CASE ending WHEN '.html' THEN 'https://img.example.com/' || p_partkey || '.png' ELSE '' END
              AS front_image_url, '' AS front_image_path, CAST(p_size AS BIGINT) AS praise_nums,
              p_partkey AS comment_nums, CAST(p_size AS BIGINT) AS fav_nums, p_brand AS tags,
              '<div id="cnblogs_post_body"><p>' || p_brand || '</p></div>' AS content, '2020-04-22' AS create_date
            FROM details""",
        "job_crawl": f"""WITH {_LINKS}, routed AS (SELECT page_id, pos, abs_url AS url, CASE
              WHEN regexp_matches(abs_url, '/[a-m][a-z]*$') THEN 'article'
              WHEN regexp_matches(abs_url, '%[0-9A-F]{{2}}') THEN 'escaped'
              WHEN regexp_matches(abs_url, 'https://.*') THEN 'other' END AS rule FROM links)
            SELECT url, rule, CASE WHEN rule = 'article' THEN sha1(sha1('GET' || url) || '{{"wait":"1"}}')
              ELSE sha1('GET' || url) END AS fp FROM routed WHERE rule IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id, pos) = 1""",
        "endpoint_crawl": """SELECT c_custkey AS page_id, CASE pos WHEN 1 THEN c_name WHEN 2 THEN c_name || '-b'
              ELSE c_name || '-c' END AS ip, CASE pos WHEN 1 THEN c_custkey::VARCHAR WHEN 2 THEN '81' ELSE '82' END AS port,
              c_acctbal AS speed FROM customer, (VALUES (1), (2), (3)) r(pos)
            WHERE NOT (pos = 1 AND NOT coalesce(c_acctbal > 0, false))""",
        "map_compose": """SELECT p_partkey, array_to_string(list_transform(list_filter(string_split(upper(p_name), ' '),
            lambda x: length(x) > 3), lambda x: x || '!'), '|') AS value FROM part""",
        "take_first": f"SELECT page_id, list_filter({_NAV}, lambda x: x <> '')[1] AS value FROM pages",
        "join_tags": f"""SELECT page_id, CASE WHEN len({_NAV}) > 0 THEN array_to_string({_NAV}, ',') END AS value
            FROM pages""",
        "append_suffix": f"SELECT p_partkey, p_name || '{TITLE_ENDING}' AS value FROM part",
        "parse_date_or": f"""SELECT o_orderkey, CAST(coalesce({parsed}, DATE '2000-01-01') AS VARCHAR) AS value,
            CASE WHEN {parsed} IS NULL THEN '2000-01-01' END AS parity_value FROM orders""",
        "first_int": r"""SELECT p_partkey,
            coalesce(try_cast(regexp_extract(p_brand, '^.*?(\d+)', 1) AS BIGINT), 0) AS brand,
            coalesce(try_cast(regexp_extract(p_name, '^.*?(\d+)', 1) AS BIGINT), 0) AS name,
            CAST(0 AS BIGINT) AS second_line FROM part""",
        "salary_floor": "SELECT p_partkey, CAST(p_size AS BIGINT) * 1000 AS salary, CAST(0 AS BIGINT) AS none FROM part",
        "first_token": "SELECT doc_id, md5(split_part(text, ',', 1)) AS value_md5 FROM documents",
        "remove_char": "SELECT page_id, replace(url, '/', '') AS value FROM pages",
        "split_once": """SELECT p_partkey, split_part(p_name, ' ', 1) AS value, p_name AS after_blank FROM part""",
        "strip_tags": """SELECT page_id, md5(t) AS text_md5, CAST(length(t) AS INTEGER) AS n_chars FROM (
            SELECT page_id, regexp_replace(html, '(?s)<!--.*?-->|</?[^ >/]+.*?>', '', 'g') AS t FROM pages)""",
        "clean_lines": f"""SELECT doc_id, md5(t) AS text_md5, CAST(length(t) AS INTEGER) AS n_chars FROM (
            SELECT doc_id, coalesce(array_to_string(list_filter(list_transform(string_split(text, chr(10)),
              lambda x: {trim}), lambda x: x <> '{DROP_LINE}'), ''), '') AS t FROM documents)""",
        "md5_id": "SELECT page_id, md5(url) AS url_object_id FROM pages",
        "number_before": f"""SELECT event_id, try_cast(split_part(CASE WHEN event_type = 'error' THEN 'abc'
            ELSE value::VARCHAR || '{SECONDS}' END, '{SECONDS}', 1) AS DOUBLE) AS speed FROM events""",
        "with_defaults": """SELECT c_custkey, coalesce(o_orderkey, 0) AS o_orderkey,
            coalesce(o_orderstatus, '') AS o_orderstatus,
            CAST(coalesce(CAST(o_orderdate AS DATE), DATE '1970-07-01') AS VARCHAR) AS o_orderdate
            FROM customer LEFT JOIN orders ON c_custkey = o_custkey""",
        "filter_html": "SELECT page_id, url FROM pages WHERE regexp_matches(html, '(?i)<html')",
        "url_has_digit": f"""WITH {_LINKS} SELECT page_id, abs_url FROM links
            WHERE regexp_matches(abs_url, '[0-9]')""",
        "split_valid": """SELECT page_id, CASE WHEN quality IS NULL THEN 'quality,toxic' WHEN quality = 1 THEN ''
            ELSE 'toxic' END AS missing FROM pages LEFT JOIN labels ON page_id = doc_id""",
        "filter_status_ok": """SELECT event_id, status FROM (SELECT event_id, CASE WHEN event_type <> 'error'
            THEN CAST(json_extract_string(props, '$.k') AS INTEGER) * 10 END AS status FROM events)
            WHERE status BETWEEN 200 AND 299""",
        "admit": _ADMIT,
        "admit_bloom": _ADMIT,
        "admit_bucketed": _ADMIT,
        "admit_stored": _RESUME,
        "seen_clear": f"""WITH {_REQUESTS}, keys AS (SELECT DISTINCT spider, fp FROM requests WHERE NOT dont_filter)
            SELECT spider, fp FROM keys WHERE spider <> (SELECT min(spider) FROM keys)""",
        "seen_compact": f"WITH {_REQUESTS} SELECT DISTINCT spider, fp FROM requests WHERE NOT dont_filter",
        "merge_seen": f"WITH {_SEEN} SELECT spider, fp FROM seen UNION SELECT spider, fp FROM fresh",
        "bloom_build": f"WITH {_BLOOM} SELECT block, {_WORDS} FROM bloom",
        "bloom_probe": f"""WITH {_LINKS}, {_BLOOM},
            keys AS (SELECT url FROM pages UNION ALL SELECT abs_url FROM links),
            probes AS (SELECT url, {_BLOCK}, {_MASKS} FROM keys)
            SELECT url, coalesce({" AND ".join(f"(w{i} & m{i}) <> 0" for i in range(8))}, false) AS maybe_seen
            FROM probes LEFT JOIN bloom USING (block)""",
        "merge_pending": f"""WITH {_FRONTIER} SELECT spider, request_key, arg_max_null(priority, seq) AS priority,
            min(seq) AS seq, arg_min_null("at", seq) AS "at" FROM frontier GROUP BY spider, request_key""",
        "batch_fifo": _batch("seq", "<="),
        "batch_lifo": _batch("seq DESC", "<="),
        "batch_priority": _batch("priority DESC, seq", "<="),
        "batch_cut": _batch("priority DESC, seq", "<="),
        "batch_cut_rest": _batch("priority DESC, seq", ">"),
        "batch_large": _batch("priority DESC, seq", "<=", 5000),
        "batch_rest": _batch("priority DESC, seq", ">"),
        "pending_count": f"WITH {_FRONTIER} SELECT spider, count(*) AS pending FROM frontier GROUP BY spider",
        "plan_fetch": _plan(),
        "plan_fetch_split": _plan(),
        "carry_meta": f"""WITH {_REQUESTS},
            listing AS (SELECT fp, first(CASE WHEN priority = 0 THEN '' ELSE url || '.png' END ORDER BY page_id, pos) AS image
                        FROM requests GROUP BY fp)
            SELECT page_id, fp, CASE WHEN image <> '' THEN image END AS front_image_url
            FROM (SELECT page_id, sha1('GET' || {_ORIGIN} || '/the') AS fp FROM pages) LEFT JOIN listing USING (fp)""",
        "attach_image_path": """SELECT doc_id AS url, CASE WHEN lang = 'en' THEN coalesce(path, '') ELSE source END
            AS front_image_path FROM documents LEFT JOIN (SELECT doc_id, arg_max_null('full/' || doc_id || '-' || toxic,
            toxic) AS path FROM labels WHERE quality = 1 GROUP BY doc_id) USING (doc_id)""",
        "prune_failed": """SELECT doc_id AS ip, source FROM documents ANTI JOIN
            (SELECT doc_id FROM labels WHERE NOT (toxic = 0 AND quality = 1)) USING (doc_id)""",
        "assign_member": """WITH pool AS (SELECT row_number() OVER (ORDER BY n_nationkey) - 1 AS pick, n_name FROM nation)
            SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'own' ELSE n_name END AS agent
            FROM (SELECT *, ('0x' || substr(md5(c_custkey || '|7'), 1, 8))::BIGINT % (SELECT count(*) FROM nation) AS pick
                  FROM customer) JOIN pool USING (pick)""",
        "assign_live": """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'own' ELSE (
              SELECT arg_max(n_name, md5(c_custkey || '|7|' || n_name)) FROM nation WHERE n_nationkey % 4 <> 0) END AS agent
            FROM customer""",
        "assign_live_grouped": """WITH pool AS (
              SELECT n_name, ('0x' || substr(md5(n_name), 1, 8))::BIGINT % 5 AS grp FROM nation WHERE n_nationkey % 4 <> 0),
            grps AS (SELECT DISTINCT grp FROM pool),
            chosen AS (SELECT c_custkey, c_mktsegment, arg_max(grp, md5(c_custkey || '|7|group ' || grp)) AS grp
                       FROM customer, grps GROUP BY 1, 2)
            SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'own'
                   ELSE arg_max(n_name, md5(c_custkey || '|7|' || n_name)) END AS agent
            FROM chosen JOIN pool USING (grp) GROUP BY c_custkey, c_mktsegment""",
        "crawl_stats": """SELECT event_type AS spider, CASE WHEN value > 10 THEN 'admitted' ELSE 'filtered' END AS outcome,
            count(*) AS n FROM events GROUP BY ALL""",
        "carry_forward": _carry(),
        "carry_forward_split": _carry(),
        "json_roundtrip": "SELECT * FROM part",
        "item_feed": "SELECT 'parts:items' AS key, p_partkey, p_name, p_size, p_retailprice FROM part",
        "item_feed_custom": "SELECT 'parts:items' AS key, p_partkey || '|' || p_name AS value FROM part",
        "compact_changes": """WITH rows AS (SELECT event_id, user_id, event_type, props,
              CASE WHEN event_type <> 'error' THEN value END AS value FROM events)
            SELECT user_id, arg_min_null(event_type, event_id) AS event_type, arg_min_null(props, event_id) AS props,
                   arg_max_null(value, event_id) AS value FROM rows GROUP BY user_id""",
        "upsert_articles": _upsert(["value"]),
        "upsert_jobs": _upsert(["value", "props"]),
        "stream_pages": "SELECT page_id, url, md5(html) AS html_md5 FROM pages",
        "stream_admit": f"WITH {_REQUESTS} SELECT DISTINCT spider, fp FROM requests",
        "stream_admit_batches": f"""WITH {_REQUESTS}
            SELECT page_id, pos, spider, url, fp, dont_filter FROM requests WHERE NOT dont_filter
            QUALIFY row_number() OVER (PARTITION BY spider, fp ORDER BY page_id, pos) = 1
            UNION ALL SELECT page_id, pos, spider, url, fp, dont_filter FROM requests WHERE dont_filter""",
        "resume": _RESUME,
        "stream_admit_state": f"""WITH {_REQUESTS}
            SELECT page_id, pos, spider, url, fp, dont_filter FROM requests WHERE NOT dont_filter
            QUALIFY row_number() OVER (PARTITION BY spider, fp ORDER BY page_id, pos) = 1
            UNION ALL SELECT page_id, pos, spider, url, fp, dont_filter FROM requests WHERE dont_filter""",
        "stream_stats": f"""WITH asked AS (
              WITH {_REQUESTS} SELECT CAST(page_id % 2 AS INTEGER) AS batch_id, count(*) AS n FROM requests GROUP BY 1),
            passed AS (SELECT CAST(page_id % 2 AS INTEGER) AS batch_id, spider, count(*) AS n FROM ({_RESUME}) GROUP BY 1, 2),
            sums AS (SELECT batch_id, CAST(sum(n) AS BIGINT) AS n, CAST(sum(least(n, 5)) AS BIGINT) AS popped
                     FROM passed GROUP BY 1)
            SELECT batch_id, 'enqueued' AS outcome, n FROM sums
            UNION ALL SELECT batch_id, 'filtered', asked.n - sums.n FROM asked JOIN sums USING (batch_id)
            UNION ALL SELECT batch_id, 'dequeued', popped FROM sums""",
        "stream_seeds": """SELECT o_orderkey AS seq, 'http://seed.example.com/' || o_custkey AS url, true AS dont_filter
            FROM orders""",
        "stream_load": f"""WITH items AS (SELECT page_id, url, md5(url) AS url_object_id, {_H1} AS title,
              {_NAV_TEXT}[6] AS tags FROM pages)
            SELECT arg_min_null(url, page_id) AS url, url_object_id, arg_max_null(title, page_id) AS title,
              arg_min_null(tags, page_id) AS tags FROM items WHERE tags <> '' AND title <> '' GROUP BY url_object_id""",
    }
