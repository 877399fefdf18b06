"""URL functions as native expressions.

Arguments are SQL expressions (most often a column name), results are columns;
the expressions are composed as text and parsed once. The frequent case of each
function is tested first and costs a few string operations; the folds over
segments and escapes run only for the URLs that need them.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that stay as they are in a URL (RFC 3986 reserved
# and unreserved characters, "|" and "%").
RESERVED = ":/?#[]@!$&'()*+,;=|%"


def _lit(text: str) -> str:
    """A string literal in SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_HAS_HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://"
_NEEDS_ENCODING = r"[^A-Za-z0-9\-._~:/?#\[\]@!$&'()*+,;=|%]"
_PATH_LITERAL = r"^[A-Za-z0-9\-._~:\[\]@!$&'()*+,;=|%]$"
_QUERY_LITERAL = r"^[A-Za-z0-9\-._~]$"
# A URL that is canonical but for the order of its query and its fragment.
# Possessive repeats keep the match linear and without recursion.
_PAIR = r"[A-Za-z0-9\-._~]++=[A-Za-z0-9\-._~]*+"
_PATH_RUN = r"[A-Za-z0-9\-._~:/@!$&'()*+,;=|\[\]]*+"
_CLEAN_URL = (r"(?s)^[a-z][a-z0-9+.\-]*+://[a-z0-9.\-]++(?::[0-9]++)?+"
              rf"/{_PATH_RUN}(?:%[89A-F][0-9A-F]{_PATH_RUN})*+(?:\?{_PAIR}(?:&{_PAIR})*+)?+")


def _extract(c: str, pattern: str) -> str:
    return f"regexp_extract({c}, {_lit(pattern)}, 1)"


def _matches(c: str, pattern: str) -> str:
    return f"({c}) RLIKE {_lit(pattern)}"


def _encode_except(c: str, keep: str) -> str:
    """Percent-encode as UTF-8, leaving letters, digits and `keep` alone."""
    # "%" last: it may only be restored once no other escape is left to restore.
    kept = [ch for ch in keep + "~" if ch not in "-._*%"] + ["%"] * ("%" in keep)
    codes = ", ".join(f"struct('%{ord(ch):02X}' AS code, char({ord(ch)}) AS ch)" for ch in kept)
    return (f"aggregate(array({codes}), replace(url_encode({c}), '+', '%20'), "
            "(text, r) -> replace(text, r.code, r.ch))")


def safe_url_sql(c: str) -> str:
    return f"CASE WHEN {_matches(c, _NEEDS_ENCODING)} THEN {_encode_except(c, RESERVED)} ELSE {c} END"


def safe_url(c: str) -> Column:
    """Percent-encode the characters a URL may not contain; keep the rest."""
    return F.expr(safe_url_sql(c))


def fix_scheme(c: Column) -> Column:
    """`//host/x` becomes `https://host/x`; anything else is unchanged."""
    return F.when(F.startswith(c, F.lit("//")), F.concat(F.lit("https:"), c)).otherwise(c)


def _origin(c: str) -> str:
    return _extract(c, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)")


def url_origin(c: str) -> Column:
    return F.expr(_origin(c))


def url_host(c: str) -> Column:
    """Host in lower case without user info and port."""
    return F.expr("lower(" + _extract(c, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)") + ")")


def _path(c: str) -> str:
    return _extract(c, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)")


def url_path(c: str) -> Column:
    return F.expr(_path(c))


@dataclass(frozen=True)
class BaseUrl:
    """The pieces of a base URL that resolving needs, as SQL expressions."""

    url: str
    scheme: str
    origin: str
    path: str
    query: str
    folder: str

    @staticmethod
    def of(base: str) -> "BaseUrl":
        folder = _extract(base, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*/)")
        return BaseUrl(url=base, scheme=_extract(base, _SCHEME), origin=_origin(base), path=_path(base),
                       query=_extract(base, r"^[^?#]*(\?[^#]+)"), folder=f"coalesce(nullif({folder}, ''), '/')")

    def columns(self, prefix: str) -> list[Column]:
        """The pieces as columns, to compute them once per row."""
        return [F.expr(getattr(self, f.name)).alias(prefix + f.name) for f in fields(self)]

    @staticmethod
    def from_columns(prefix: str) -> "BaseUrl":
        return BaseUrl(**{f.name: prefix + f.name for f in fields(BaseUrl)})


def _fold_dots(path: str) -> str:
    """Apply `.` and `..` segments of an absolute path."""
    folded = (f"aggregate(split({path}, '/'), CAST(array() AS ARRAY<STRING>), (kept, seg) -> "
              "CASE WHEN seg = '..' THEN slice(kept, 1, greatest(size(kept) - 1, 0)) WHEN seg = '.' THEN kept "
              "ELSE array_append(kept, seg) END, kept -> array_join(kept, '/'))")
    folded = f"concat('/', regexp_replace({folded}, '^/', ''))"
    ends_in_dots = _matches(path, r"/\.\.?$")
    return f"CASE WHEN {ends_in_dots} THEN concat(regexp_replace({folded}, '/$', ''), '/') ELSE {folded} END"


def resolve_sql(base: BaseUrl, href: str) -> str:
    # Most links need no more than these tests.
    plain = "NOT " + _matches(href, r"[?#]$|\?#|/\.")
    rooted = f"startswith({href}, '/') AND NOT startswith({href}, '//')"
    below = _matches(href, r"^[^/?#.:][^?#:]*(?:[?#]|$)") + f" AND NOT contains({href}, '//')"
    below += " AND NOT " + _matches(base.folder, r"/\.|//")
    return f"""CASE WHEN {rooted} AND {plain} THEN concat({base.origin}, {href})
        WHEN {below} AND {plain} THEN concat({base.origin}, {base.folder}, {href})
        WHEN {_matches(href, "^[a-z][a-z0-9+.-]*://")} AND {plain} THEN {href}
        WHEN {href} = '' THEN {base.url}
        ELSE {_resolve_any(base, href)} END"""


def _resolve_any(base: BaseUrl, href: str) -> str:
    scheme = _extract(href, _SCHEME)
    has_host = _matches(href, _HAS_HOST)
    # A link that repeats the scheme of the base without a host is relative.
    same = f"({scheme} <> '' AND lower({scheme}) = lower({base.scheme}))"
    rel = f"CASE WHEN {same} AND NOT {has_host} THEN substring({href}, length({scheme}) + 2) ELSE {href} END"
    # An empty query or fragment mark is dropped.
    rel = f"regexp_replace(regexp_replace({rel}, '#$', ''), {_lit('[?](#|$)')}, '$1')"
    path = "split_part(split_part(rel, '#', 1), '?', 1)"
    tail = f"substring(rel, length({path}) + 1)"
    joined = f"CASE WHEN startswith(rel, '/') THEN {path} ELSE regexp_replace(concat({base.folder}, {path}), '/+', '/') END"
    dotted = _matches("path", r"(^|/)\.\.?(/|$)")
    folded = f"transform(array({joined}), path -> CASE WHEN {dotted} THEN {_fold_dots('path')} ELSE path END)[0]"
    relative = f"""CASE WHEN startswith(rel, '//') THEN concat({base.scheme}, ':', rel)
        WHEN startswith(rel, '?') THEN concat({base.origin}, {base.path}, rel)
        WHEN rel = '' OR startswith(rel, '#') THEN concat({base.origin}, {base.path}, {base.query}, rel)
        ELSE concat({base.origin}, {folded}, {tail}) END"""
    return f"""CASE WHEN {scheme} <> '' AND NOT {same} THEN {href}
        WHEN {has_host} THEN concat(lower({scheme}), substring({rel}, length({scheme}) + 1))
        ELSE transform(array({rel}), rel -> {relative})[0] END"""


def resolve_url(base: str, href: str) -> Column:
    """Absolute URL of `href` seen from the page `base`; null if either is null."""
    return F.expr(resolve_sql(BaseUrl.of(base), href))


def base_from_tag(url: str, tag: str) -> Column:
    """Base URL of a page and its base tag, if any. Dot segments are left to `resolve_sql`."""
    page = BaseUrl.of(url)
    return F.expr(f"""CASE WHEN {tag} = '' THEN {url} WHEN {_matches(tag, _HAS_HOST)} THEN {tag}
        WHEN startswith({tag}, '//') THEN concat({page.scheme}, ':', {tag})
        WHEN startswith({tag}, '/') THEN concat({page.origin}, {tag})
        ELSE concat({page.origin}, {page.folder}, {tag}) END""")


def _recode(text: str, literal: str, raw, also_escaped: str, stray: str, space: str) -> str:
    """One spelling per text: needless escapes decoded, needed ones in capitals.

    The pieces between the percent signs are handled one by one; `raw` encodes the
    plain text in them, `stray` stands for a percent sign that starts no escape.
    """
    rest = raw("substring(p, 3)")
    code = "upper(substring(p, 1, 2))"
    char = f"decode(unhex({code}), 'ISO-8859-1')"
    piece = f"""CASE WHEN i = 0 THEN {raw("p")}
        WHEN NOT {_matches("p", "^[0-9A-Fa-f]{2}")} THEN concat('{stray}', {raw("p")})
        WHEN {code} = '20' THEN concat('{space}', {rest})
        WHEN {_matches(char, literal)} AND {code} NOT IN ({also_escaped}) THEN concat({char}, {rest})
        ELSE concat('%', {code}, {rest}) END"""
    return (f"CASE WHEN contains({text}, '%') THEN array_join(transform(split({text}, '%', -1), (p, i) -> {piece}), '') "
            f"ELSE {raw(text)} END")


def _form_text(c: str) -> str:
    encoded = _encode_except(f"replace({c}, '+', ' ')", "")
    return f"replace(replace({encoded}, '*', '%2A'), '%20', '+')"


def _canonical_query(query: str) -> str:
    """Pairs sorted by decoded key and value, each re-encoded as a form field."""
    def decoded(c: str) -> str:
        return f"try_url_decode(regexp_replace({c}, {_lit('%(?![0-9A-Fa-f]{2})')}, '%25'))"

    def recoded(c: str) -> str:
        return _recode(c, _QUERY_LITERAL, _form_text, "''", "%25", "+")

    k, v = "substring_index(pair, '=', 1)", "substring(pair, length(substring_index(pair, '=', 1)) + 2)"
    fields_ = (f"transform(array(struct({k} AS k, {v} AS v)), f -> struct({decoded('f.k')} AS dk, {decoded('f.v')} AS dv, "
               f"concat({recoded('f.k')}, '=', {recoded('f.v')}) AS kv))[0]")
    pairs = f"transform(filter(split({query}, '&'), pair -> pair <> ''), pair -> {fields_})"
    return f"array_join(transform(sort_array({pairs}), pair -> pair.kv), '&')"


def canonical_sql(c: str, keep_fragments: bool = False) -> str:
    # Without needless escapes only the pairs are to be sorted; the lowest character
    # in place of "=" makes the order of the texts that of the pairs.
    bare = f"substring_index({c}, '#', 1)"
    pairs = f"translate(substring_index({bare}, '?', -1), '=', '\\u0001')"
    pairs = f"translate(array_join(sort_array(split({pairs}, '&')), '&'), '\\u0001', '=')"
    clean = _matches(c, _CLEAN_URL + ("$" if keep_fragments else "(?:#.*)?$"))
    return f"""CASE WHEN {clean} THEN CASE WHEN contains({bare}, '?')
        THEN concat(substring_index({bare}, '?', 1), '?', {pairs}) ELSE {bare} END
        ELSE {_canonical_any(c, keep_fragments)} END"""


def _canonical_any(c: str, keep_fragments: bool) -> str:
    head = _extract(c, r"^((?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?)")
    body = f"substring({c}, length({head}) + 1)"

    def raw(text: str) -> str:
        return f"CASE WHEN {_matches(text, _NEEDS_ENCODING)} THEN {_encode_except(text, RESERVED)} ELSE {text} END"

    path = _extract("body", "^([^?#]*)")
    path = f"""coalesce(nullif(transform(array({path}),
        path -> {_recode("path", _PATH_LITERAL, raw, "'2F', '3F'", "%", "%20")})[0], ''), '/')"""
    query = _extract("body", "^[^?#]*[?]([^#]*)")
    query = f"""transform(array({query}), query -> CASE WHEN query = '' THEN '' ELSE {_canonical_query("query")} END)[0]"""
    query = f"coalesce(concat('?', nullif({query}, '')), '')"
    parts = [path, query]
    if keep_fragments:
        fragment = f"nullif({_extract('body', '(?s)#(.+)$')}, '')"
        parts.append(f"coalesce(concat('#', {safe_url_sql(fragment)}), '')")
    host = f"regexp_replace(lower({head}), '(//.*?):+$', '$1')"
    return f"concat({host}, transform(array({body}), body -> concat({', '.join(parts)}))[0])"


def canonical_url(c: str, keep_fragments: bool = False) -> Column:
    """One spelling per resource: host in lower case, query sorted, escapes normalised."""
    return F.expr(canonical_sql(c, keep_fragments))


def request_fingerprint(url: str, method: str | None = None, body: str | None = None,
                        options: str | None = None) -> Column:
    """SHA-1 of method, canonical URL and body; render options are folded in when present."""
    method = "'GET'" if method is None else f"coalesce(upper({method}), 'GET')"
    body = "''" if body is None else f"coalesce({body}, '')"
    plain = f"sha1(concat({method}, {canonical_sql(url)}, {body}))"
    if options is None:
        return F.expr(plain)
    target = f"transform_values({options}, (k, v) -> CASE WHEN k = 'url' THEN {canonical_sql('v', True)} ELSE v END)"
    ordered = f"to_json(map_from_entries(sort_array(map_entries({target}))))"
    return F.expr(f"CASE WHEN {options} IS NULL OR cardinality({options}) = 0 THEN {plain} "
                  f"ELSE sha1(concat({plain}, {ordered})) END")
