"""URL expressions: search URLs, page frontier, resolution, request blocking."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import _col

# Fixed values of the search URL.
SEARCH_PATH = "/s?k="
SEARCH_SUFFIX = "&ref=nb_sb_noss"

# Fixed values of the request filter.
BLOCKED_TYPES = ["media", "audio"]
BLOCKED_EXTENSIONS = [".mp4", ".m3u8", ".webm", ".mov", ".avi", ".flv"]
BLOCKED_DOMAINS = [
    "doubleclick.net",
    "google-analytics.com",
    "googletagmanager.com",
    "adsystem.com",
    "amazon-adsystem.com",
    "facebook.net",
]


def form_encode(c: Column | str) -> Column:
    """Form encoding with ``~`` kept and ``*`` escaped, the other way round from Java's."""
    return F.replace(F.replace(F.url_encode(_col(c)), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def search_url_of(base: Column | str, encoded_query: Column | str) -> Column:
    return F.concat(_col(base), F.lit(SEARCH_PATH), _col(encoded_query), F.lit(SEARCH_SUFFIX))


def search_url(base: Column | str, query: Column | str) -> Column:
    return search_url_of(base, form_encode(query))


def is_blocked(
    url: Column | str,
    resource_type: Column | str | None = None,
    extensions: list[str] = BLOCKED_EXTENSIONS,
    domains: list[str] = BLOCKED_DOMAINS,
    types: list[str] = BLOCKED_TYPES,
) -> Column:
    """Media requests: by resource type, by the end of the URL, or by a domain inside it."""
    url = _col(url)
    hit = F.lit(False)
    for ext in extensions:
        hit = hit | url.endswith(ext)
    for domain in domains:
        hit = hit | url.contains(domain)
    if resource_type is not None:
        hit = F.coalesce(_col(resource_type).isin(types), F.lit(False)) | hit
    return hit


# One expression splits a URL reference: scheme, authority, path, query, fragment.
_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"
_QUERY = r"^[^?#]*\?([^#]*)"
_FRAGMENT = r"#(?s)(.*)$"

# Schemes whose references resolve against a base; any other reference stands alone.
_HIERARCHICAL = ["http", "https", "ftp", "file"]


def _part(c: Column, pattern: str) -> Column:
    return F.regexp_extract(c, pattern, 1)


def _walk(path: Column, rooted: Column) -> Column:
    """Resolve ``.`` and ``..``; a merged path also loses its empty inner segments."""
    raw = F.split(path, "/", -1)
    last = F.element_at(raw, -1)
    merged = F.filter(raw, lambda s, i: (s != "") | (i == 0) | (i == F.size(raw) - 1))
    kept = F.aggregate(
        F.when(rooted, raw).otherwise(merged),
        F.array().cast("array<string>"),
        lambda done, s: F.when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .when(s == ".", done)
        .otherwise(F.concat(done, F.array(s))),
    )
    closed = F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    joined = F.array_join(closed, "/")
    return F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))


# References that resolve without taking anything apart: a rooted path, or a whole web
# address; no blanks or control characters, no empty query or fragment.
_TAIL = r"[^\x00-\x20?#]*(?:\?[^\x00-\x20#]+)?(?:#[^\x00-\x20]+)?\z"
_ROOTED = rf"^/(?!/){_TAIL}"
_WEB = rf"^https?://[^\x00-\x20/?#]{_TAIL}"
_ORIGIN = r"^(https?://[^/?#]+)"


def resolve_url(base: Column | str, href: Column | str) -> Column:
    """``href`` as an absolute URL against ``base``.

    Nearly all references of a page are rooted paths or whole addresses: one pattern each.
    The others are split into their parts and resolved segment by segment.
    """
    base, href = _col(base), _col(href)
    origin = _part(base, _ORIGIN)
    rooted = href.rlike(_ROOTED) & ~href.contains("/.") & (origin != "")
    return (
        F.when(rooted, F.concat(origin, href)).when(href.rlike(_WEB), href).otherwise(_resolve_parts(base, href))
    )


def _resolve_parts(base: Column, href: Column) -> Column:
    ref = F.regexp_replace(F.regexp_replace(href, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    return _once(ref, lambda r: _once(_parts(r), lambda own: _once(_parts(base), lambda b: _joined(base, href, r, b, own))))


def _once(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _parts(c: Column) -> Column:
    return F.struct(
        F.lower(_part(c, _SCHEME)).alias("scheme"),
        _part(c, _AUTHORITY).alias("authority"),
        _part(c, _PATH).alias("path"),
        _part(c, _QUERY).alias("query"),
        _part(c, _FRAGMENT).alias("fragment"),
    )


def _led(mark: str, c: Column) -> Column:
    return F.when(c != "", F.concat(F.lit(mark), c)).otherwise(F.lit(""))


def _joined(base: Column, href: Column, ref: Column, b: Column, own: Column) -> Column:
    scheme, path = own["scheme"], own["path"]
    origin = F.concat(b["scheme"], F.lit("://"), b["authority"])
    query, fragment = _led("?", own["query"]), _led("#", own["fragment"])

    # A reference without a path keeps the base path, and the base query unless it has one.
    kept_query = F.when(own["query"] != "", query).otherwise(_led("?", b["query"]))
    same_document = F.concat(origin, b["path"], kept_query, fragment)

    directory = F.regexp_replace(b["path"], r"[^/]*$", "")
    rooted = path.startswith("/")
    merged = F.when(rooted, path).otherwise(F.concat(F.when(directory == "", F.lit("/")).otherwise(directory), path))
    relative = F.concat(origin, _once(merged, lambda m: _walk(m, rooted)), query, fragment)

    network = F.concat(b["scheme"], F.lit("://"), own["authority"], path, query, fragment)

    return (
        F.when(ref == "", base)
        .when(base == "", href)
        .when((scheme != "") & ((scheme != b["scheme"]) | ~scheme.isin(_HIERARCHICAL)), href)
        .when(own["authority"] != "", network)
        .when(path == "", same_document)
        .otherwise(relative)
    )
