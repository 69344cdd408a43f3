"""Captured HTML and URLs as Columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Query parameters that only track visitors.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid")
_NAMED = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "))


def decode_entities(c: Column) -> Column:
    """Named and numeric entities; the ampersand last, so nothing is decoded twice."""
    for coded, raw in _NAMED:
        c = F.replace(c, F.lit(coded), F.lit(raw))
    point = lambda n: F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    valid = lambda n: n.isNotNull() & (n > 0) & (n < 0x110000) & ~n.between(0xD800, 0xDFFF)
    for pattern, base in ((r"&#([0-9]{1,7});", 10), (r"&#[xX]([0-9a-fA-F]{1,6});", 16)):
        marks = F.array_distinct(F.regexp_extract_all(c, F.lit(pattern), F.lit(1)))
        head = "&#" if base == 10 else "&#x"
        number = lambda m: F.conv(m, base, 10).cast("long")  # noqa: B023, E731
        swap = lambda text, m: F.when(valid(number(m)), F.replace(text, F.concat(F.lit(head), m, F.lit(";")), point(number(m)))).otherwise(text)  # noqa: B023, E731
        c = F.aggregate(marks, c, swap)
    return F.replace(c, F.lit("&amp;"), F.lit("&"))


def clean_text(c: Column) -> Column:
    """Script and style blocks and tags dropped, then entities decoded, white space collapsed."""
    c = F.regexp_replace(c, r"(?is)<(script|style)\b[^>]*>.*?</(script|style)\s*>", " ")
    c = F.regexp_replace(c, r"(?s)<[^>]+>", " ")
    return F.btrim(F.regexp_replace(decode_entities(c), r"\s+", " "))


def bare_text(c: Column) -> Column:
    """Tags dropped, white space of ASCII collapsed; the ampersand is the only entity decoded, all others stay as written."""
    c = F.regexp_replace(c, "<[^>]+>", " ")
    return F.replace(F.btrim(F.regexp_replace(c, r"[ \t\n\f\r]+", " ")), F.lit("&amp;"), F.lit("&"))


def tag_text(html: Column, tag: str, clean: Callable[[Column], Column] = clean_text) -> Column:
    return clean(F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1))


def attribute(tag: Column, name: str) -> Column:
    """Value between a pair of equal quotes, entities decoded."""
    return decode_entities(F.regexp_extract(tag, rf"""(?is)\b{name}\s*=\s*(["'])(.*?)\1""", 2))


def meta_content(html: Column, key: str) -> Column:
    tag = F.regexp_extract(html, rf"""(?is)<meta\b[^>]*(?:name|property)\s*=\s*["']{key}["'][^>]*>""", 0)
    return attribute(tag, "content")


def link_rel(html: Column, rel: str) -> Column:
    return attribute(F.regexp_extract(html, rf"""(?is)<link\b[^>]*rel\s*=\s*["']{rel}["'][^>]*>""", 0), "href")


def anchors(html: Column) -> Column:
    """All anchor elements that have an address."""
    return F.regexp_extract_all(html, F.lit(r"(?is)<a\b[^>]*\bhref\s*=[^>]*>.*?</a\s*>"), F.lit(0))


def is_login_page(html: Column) -> Column:
    """A password input, or a form whose tag speaks of logging in."""
    return html.rlike(r"""(?i)<input\b[^>]*type\s*=\s*["']password["']""") | html.rlike(r"(?i)<form\b[^>]*(login|signin|masuk)")


def redact(message: Column, most: int = 240) -> Column:
    """Diagnostics without addresses, secrets, tags and control characters."""
    for pattern, mark in (
        (r"(?i)https?://\S+", "[url]"),
        (r"(?i)bearer\s+\S+", "[token]"),
        (r"(?i)(password|secret|token|api[_-]?key)\s*[:=]\s*\S+", "$1=[redacted]"),
        (r"(?s)<[^>]*>", " "),
        (r"[\x00-\x1f\x7f]+", " "),
    ):
        message = F.regexp_replace(message, pattern, mark)
    return F.substring(F.btrim(F.regexp_replace(message, r"\s+", " ")), 1, most)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def normalize_url(url: Column) -> Column:
    """No fragment and tracking parameters, lower host, single slashes, no trailing slash, sorted parameters."""
    scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    route = F.regexp_replace(F.regexp_replace(path(url), "/+", "/"), "/+$", "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(F.substring_index(p, "=", 1)).isin(*TRACKING)))
    return F.when(scheme == "", F.lit("")).otherwise(
        F.concat(scheme, F.lit("://"), host(url), route, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))
    )


def resolve_url(link: Column, base: Column) -> Column:
    """Absolute form of a link on a page, without fragment; dot segments stay as they are."""
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_replace(base, "[?#].*$", "")
    folder = F.when(path(base) == "", F.concat(origin, F.lit("/"))).otherwise(F.regexp_replace(page, "[^/]*$", ""))
    link = F.regexp_replace(F.btrim(link), "#.*$", "")
    return (
        F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(F.regexp_extract(base, "^([A-Za-z]+:)", 1), link))
        .when(link.startswith("/"), F.concat(origin, link))
        .when(link == "", F.regexp_replace(base, "#.*$", ""))
        .when(link.startswith("?"), F.concat(page, link))
        .otherwise(F.concat(folder, link))
    )


def is_allowed_url(url: Column, hosts, prefix: str = "/") -> Column:
    return url.startswith("https://") & host(url).isin(*hosts) & F.when(path(url) == "", F.lit("/")).otherwise(path(url)).startswith(prefix)


def is_traceable(source: Column, link: Column) -> Column:
    return F.coalesce((F.btrim(source) != "") & link.rlike(r"(?i)^https?://\S+$"), F.lit(False))
