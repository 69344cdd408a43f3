"""Captured pages of official sources: listings, details, records, their checks and the state of a source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headwater.functions import dates, html, ids
from headwater.functions.text import has_text

#: Error codes by the state that they put a source in; any other code makes it UNAVAILABLE.
BLOCKING = ("HTTP_401", "HTTP_403", "HTTP_429", "ROBOTS_BLOCKED", "ROBOTS_DISALLOWED", "LOGIN_REQUIRED")
EMPTY = ("LISTING_PARSE_EMPTY", "DETAIL_PARSE_EMPTY")


def listing_links(pages: DataFrame, host_name: Column, prefix: str = "/", detail: str = "/", title_tag: str = "h3", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """One row per anchor of a listing that has an address: page columns, pos, link, is_external, is_record, title, published_text, evidence.

    A record is a link on the source's own host over https, below the allowed and the detail prefix, that is not the
    listing itself. Anchors keep their order; null pages give no rows.
    """
    keep = [c for c in pages.columns if c != html_col]
    a = pages.select(*keep, host_name.alias("__host"), F.posexplode(html.anchors(F.col(html_col))).alias("pos", "a"))
    a = a.withColumn("link", html.resolve_url(html.attribute(F.col("a"), "href"), F.col(url_col))).where("link IS NOT NULL")
    own = F.col("link").startswith("https://") & (html.host(F.col("link")) == F.col("__host"))
    route = F.when(html.path(F.col("link")) == "", F.lit("/")).otherwise(html.path(F.col("link")))
    inner = F.regexp_extract("a", r"(?is)^<a\b[^>]*>(.*)</a\s*>$", 1)
    titled = html.clean_text(F.when(inner.rlike(rf"(?i)<{title_tag}\b"), F.regexp_extract(inner, rf"(?is)<{title_tag}\b[^>]*>(.*?)</{title_tag}>", 1)).otherwise(inner))
    title = F.btrim(F.regexp_replace(F.regexp_replace(titled, r"^\d{1,2}\s+[A-Za-z]+\s+20\d{2}\s+", ""), r"(?i)\s+Unduh$", ""))
    dated = F.regexp_extract(inner, r"""(?is)<[^>]*class\s*=\s*["'][^"']*\bdate\b[^"']*["'][^>]*>(.*?)</[^>]+>""", 1)
    return a.select(
        *keep, "pos", "link", (~own).alias("is_external"),
        (own & route.startswith(prefix) & route.startswith(detail) & (route != html.path(F.col(url_col)))).alias("is_record"),
        title.alias("title"), html.clean_text(dated).alias("published_text"), F.substring(html.clean_text(inner), 1, 500).alias("evidence"),
    )


def listing_records(links: DataFrame, page: str) -> DataFrame:
    """The records of each listing, every link once, at its first place."""
    first = F.row_number().over(Window.partitionBy(page, "link").orderBy("pos"))
    return links.where("is_record").withColumn("__n", first).where("__n = 1").drop("__n")


def detail_fields(
    page: Column, url: Column, title_tag: str = "h1", excerpt_meta: str = "description", rel: str = "canonical", clean: Callable[[Column], Column] = html.clean_text
) -> Column:
    """Struct of title, canonical_url and excerpt. Without a heading the document's title serves, less what stands before its first dash.

    ``clean`` makes the title's text of its HTML. A page without a canonical link is found under its own address.
    """
    headed = page.rlike(rf"(?is)<{title_tag}\b[^>]*>.*?</{title_tag}\s*>")
    whole = html.tag_text(page, "title", clean)
    rest = F.when(F.contains(whole, F.lit(" - ")), F.btrim(F.substring(whole, F.locate(" - ", whole) + 3, F.length(whole)))).otherwise(whole)
    link = html.link_rel(page, rel)
    canonical = F.when(has_text(link), html.resolve_url(link, url)).otherwise(F.regexp_replace(url, "#.*$", ""))
    excerpt = F.coalesce(F.substring(html.clean_text(html.meta_content(page, excerpt_meta)), 1, 500), F.lit(""))
    return F.struct(F.when(headed, html.tag_text(page, title_tag, clean)).otherwise(rest).alias("title"), canonical.alias("canonical_url"), excerpt.alias("excerpt"))


def official_record(df: DataFrame, code: Column, host_name: Column, prefix: str = "/") -> DataFrame:
    """Append id, published_at, the quality states and content_hash to rows of title, link, excerpt and published_text."""
    day = dates.public_date(F.col("published_text"))
    out = df.withColumn("__day", day).withColumn("published_at", F.col("__day.value")).withColumn("date_status", F.col("__day.status")).drop("__day")
    allowed = F.col("link").startswith("https://") & (html.host(F.col("link")) == host_name) & html.path(F.col("link")).startswith(prefix)
    return (
        out.withColumn("id", ids.source_id(code, F.col("link"), F.col("title")))
        .withColumn("title_valid", F.length("title") >= 8)
        .withColumn("link_valid", F.coalesce(allowed, F.lit(False)))
        .withColumn("excerpt_status", F.when(has_text(F.col("excerpt")), "available").otherwise("missing"))
        .withColumn("content_hash", ids.content_hash(F.col("title"), F.col("excerpt"), F.col("published_at")))
    )


def record_errors(title_valid: Column, link_valid: Column, provenance_valid: Column, date_status: Column, published_at: Column, excerpt: Column, hint_valid: Column) -> Column:
    """Error codes of a record, in a fixed order; null checks fail."""
    bad = lambda c: ~F.coalesce(c, F.lit(False))
    tests = {
        "TITLE_INVALID": bad(title_valid),
        "LINK_INVALID": bad(link_valid),
        "PROVENANCE_INVALID": bad(provenance_valid),
        "DATE_INVALID": (date_status == "valid") & bad(published_at.rlike(r"^20\d{2}-\d{2}-\d{2}$")),
        "EXCERPT_TOO_LONG": F.length(excerpt) > 500,
        "HINT_INVALID": bad(hint_valid),
    }
    return F.array_compact(F.array(*[F.when(t, F.lit(code)) for code, t in tests.items()]))


def source_state(error: Column, warnings: Column, n_items: Column, n_invalid: Column) -> Column:
    """HEALTHY, DEGRADED, UNAVAILABLE or BLOCKED. An error decides; a run without items is degraded."""
    soft = F.exists(warnings, lambda w: w.rlike("MISSING|INVALID_DATE|CANONICAL_IGNORED"))
    failed = F.coalesce(error, F.lit("")) != ""
    return (
        F.when(failed & error.isin(*BLOCKING), "BLOCKED")
        .when(failed & ~error.isin(*EMPTY), "UNAVAILABLE")
        .when(failed | (F.coalesce(n_items, F.lit(0)) == 0) | (F.coalesce(n_invalid, F.lit(0)) > 0) | F.coalesce(soft, F.lit(False)), "DEGRADED")
        .otherwise("HEALTHY")
    )
