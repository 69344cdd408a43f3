"""Dates: strict parsing, staleness and dates in free text. The session time zone is UTC."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from headwater.functions.html import clean_text
from headwater.functions.text import fold_loose, fold_search

#: Month names of the feeds' language, and those of texts in two languages.
MONTHS_ID = {"januari": 1, "februari": 2, "maret": 3, "april": 4, "mei": 5, "juni": 6, "juli": 7, "agustus": 8, "september": 9, "oktober": 10, "november": 11, "desember": 12}
MONTHS = MONTHS_ID | {"january": 1, "february": 2, "march": 3, "may": 5, "june": 6, "july": 7, "august": 8, "october": 10, "december": 12}
_NAMES = "|".join(MONTHS_ID)


def month_number(name: Column) -> Column:
    return reduce(lambda a, m: a.when(F.lower(name) == m[0], m[1]), MONTHS.items(), F.when(F.lit(False), F.lit(0)))


def parse_rfc822(c: Column) -> Column:
    return F.try_to_timestamp(F.regexp_replace(c, r"^\s*[A-Za-z]{3},\s*", ""), F.lit("dd MMM yyyy HH:mm:ss z"))


def parse_time(c: Column) -> Column:
    """ISO, else RFC 2822, else null."""
    return F.coalesce(F.try_to_timestamp(c), parse_rfc822(c))


def is_strict_date(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_date(c, "yyyy-MM-dd").isNotNull(), F.lit(False))


def is_stale(published: Column, reference: Column, days: int) -> Column:
    """More than so many days before the reference day; without a date nothing is stale."""
    return F.coalesce(F.datediff(F.to_date(reference), F.to_date(published)) > days, F.lit(False))


def is_older_than(ts: Column, now: Column, days: int) -> Column:
    """Older to the millisecond, not to the day."""
    return F.coalesce(F.unix_millis(now.cast("timestamp")) - F.unix_millis(ts.cast("timestamp")) > days * 86_400_000, F.lit(False))


def public_date(c: Column) -> Column:
    """STRUCT(value, status): ISO or ``12 Juli 2026``; missing, valid or invalid by the calendar. A wrong ISO date may be followed by a right local one."""
    t = clean_text(F.coalesce(c, F.lit("")))
    pattern = rf"(?i)\b(\d{{1,2}})\s+({_NAMES})\s+(20\d{{2}})\b"
    iso = F.regexp_extract(t, r"\b(20\d{2}-\d{2}-\d{2})\b", 1)
    local = F.format_string("%s-%02d-%02d", F.regexp_extract(t, pattern, 3), month_number(F.regexp_extract(t, pattern, 2)), F.regexp_extract(t, pattern, 1).try_cast("int"))
    real = lambda d: F.when(F.try_to_date(d, "yyyy-MM-dd").isNotNull(), d)
    value = F.coalesce(real(iso), F.when(t.rlike(pattern), real(local)))
    return F.struct(F.coalesce(value, F.lit("")).alias("value"), F.when(t == "", "missing").when(value.isNotNull(), "valid").otherwise("invalid").alias("status"))


def event_date(title: Column) -> Column:
    """First day of ``12-13 Juli 2026`` as text, without a look at the calendar."""
    pattern = rf"(?i)\b(\d{{1,2}})(?:\s*[-\u2013]\s*\d{{1,2}})?\s+({_NAMES})\s+(\d{{4}})\b"
    made = F.format_string("%s-%02d-%02d", F.regexp_extract(title, pattern, 3), month_number(F.regexp_extract(title, pattern, 2)), F.regexp_extract(title, pattern, 1).try_cast("int"))
    return F.when(title.rlike(pattern), made)


def rolled_date(year: Column, month: Column, day: Column) -> Column:
    """The day that many months and days into a year; overflow runs on into the next month or year."""
    return F.date_add(F.add_months(F.make_date(year, F.lit(1), F.lit(1)), (month - 1).cast("int")), (day - 1).cast("int"))


def names_future_date(title: Column, reference: Column) -> Column:
    """Whether a text names a day after the reference day: numeric dates, month names, or a later year.

    A month name takes a day from the word before it and a year from the word after it; without a year it counts in the
    reference year only if it has a day other than the first.
    """
    day = F.to_date(reference)
    loose = fold_loose(title)
    part = lambda d, i: F.element_at(F.split(d, "[-/.]"), i).cast("int")
    iso = F.transform(F.regexp_extract_all(loose, F.lit(r"\b(20\d{2}[-/.]\d{1,2}[-/.]\d{1,2})\b"), F.lit(1)), lambda d: rolled_date(part(d, 1), part(d, 2), part(d, 3)))
    local = F.transform(F.regexp_extract_all(loose, F.lit(r"\b(\d{1,2}[-/]\d{1,2}[-/]20\d{2})\b"), F.lit(1)), lambda d: rolled_date(part(d, 3), part(d, 2), part(d, 1)))
    words = F.split(fold_search(title), " ")
    number = lambda i, low, high: F.when(F.try_element_at(words, i).rlike(r"^\d{1,9}$") & F.try_element_at(words, i).try_cast("int").between(low, high), F.try_element_at(words, i).try_cast("int"))

    def named(word: Column, i: Column) -> Column:
        at = F.coalesce(F.when(i > 0, number(F.greatest(i, F.lit(1)), 1, 31)), F.lit(1))
        year = F.coalesce(number(i + 2, 2000, 2100), F.when(at != 1, F.year(day)))
        return F.when(word.isin(*MONTHS), rolled_date(year, month_number(word), at))

    later = F.exists(F.concat(iso, local, F.transform(words, named)), lambda d: d > day)
    years = F.exists(words, lambda w: w.rlike(r"^20\d{2}$") & (w.try_cast("int") > F.year(day)))
    return F.coalesce(later, F.lit(False)) | F.coalesce(years, F.lit(False))


def period(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")
