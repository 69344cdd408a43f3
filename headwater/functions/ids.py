"""Stable identifiers and content hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from headwater.functions.text import fold_loose, fold_search


def hashed(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("\n", *[F.coalesce(p, F.lit("")) for p in parts]), 256)


def stable_id(prefix: str, *parts: Column) -> Column:
    return F.concat(F.lit(prefix), F.substring(hashed(*parts), 1, 20))


def record_id(kind: Column, title: Column, source: Column, link: Column) -> Column:
    return stable_id("rq_", kind, fold_loose(title), fold_loose(source), fold_loose(link))


def source_id(code: Column, url: Column, title: Column) -> Column:
    return stable_id("src_", code, url, fold_search(title))


def content_hash(title: Column, excerpt: Column, date: Column) -> Column:
    return hashed(fold_search(title), fold_search(excerpt), date)
