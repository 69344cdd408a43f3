"""Columns that let nothing unexpected through: codes, hosts, types, addresses, actions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headwater.functions.html import is_allowed_url, path

#: Stages at which acquisition may fail, in their order.
FAILURE_STAGES = ("DNS", "TLS", "LISTING_REQUEST", "REDIRECT", "CONTENT_TYPE", "LISTING_PARSE", "DETAIL_REQUEST", "DETAIL_PARSE")
_TOKEN = r"[A-Za-z0-9!#$&^_.+/-]+"


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def safe_stage(c: Column) -> Column:
    upper = F.upper(_text(c))
    return F.when(upper.isin(*FAILURE_STAGES), upper).otherwise("LISTING_REQUEST")


def safe_code(c: Column, fallback: str = "SOURCE_ERROR") -> Column:
    upper = F.upper(_text(c))
    return F.when(upper.rlike("^[A-Z][A-Z0-9_]{1,80}$"), upper).otherwise(fallback)


def safe_host(c: Column) -> Column:
    lower = F.lower(_text(c))
    return F.when((F.length(lower) <= 253) & lower.rlike("^[a-z0-9.-]+$"), lower).otherwise("")


def safe_content_type(c: Column) -> Column:
    line = F.btrim(F.regexp_replace(_text(c), r"[\r\n]", ""))
    return F.when(line.rlike(rf'^{_TOKEN}(\s*;\s*{_TOKEN}=({_TOKEN}|"[^"]*"))*$'), F.substring(line, 1, 160)).otherwise("")


def is_allowed_request(url: Column, host_name: str, prefixes: list[str]) -> Column:
    """An allowed page of the source, or the robots text of its host."""
    ok = is_allowed_url(url, [host_name], "/robots.txt") & (path(url) == "/robots.txt")
    for prefix in prefixes:
        ok = ok | is_allowed_url(url, [host_name], prefix)
    return F.coalesce(ok, F.lit(False))


def safe_url(url: Column, host_name: str, prefixes: list[str]) -> Column:
    return F.when(is_allowed_request(url, host_name, prefixes), url).otherwise("")


def names_forbidden_action(key: str, value: Column) -> Column:
    """Text of an action field that contacts people or sets a price."""
    import re

    if not re.search("action|outreach|contact", key, re.I):
        return F.lit(False)
    return F.coalesce(value.rlike("(?i)outreach|contact|send[_ -]?(email|whatsapp)|set[_ -]?price"), F.lit(False))


def forbidden_fields(schema: T.StructType, at: str = "") -> list[str]:
    """Paths of fields whose very name is an action on people or prices."""
    import re

    found = []
    for f in schema.fields:
        name, kind = f"{at}{f.name}", f.dataType
        if re.search("outreach_action|contact_action|send_email|send_whatsapp|set_price", f.name, re.I):
            found.append(name)
        while isinstance(kind, T.ArrayType):
            kind = kind.elementType
        if isinstance(kind, T.StructType):
            found += forbidden_fields(kind, f"{name}.")
    return found


#: A string of a JSON text, with the colon and the beginning of the value if it is a key.
_MEMBER = r'"(?:[^"\\]|\\.)*+"(?:\s*+:\s*+(?:"(?:[^"\\]|\\.)*+"|-?[0-9])?+)?+'


def json_members(value: Column) -> Column:
    """ARRAY<STRUCT<key, text, is_number>> of all members of a JSON text, at any depth, in their order.

    ``text`` is the value if it is a text. One scan over the strings, whatever the depth: a string is a key if a colon
    follows. VARIANT, struct, map and array values are given as ``to_json`` of them. Null has no members; a broken text
    has those that can be read.
    """
    plain = lambda t: F.when(t.contains("\\"), F.get(F.from_json(F.concat(F.lit('["'), t, F.lit('"]')), "array<string>"), F.lit(0))).otherwise(t)
    inside = r'(?s)^"((?:[^"\\]|\\.)*+)"\s*+:\s*+'

    def member(m: Column) -> Column:
        is_text = m.rlike(inside + '"')
        said = F.when(is_text, plain(F.regexp_extract(m, inside + r'"((?:[^"\\]|\\.)*+)"$', 2)))
        return F.struct(plain(F.regexp_extract(m, inside, 1)).alias("key"), said.alias("text"), m.rlike(inside + "-?[0-9]$").alias("is_number"))

    found = F.regexp_extract_all(F.coalesce(value, F.lit("")), F.lit(f"(?s){_MEMBER}"), F.lit(0))
    return F.transform(F.filter(found, lambda m: m.rlike(inside)), member)


def forbidden_members(members: Column) -> Column:
    """Keys, each once and sorted, that act on people or prices, that hold a number as a score, or whose text names such an action."""
    bad = lambda m: (
        m["key"].rlike("(?i)outreach_action|contact_action|send_email|send_whatsapp|set_price")
        | (m["key"].rlike("(?i)score") & m["is_number"])
        | (m["key"].rlike("(?i)action|outreach|contact") & F.coalesce(m["text"].rlike("(?i)outreach|contact|send[_ -]?(email|whatsapp)|set[_ -]?price"), F.lit(False)))
    )
    return F.array_sort(F.array_distinct(F.transform(F.filter(members, bad), lambda m: m["key"])))
