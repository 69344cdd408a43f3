"""Feed items of several shapes brought to one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headwater.functions import ids
from headwater.functions.text import first_text, fold_search, has_text

#: Field names of each kind of feed, in order of precedence.
FEEDS = {
    "tender": {
        "title": ["judul", "title", "name"], "source": ["sumber", "source"], "link": ["link", "url"],
        "date": ["published", "date", "tanggal"], "organization": ["instansi_terdeteksi"], "event_date": [], "published": ["published"],
    },
    "event": {
        "title": ["nama_event", "title", "name"], "source": ["sumber", "source"], "link": ["link_resmi", "link", "url"],
        "date": ["tanggal", "published", "date"], "organization": ["penyelenggara"], "event_date": ["tanggal"], "published": ["published"],
    },
}


def _resolve(df: DataFrame, names: list[str]) -> Column:
    """The first text among those of the fields that the frame has."""
    held = [F.col(f"`{n}`").cast("string") for n in names if n in df.columns]
    return first_text(*held) if held else F.lit("")


def normalize_items(df: DataFrame, kind: str, feeds: dict[str, dict[str, list[str]]] = FEEDS, extra: dict[str, list[str]] | None = None) -> DataFrame:
    """(id, type, the resolved fields, folded_title) of a feed; ``extra`` adds fields with aliases of their own, such as a location."""
    fields = {n: _resolve(df, names) for n, names in (feeds[kind] | (extra or {})).items()}
    out = df.select(F.lit(kind).alias("type"), *[c.alias(n) for n, c in fields.items()])
    key = ids.record_id(F.col("type"), F.col("title"), F.col("source"), F.col("link"))
    return out.select(key.alias("id"), *out.columns, fold_search(F.col("title")).alias("folded_title"))


def resolved_by(df: DataFrame, names: list[str]) -> Column:
    """Name of the field that gives the first text; null where none does."""
    return F.coalesce(*[F.when(has_text(F.col(f"`{n}`").cast("string")), F.lit(n)) for n in names if n in df.columns], F.lit(None).cast("string"))


def searchable(*fields: Column) -> Column:
    return F.btrim(F.concat_ws(" ", *[F.when(has_text(c), F.btrim(c)) for c in fields]))


def complete_provenance(*fields: Column) -> Column:
    """All fields hold text."""
    ok = F.lit(True)
    for c in fields:
        ok = ok & F.coalesce(has_text(c), F.lit(False))
    return ok


def facets(df: DataFrame, chosen: dict[str, str]) -> DataFrame:
    """Rows that have every chosen value; a blank choice stands for all values."""
    for name, value in chosen.items():
        if value:
            df = df.where(F.col(f"`{name}`") == value)
    return df


#: The choices of the dashboard, and the column of ``signals.build_signals`` that each one tests.
DASHBOARD = {"category": "primary_trigger", "class": "primary_class", "strength": "primary_strength", "timing": "timing_status", "type": "type", "origin": "data_origin", "source_code": "source_code"}


def dashboard_facets(signals: DataFrame, chosen: dict[str, str]) -> DataFrame:
    """Signals that have every choice of the dashboard; a category is one of all triggers of a signal, not its primary one alone."""
    unknown = sorted(set(chosen) - set(DASHBOARD))
    if unknown:
        raise ValueError(f"no choice of the dashboard: {', '.join(unknown)}")
    rest = {DASHBOARD[n]: v for n, v in chosen.items() if n != "category"}
    if value := chosen.get("category"):
        signals = signals.where(F.exists("triggers", lambda t: t["trigger_code"] == value))
    return facets(signals, rest)


def facet_options(df: DataFrame, *names: str) -> DataFrame:
    """(facet, value, n) of the named columns, read once; blank values are no option."""
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("facet"), F.btrim(F.col(f"`{n}`").cast("string")).alias("value")) for n in names]))
    return df.select(pairs.alias("p")).where("p.value <> ''").groupBy("p.facet", "p.value").agg(F.count("*").alias("n"))
