"""Reports: counters with their laws, one-row summaries, orders and cuts of lists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headwater.functions.dates import parse_time
from headwater.functions.text import has_text

#: What becomes of an input item, and the origin of official ones.
OUTCOMES = ("evaluated", "duplicate", "rejected")
OFFICIAL = "official_source_pilot"


def source_counters(items: DataFrame) -> DataFrame:
    """One row of the ``source_counter_columns`` of all input items."""
    return items.agg(*[c.alias(n) for n, c in source_counter_columns().items()])


def source_counter_columns() -> dict[str, Column]:
    """19 counters, as aggregates over input items (data_origin, outcome, has_signal, editorial_suppressed); nulls are false.

    Production items are evaluated always; official ones are evaluated, rejected, or duplicates of production items.
    """
    yes = lambda n: F.coalesce(F.col(n), F.lit(False))
    pilot = F.coalesce(F.col("data_origin") == OFFICIAL, F.lit(False))
    own, joined = ~pilot, pilot & F.coalesce(F.col("outcome") == "evaluated", F.lit(False))
    signal, muted, n = yes("has_signal"), yes("editorial_suppressed"), F.count_if
    return {
        "tender_total": n(F.col("data_origin") == "tender_corpus"),
        "event_total": n(F.col("data_origin") == "event_corpus"),
        "production_evaluated_total": n(own),
        "evaluated_total": n(own),
        "production_signal_total": n(own & signal),
        "signal_total": n(own & signal),
        "production_items_without_trigger": n(own & ~signal),
        "items_without_trigger": n(own & ~signal),
        "suppressed_editorial_total": n(own & muted),
        "source_pilot_input_total": n(pilot),
        "source_pilot_integrated_total": n(joined),
        "source_pilot_signal_total": n(joined & signal),
        "source_pilot_without_trigger": n(joined & ~signal),
        "source_pilot_suppressed_editorial_total": n(joined & muted),
        "cross_corpus_duplicates": n(pilot & (F.col("outcome") == "duplicate")),
        "rejected_source_items": n(pilot & (F.col("outcome") == "rejected")),
        "total_evaluated": n(own | joined),
        "total_signal_total": n((own | joined) & signal),
        "total_items_without_trigger": n((own | joined) & ~signal),
    }


def source_laws() -> dict[str, Column]:
    """What must hold between the counters of ``source_counters``; for ``quality.violations``."""
    c = F.col
    return {
        "production_is_tender_and_event": c("production_evaluated_total") == c("tender_total") + c("event_total"),
        "production_splits": c("production_evaluated_total") == c("production_signal_total") + c("production_items_without_trigger"),
        "pilot_splits": c("source_pilot_integrated_total") == c("source_pilot_signal_total") + c("source_pilot_without_trigger"),
        "pilot_input_splits": c("source_pilot_input_total") == c("source_pilot_integrated_total") + c("cross_corpus_duplicates") + c("rejected_source_items"),
        "evaluated_adds_up": c("total_evaluated") == c("production_evaluated_total") + c("source_pilot_integrated_total"),
        "signals_add_up": c("total_signal_total") == c("production_signal_total") + c("source_pilot_signal_total"),
        "rest_adds_up": c("total_items_without_trigger") == c("total_evaluated") - c("total_signal_total"),
    }


def quality_summary(items: DataFrame, title: list[str], source: list[str], link: list[str], is_object: Column | None = None) -> DataFrame:
    """One row: valid and problematic items, those without title, source or link, and those that are no objects."""
    has = lambda names: F.coalesce(*[F.when(has_text(F.col(n)), True) for n in names], F.lit(False))
    real = F.lit(True) if is_object is None else F.coalesce(is_object, F.lit(False))
    t, s, k = has(title), has(source), has(link)
    whole, n = real & t & s & k, F.count_if
    return items.agg(
        n(whole).alias("valid_items"), n(~whole).alias("problematic_items"), n(real & ~t).alias("missing_title"), n(real & ~s).alias("missing_source"), n(real & ~k).alias("missing_link"), n(~real).alias("non_object_items")
    )


def field_usage(items: DataFrame, kind: str, field: Column) -> DataFrame:
    """(type, field, n): which field named the organisation, by type; items without one are counted under 'none' alone."""
    named = has_text(field)
    return items.select(F.when(named, F.col(kind)).otherwise("none").alias("type"), F.when(named, field).otherwise("").alias("field")).groupBy("type", "field").agg(F.count("*").alias("n"))


def health_totals(health: DataFrame) -> DataFrame:
    """One row: sources, warnings and valid items of all sources (warnings, valid_items)."""
    n = F.coalesce(F.sum(F.coalesce(F.size("warnings"), F.lit(0))), F.lit(0)).cast("long")
    return health.agg(F.count("*").alias("sources"), n.alias("warning_count"), F.coalesce(F.sum("valid_items"), F.lit(0)).cast("long").alias("valid_item_count"))


def daily_digest(signals: DataFrame, day: Column, hours: int = 48) -> DataFrame:
    """(section, key, n): signals by kind of client, events still to come, and tenders of the last hours that name an organisation.

    Read are type, client_kind, published (timestamp), event_date (date) and organization.
    """
    age = F.unix_timestamp(day.cast("timestamp")) - F.unix_timestamp("published")
    fresh = (F.col("type") == "tender") & (age >= 0) & (age <= 3600 * hours) & has_text(F.col("organization"))
    parts = F.array_compact(
        F.array(
            F.when(F.to_date("published") == F.to_date(day), F.struct(F.lit("new_by_client").alias("section"), F.coalesce("client_kind", F.lit("")).alias("key"))),
            F.when((F.col("type") == "event") & (F.col("event_date") >= F.to_date(day)), F.struct(F.lit("upcoming_events").alias("section"), F.lit("").alias("key"))),
            F.when(fresh, F.struct(F.lit("priority").alias("section"), F.lit("").alias("key"))),
        )
    )
    return signals.select(F.explode(parts).alias("p")).groupBy("p.section", "p.key").agg(F.count("*").alias("n"))


def latest_time(df: DataFrame, *cols: str) -> DataFrame:
    """One row: the latest time that can be read in any of the columns; null if there is none."""
    latest = F.greatest(*[F.max(parse_time(F.col(c))) for c in cols]) if len(cols) > 1 else F.max(parse_time(F.col(cols[0])))
    return df.agg(latest.alias("latest"))


def source_order(df: DataFrame) -> list[Column]:
    """Records by source, the newest first, then by title and id."""
    return [F.col("source_code").asc(), F.col("published_at").desc(), F.col("title").asc(), F.col("id").asc()]


def candidate_order(*cols: str) -> list[Column]:
    """Items by the given columns as people sort them, then by their bytes so that the order is total."""
    return [x for c in cols for x in (F.collate(F.col(c), "UNICODE_CI_AI").asc(), F.col(c).asc())]


def limited(items: DataFrame, order: list[Column], most: int = 0) -> tuple[DataFrame, Callable[[], int]]:
    """(the first ``most`` items in order, a function that counts those skipped); none are skipped for a limit of zero."""
    if most <= 0:
        return items, lambda: 0
    return items.orderBy(*order).limit(most), lambda: max(0, items.count() - most)


def visible(items: DataFrame, order: list[Column], n: int = 20) -> DataFrame:
    """The rows that a list shows at first."""
    return items.orderBy(*order).limit(n)


def union_codes(*arrays: Column) -> Column:
    """All codes of the arrays, once each and sorted; null arrays have none."""
    none = F.array().cast("array<string>")
    return F.array_sort(F.array_distinct(F.concat(*[F.coalesce(a, none) for a in arrays])))


def report_items(changes: DataFrame, old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, change, fields): each change with its signal, from the old output if it was removed, else from the new one."""
    side = lambda df, n: df.select(key, F.struct(*fields).alias(n))
    j = changes.join(side(old, "__o"), key, "left").join(side(new, "__n"), key, "left")
    of = F.when(F.col("change") == "REMOVED", F.col("__o")).otherwise(F.col("__n"))
    return j.select(*changes.columns, *[of[f].alias(f) for f in fields])
