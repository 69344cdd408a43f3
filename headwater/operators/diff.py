"""Keyed snapshots: differences, reasons of change and the checks of a proposal."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, change, changed_fields): a full outer join that compares fields null-safely."""
    a = old.select(F.col(key), F.struct(*fields).alias("o"))
    b = new.select(F.col(key), F.struct(*fields).alias("n"))
    differs = F.array_compact(F.array(*[F.when(~F.col(f"o.{f}").eqNullSafe(F.col(f"n.{f}")), F.lit(f)) for f in sorted(fields)]))
    j = a.join(b, key, "full_outer").withColumn("f", F.when(F.col("o").isNotNull() & F.col("n").isNotNull(), differs).otherwise(F.array().cast("array<string>")))
    change = F.when(F.col("o").isNull(), "ADDED").when(F.col("n").isNull(), "REMOVED").when(F.size("f") > 0, "CHANGED").otherwise("UNCHANGED")
    return j.select(key, change.alias("change"), F.col("f").alias("changed_fields"))


def change_reasons(changed_fields: Column, rules: dict[str, list[str]]) -> Column:
    """Reasons whose field sets meet the changed fields, in rule order."""
    return F.array_compact(F.array(*[F.when(F.arrays_overlap(changed_fields, F.array(*map(F.lit, fields))), F.lit(name)) for name, fields in rules.items()]))


#: What a change of a source's item means, by the fields that differ, and the fields of an item in a report.
CHANGE_RULES = {
    "CONTENT_CHANGED": ["title", "excerpt", "content_hash"], "DATE_CHANGED": ["published_at"], "LINK_CHANGED": ["link"], "QUALITY_CHANGED": ["quality"],
    "PROVENANCE_CHANGED": ["provenance"], "ORGANIZATION_HINT_CHANGED": ["organization_hint"], "CLASSIFICATION_HINT_CHANGED": ["classification_hint"],
}
SNAPSHOT_FIELDS = ("id", "source_code", "source_name", "title", "link", "published_at", "organization_hint", "excerpt", "provenance", "quality", "classification_hint", "content_hash")
SNAPSHOT_EXCERPT = 500


def snapshot_item(kinds: dict[str, str], at: str = "") -> Column:
    """An item with the twelve fields of a report: texts trimmed and never null, the excerpt cut, nested values as they are.

    ``kinds`` are the item's columns and types (``dict(df.dtypes)``), ``at`` is a prefix such as ``o.``; a field that is absent is
    an empty text, or null if it is a nested one.
    """
    nested = ("provenance", "quality", "classification_hint")

    def field(n: str) -> Column:
        if n in nested:
            return F.col(f"{at}{n}") if n in kinds else F.lit(None).cast("string")
        c = F.coalesce(F.btrim(f"{at}{n}"), F.lit("")) if kinds.get(n) == "string" else F.lit("")
        return F.substring(c, 1, SNAPSHOT_EXCERPT) if n == "excerpt" else c

    return F.struct(*[field(n).alias(n) for n in SNAPSHOT_FIELDS])


def refresh_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """(id, title, change, changed_fields, reasons, old_item, new_item) of a source's items, by id, then title.

    Items without an id are left out; of rows that share one the last title counts. Fields and reasons are sorted; a field
    that neither side has does not differ. The items are those of ``snapshot_item``, null where there is none. One full
    outer join; the order is a range of ids, not one task.
    """
    fields = [f for fs in CHANGE_RULES.values() for f in fs]

    def side(df: DataFrame, n: str) -> DataFrame:
        kinds = dict(df.dtypes)
        held = F.struct(*[(F.col(f) if f in kinds else F.lit(None).cast("string")).alias(f) for f in fields], snapshot_item(kinds).alias("item"))
        rows = df.where(F.btrim("id") != "").select(F.btrim("id").alias("id"), F.struct(F.coalesce("title", F.lit("")).alias("t"), held.alias("h")).alias("x"))
        return rows.groupBy("id").agg(F.max_by("x", "x.t").alias("x")).select("id", F.col("x.h").alias(n))

    j = side(old, "o").join(side(new, "n"), "id", "full_outer")
    both = F.col("o").isNotNull() & F.col("n").isNotNull()
    differs = F.array_compact(F.array(*[F.when(both & ~F.col(f"o.{f}").eqNullSafe(F.col(f"n.{f}")), F.lit(f)) for f in sorted(fields)]))
    j = j.withColumn("changed_fields", differs)
    change = F.when(F.col("o").isNull(), "ADDED").when(F.col("n").isNull(), "REMOVED").when(F.size("changed_fields") > 0, "CHANGED").otherwise("UNCHANGED")
    title = F.coalesce(F.nullif(F.col("n.item.title"), F.lit("")), F.col("o.item.title"), F.lit(""))
    out = j.select("id", title.alias("title"), change.alias("change"), "changed_fields", F.array_sort(change_reasons(F.col("changed_fields"), CHANGE_RULES)).alias("reasons"), F.col("o.item").alias("old_item"), F.col("n.item").alias("new_item"))
    return ordered(out)


def ordered(df: DataFrame, *by: str) -> DataFrame:
    """Rows of a report by id, then title, or by the columns named."""
    return df.orderBy(*(by or ("id", "title")))


def percent(part: Column, whole: Column) -> Column:
    return F.coalesce(F.round(F.try_divide(100.0 * part, whole), 2), F.lit(0.0))


def reasonable_minimum(requested: Column, old: Column) -> Column:
    """At least 1, at most 5, not above what was asked for or stood before."""
    return F.greatest(F.lit(1), F.least(F.lit(5), requested, F.greatest(F.lit(1), old)))


def proposal_errors(checks: dict[str, Column]) -> Column:
    """Names of the checks that fail; a proposal is eligible if there are none."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in checks.items()]))


def report_status(errors: Column, production_changes: Column, material: Column, warnings: Column) -> Column:
    return (
        F.when((F.size(errors) > 0) | (production_changes > 0), "REJECT")
        .when((material == 0) & (warnings == 0), "NO_MATERIAL_CHANGE")
        .otherwise("REVIEW_REQUIRED")
    )


def material_changes(*counts: Column) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in counts])


def fetch_failed(fetch_status: Column, status: Column, valid_items: Column, error_code: Column) -> Column:
    """Whether a source could not be read at all, so that nothing may be concluded from what is missing."""
    said = F.coalesce(fetch_status.startswith("LIVE_FETCH_FAILED") | status.isin("UNAVAILABLE", "BLOCKED"), F.lit(False))
    return said | F.coalesce((valid_items == 0) & (F.btrim(error_code) != ""), F.lit(False))


def guarded_diff(old: DataFrame, new: DataFrame, key: str, fields: list[str], health: DataFrame, source: str) -> DataFrame:
    """``snapshot_diff`` in which a source that failed (``health``: source, failed) keeps its old items unchanged: no removals, no additions."""
    failed = health.where("failed").select(source).distinct()
    rest = new.join(failed, source, "left_anti").select(key, *fields)
    return snapshot_diff(old.select(key, *fields), rest.unionByName(old.join(failed, source, "left_semi").select(key, *fields)), key, fields)
