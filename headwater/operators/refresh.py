"""The refresh of official sources: a run's summary, the checks of a proposal, its metadata, and changes between outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headwater.functions.dates import is_strict_date
from headwater.functions.text import has_text, plain_fold
from headwater.operators.diff import fetch_failed, percent, reasonable_minimum
from headwater.operators.quality import issue_codes

#: Names under which the publisher itself is no organisation of a record, and origins that are made up.
PUBLISHER = r"(?i)^(bkpm|kementerian investasi dan hilirisasi(?:/bkpm)?)"
INFERRED_ORGANIZATION = "publisher|inferen|runtime|generated|assum"
INFERRED_DATE = "retrieval|runtime|generated|inferen"


def _text(df: DataFrame, name: str) -> Column:
    """The trimmed text of a column; '' where it is null or not there."""
    return F.coalesce(F.btrim(F.col(name).cast("string")), F.lit("")) if name in df.columns else F.lit("")


def run_summary(sources: DataFrame, kept: DataFrame, n_duplicates: DataFrame) -> DataFrame:
    """One row: configured, healthy, degraded and unavailable sources, raw, normalized, duplicate and invalid items, latest date.

    ``sources`` has (status, raw_items, invalid_items), ``kept`` the surviving items with published_at, ``n_duplicates`` one
    row per dropped item. All are tagged rows of one aggregation; unavailable is what is neither healthy nor degraded.
    """
    zero = F.lit(0).cast("long")
    none = F.lit(None).cast("string")
    a = sources.select(F.lit("s").alias("k"), "status", F.col("raw_items").cast("long").alias("raw"), F.col("invalid_items").cast("long").alias("invalid"), none.alias("at"))
    b = kept.select(F.lit("i").alias("k"), none.alias("status"), zero.alias("raw"), zero.alias("invalid"), F.when(is_strict_date(F.col("published_at")), F.col("published_at")).alias("at"))
    c = n_duplicates.select(F.lit("d").alias("k"), none.alias("status"), zero.alias("raw"), zero.alias("invalid"), none.alias("at"))
    n = lambda x: F.count_if(x)
    s, ok, half = F.col("k") == "s", F.col("status") == "HEALTHY", F.col("status") == "DEGRADED"
    return a.unionByName(b).unionByName(c).agg(
        n(s).alias("configured_sources"), n(ok).alias("healthy_sources"), n(half).alias("degraded_sources"), (n(s) - n(ok) - n(half)).alias("unavailable_sources"), F.coalesce(F.sum("raw"), zero).alias("raw_items"),
        n(F.col("k") == "i").alias("normalized_items"), n(F.col("k") == "d").alias("duplicate_items"), F.coalesce(F.sum("invalid"), zero).alias("invalid_items"), F.coalesce(F.max("at"), F.lit("")).alias("content_reference_date"),
    )


def metadata_findings(items: DataFrame, publisher: str = PUBLISHER) -> DataFrame:
    """Append warnings, errors and date_valid: what is missing is a warning, what is wrong or made up an error.

    Read are organization_hint, organization_status, organization_source, source_name, title, excerpt, published_at,
    date_status, date_source, excerpt_status, excerpt_source and hint_code; a column that is not there counts as blank.
    """
    col = lambda n: _text(items, n)
    low = lambda n: F.lower(col(n))
    org, status = col("organization_hint"), low("organization_status")
    made_up = (status == "fabricated") | low("organization_source").rlike(INFERRED_ORGANIZATION)
    own = (plain_fold(org) == plain_fold(col("source_name"))) | org.rlike(publisher)
    quoted = F.contains(plain_fold(F.concat_ws(" ", col("title"), col("excerpt"))), plain_fold(org))
    of_org = (
        F.when(made_up, "ORGANIZATION_FABRICATION_DETECTED")
        .when((org == "") & status.isin("", "missing", "unknown"), "ORGANIZATION_MISSING")
        .when(org == "", "ORGANIZATION_INVALID")
        .when(own, "ORGANIZATION_FABRICATION_DETECTED")
        .when(status != "explicit", "ORGANIZATION_INVALID")
        .when(~quoted, "ORGANIZATION_FABRICATION_DETECTED")
    )
    day, day_status = col("published_at"), low("date_status")
    strict = is_strict_date(day) & day.startswith("20")
    of_day = (
        F.when((day_status == "fabricated") | low("date_source").rlike(INFERRED_DATE), "PUBLISHED_DATE_FABRICATION_DETECTED")
        .when((day == "") & (day_status == "missing"), "PUBLISHED_DATE_MISSING")
        .when((day == "") | (day_status != "valid") | ~strict, "PUBLISHED_DATE_INVALID")
    )
    excerpt = (low("excerpt_status") == "fabricated") | low("excerpt_source").rlike(INFERRED_DATE)
    hint = col("hint_code")
    warned = {"ORGANIZATION_MISSING": of_org == "ORGANIZATION_MISSING", "PUBLISHED_DATE_MISSING": of_day == "PUBLISHED_DATE_MISSING", "CLASSIFICATION_HINT_UNKNOWN": (hint == "") | (F.upper(hint) == "UNKNOWN")}
    faults = {
        "ORGANIZATION_FABRICATION_DETECTED": of_org == "ORGANIZATION_FABRICATION_DETECTED",
        "ORGANIZATION_INVALID": of_org == "ORGANIZATION_INVALID",
        "PUBLISHED_DATE_FABRICATION_DETECTED": of_day == "PUBLISHED_DATE_FABRICATION_DETECTED",
        "PUBLISHED_DATE_INVALID": of_day == "PUBLISHED_DATE_INVALID",
        "EXCERPT_FABRICATION_DETECTED": excerpt,
    }
    return items.withColumn("warnings", issue_codes(warned)).withColumn("errors", issue_codes(faults)).withColumn("date_valid", of_day.isNull())


def metadata_summary(findings: DataFrame, least_percent: float = 70.0) -> DataFrame:
    """One row of counts, the completeness of dates in percent, and whether it falls below the threshold (never for no items)."""
    has = lambda name, code: F.count_if(F.array_contains(name, code))
    any_of = lambda part: F.count_if(F.exists("errors", lambda e: e.startswith(part)))
    n = F.count("*")
    out = findings.agg(
        n.alias("items"), has("warnings", "PUBLISHED_DATE_MISSING").alias("missing_date_count"), has("warnings", "ORGANIZATION_MISSING").alias("missing_organization_count"),
        any_of("PUBLISHED_DATE_").alias("invalid_date_count"), any_of("ORGANIZATION_").alias("invalid_organization_count"), F.count_if("date_valid").alias("valid_date_count"),
        F.count_if(F.size("errors") > 0).alias("invalid_item_count"),
    )
    out = out.withColumn("date_completeness_percent", percent(F.col("valid_date_count"), F.col("items")))
    return out.withColumn("below_threshold", (F.col("items") > 0) & (F.col("date_completeness_percent") < least_percent))


def proposal_item_errors(items: DataFrame, accepted: list[str] | Column, publisher: str = PUBLISHER) -> DataFrame:
    """Append errors of an item of a proposal; ``accepted`` lists the accepted sources, or says whether the item's is one.

    Read are source_code, link_valid, provenance_complete, published_at, date_status, organization_hint,
    organization_status, source_name, title, excerpt, title_valid and excerpt_status; null flags fail.
    """
    col = lambda n: _text(items, n)
    bad = lambda c: ~F.coalesce(c, F.lit(False))
    org, day = col("organization_hint"), col("published_at")
    tests = {
        "SOURCE_NOT_ACCEPTED": bad(accepted) if isinstance(accepted, Column) else ~col("source_code").isin(*accepted),
        "OFFICIAL_LINK_INVALID": bad(F.col("link_valid")),
        "PROVENANCE_INCOMPLETE": bad(F.col("provenance_complete")),
        "DATE_UNVERIFIED_OR_FABRICATED": (day != "") & (~is_strict_date(day) | ~day.startswith("20") | (col("date_status") != "valid")),
        "ORGANIZATION_HINT_UNVERIFIED": (org != "") & ((col("organization_status") != "explicit") | (plain_fold(org) == plain_fold(col("source_name"))) | org.rlike(publisher)),
        "SOURCE_FIELDS_INCOMPLETE": (col("title") == "") | (col("excerpt") == "") | bad(F.col("title_valid")) | bad(F.col("link_valid")) | (col("excerpt_status") != "available"),
    }
    return items.withColumn("errors", issue_codes(tests))


def proposal_summary(checked: DataFrame, minimum: int = 5) -> DataFrame:
    """One row: counts and percentages of a checked proposal and whether its items let it pass."""
    col = lambda n: F.coalesce(F.col(n), F.lit(False))
    out = checked.agg(
        F.count("*").alias("items"), F.count_if(F.size("errors") == 0).alias("valid_item_count"), F.count_if(F.size("errors") > 0).alias("invalid_item_count"), F.count_if(~F.coalesce(has_text(F.col("published_at")), F.lit(False))).alias("missing_date_count"),
        F.count_if(~F.coalesce(has_text(F.col("organization_hint")), F.lit(False))).alias("missing_organization_count"), F.count_if(col("link_valid")).alias("valid_link_count"), F.count_if(col("provenance_complete")).alias("provenance_complete_count"),
    )
    out = out.withColumn("valid_link_percent", percent(F.col("valid_link_count"), F.col("items"))).withColumn("provenance_completeness_percent", percent(F.col("provenance_complete_count"), F.col("items")))
    return out.withColumn("proposal_eligible", (F.col("invalid_item_count") == 0) & (F.col("items") >= minimum))


def _canonical(triggers: Column, *fields: str) -> Column:
    """Triggers by code, lists within them sorted, so that order alone is no difference."""
    sort = lambda t, f: F.array_sort(t[f]) if f in ("matched_terms", "matched_evidence", "product_hypotheses") else t[f]
    return F.array_sort(F.transform(triggers, lambda t: F.struct(*[sort(t, f).alias(f) for f in ("trigger_code", *fields)])))


def signal_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """(id, change, changes): a full outer join of two signal outputs; changes lists classification, timing, evidence and content.

    ``content`` covers title, source, link, date, organization, the suggested action and the call for review. Compared are
    canonical triggers, null-safely.
    """
    parts = {
        "classification": lambda: F.struct("primary_trigger", _canonical(F.col("triggers"), "trigger_class", "evidence_strength").alias("t")),
        "timing": lambda: F.struct("timing_status"),
        "evidence": lambda: F.struct(_canonical(F.col("triggers"), "matched_terms", "matched_evidence", "evidence_excerpt").alias("t")),
        "content": lambda: F.struct("type", "title", "source", "link", "date", "organization", "suggested_next_action", "human_review_required"),
    }
    side = lambda df, n: df.select("id", F.struct(*[make().alias(p) for p, make in parts.items()]).alias(n))
    j = side(old, "o").join(side(new, "n"), "id", "full_outer")
    both = F.col("o").isNotNull() & F.col("n").isNotNull()
    changes = issue_codes({p: both & ~F.col(f"o.{p}").eqNullSafe(F.col(f"n.{p}")) for p in parts})
    change = F.when(F.col("o").isNull(), "ADDED").when(F.col("n").isNull(), "REMOVED").when(F.size("changes") > 0, "CHANGED").otherwise("UNCHANGED")
    return j.withColumn("changes", changes).select("id", change.alias("change"), "changes")


def new_signal_errors(signals: DataFrame, changes: DataFrame) -> DataFrame:
    """(id, errors) of the added signals: official ones need a complete provenance, and every one a person's review."""
    added = signals.join(changes.where("change = 'ADDED'").select("id"), "id", "left_semi")
    fields = ("source_name", "official_domain", "detail_url", "published_at", "retrieval_method")
    whole = F.lit(True)
    for f in fields:
        whole = whole & F.coalesce(has_text(F.col(f"official_provenance.{f}")), F.lit(False))
    tests = {"NEW_SIGNAL_PROVENANCE_INCOMPLETE": ~whole, "NEW_SIGNAL_HUMAN_REVIEW_REQUIRED": ~F.coalesce(F.col("human_review_required"), F.lit(False))}
    return added.select("id", issue_codes(tests).alias("errors"))


def proposal_contract(checked: DataFrame, runs: DataFrame) -> DataFrame:
    """One row per source of ``runs``: counts, sorted errors and warnings of its proposed items, and whether they may replace the old ones.

    ``checked`` has source_code, id, published_at, organization_hint, link_valid, provenance_complete and the errors of
    ``proposal_item_errors``. ``runs`` has source_code, old_total, requested, raw_items, normalized_items, duplicate_items,
    invalid_items, fetch_status, status, http_status, content_type, n_errors and error_code; a null status means that there is
    no health record. Item errors are listed by code, once each. A source that failed is never eligible.
    """
    flag = lambda n: F.coalesce(F.col(n), F.lit(False))
    blank = lambda n: ~F.coalesce(has_text(F.col(n)), F.lit(False))
    items = checked.groupBy("source_code").agg(
        F.count("*").alias("n"),
        F.count_distinct("id").alias("n_ids"),
        F.count_if(F.size("errors") > 0).alias("n_bad"),
        F.array_distinct(F.flatten(F.collect_set("errors"))).alias("codes"),
        F.count_if(blank("published_at")).alias("n_undated"),
        F.count_if(blank("organization_hint")).alias("n_unnamed"),
        F.count_if(flag("link_valid")).alias("n_links"),
        F.count_if(flag("provenance_complete")).alias("n_whole"),
    )
    zero = lambda n: F.coalesce(F.col(n), F.lit(0)).cast("long")
    j = runs.join(items, "source_code", "left").withColumns({n: zero(n) for n in ("n", "n_ids", "n_bad", "n_undated", "n_unnamed", "n_links", "n_whole")})
    least = reasonable_minimum(F.least(F.greatest(F.coalesce("requested", F.lit(25)), F.lit(1)), F.lit(50)), zero("old_total"))
    known, failed = F.col("status").isNotNull(), fetch_failed(F.col("fetch_status"), F.col("status"), F.col("n"), F.col("error_code"))
    tests = {
        "PROPOSED_OUTPUT_EMPTY": F.col("n") == 0,
        "VALID_ITEM_COUNT_BELOW_MINIMUM": F.col("n") < F.col("reasonable_minimum_valid_items"),
        "DUPLICATE_STABLE_ID": F.col("n_ids") != F.col("n"),
        "NORMALIZED_COUNT_MISMATCH": ~F.col("normalized_items").eqNullSafe(F.col("n")),
        "INVALID_ITEMS_PRESENT": zero("invalid_items") > 0,
        "DUPLICATE_RATE_ABNORMAL": (zero("raw_items") > 0) & (zero("duplicate_items") / zero("raw_items") > 0.5),
        "LIVE_FETCH_FAILED": failed,
        "PROPOSED_HEALTH_MISSING": ~known,
        "SOURCE_HEALTH_UNACCEPTABLE": known & ~F.col("status").isin("HEALTHY", "DEGRADED"),
        "SOURCE_HTTP_NOT_200": known & ~F.col("http_status").eqNullSafe(F.lit(200)),
        "SOURCE_NOT_HTML": known & ~F.coalesce(F.col("content_type").rlike(r"(?i)^text/html\b"), F.lit(False)),
        "SOURCE_HEALTH_HAS_ERRORS": known & (zero("n_errors") > 0),
    }
    counted = lambda code, n: F.when(F.col(n) > 0, F.concat(F.lit(f"{code}:"), F.col(n).cast("string")))
    none = F.array().cast("array<string>")
    out = j.withColumn("reasonable_minimum_valid_items", least).withColumn("duplicate_count", zero("duplicate_items"))
    out = out.withColumn("errors", F.array_sort(F.array_distinct(F.concat(issue_codes(tests), F.coalesce("codes", none)))))
    warned = F.array_compact(F.array(counted("DUPLICATES_REMOVED", "duplicate_count"), counted("MISSING_DATE", "n_undated"), counted("MISSING_ORGANIZATION", "n_unnamed")))
    return out.select(
        "source_code", (F.size("errors") == 0).alias("proposal_eligible"), F.col("reasonable_minimum_valid_items").cast("long").alias("reasonable_minimum_valid_items"), (F.col("n") - F.col("n_bad")).alias("valid_item_count"),
        F.col("n_bad").alias("invalid_item_count"), "duplicate_count", F.col("n_undated").alias("missing_date_count"), F.col("n_unnamed").alias("missing_organization_count"), F.col("n_links").alias("valid_link_count"),
        percent(F.col("n_links"), F.col("n")).alias("valid_link_percent"), F.col("n_whole").alias("provenance_complete_count"), percent(F.col("n_whole"), F.col("n")).alias("provenance_completeness_percent"), warned.alias("warnings"), "errors",
    )
