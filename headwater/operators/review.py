"""The review queue of feed items and their readiness for a person's decision."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headwater.functions import dates
from headwater.functions.text import boundary_term, fold_loose, fold_term_loose, has_text, matched_terms, media_name, strip_suffix, title_key
from headwater.operators.dedup import flag_duplicates
from headwater.operators.quality import issue_codes, severity, severity_rank, tri_state

#: Issues in their order, those of medium severity, and word lists of the feeds' language.
ISSUES = (
    "MISSING_TITLE", "TITLE_TOO_SHORT", "MISSING_SOURCE", "MISSING_LINK", "MALFORMED_RSS_TITLE", "LONG_TITLE_WITHOUT_SPACES", "DUPLICATE_NORMALIZED_TITLE",
    "SUSPECTED_ORGANIZATION_EXTRACTION", "SUSPECTED_LOCATION_EXTRACTION", "OLD_ITEM", "INVALID_DATE", "INCOMPLETE_CORE_FIELDS",
)
MEDIUM = (
    "TITLE_TOO_SHORT", "MALFORMED_RSS_TITLE", "LONG_TITLE_WITHOUT_SPACES", "DUPLICATE_NORMALIZED_TITLE", "SUSPECTED_ORGANIZATION_EXTRACTION", "SUSPECTED_LOCATION_EXTRACTION",
)
GENERIC_TITLES = (
    "berita", "news", "update", "artikel", "info", "informasi", "rss", "home", "homepage", "index", "null", "undefined", "event", "tender", "pengumuman",
)
NAME_STOP_WORDS = (
    "akan", "bakal", "buka", "gelar", "gelaran", "hingga", "kembali", "minta", "pengadaan", "resmi", "seragam", "siap", "sukses", "tender", "usai",
)
NAME_TOPICS = ("pengadaan", "seragam", "tender", "fun run", "jalan sehat", "lomba", "hut", "ulang tahun")
MONTHS = ("januari", "februari", "maret", "april", "mei", "juni", "juli", "agustus", "september", "oktober", "november", "desember")
#: States of readiness and reasons, in their order.
STATES = ("NEEDS_DATA_REVIEW", "EXPIRED_OR_HISTORICAL", "READY_FOR_HUMAN_QUALIFICATION", "NEEDS_MORE_INFORMATION", "LOW_PRODUCT_RELEVANCE")
REASONS = (
    "SOURCE_MISSING", "SOURCE_INVALID", "TITLE_UNINFORMATIVE", "ORGANIZATION_UNCLEAR", "NEED_EVIDENCE_WEAK", "PRODUCT_NEED_UNCONFIRMED", "PRODUCT_FIT_WEAK",
    "DATE_EXPIRED", "DATE_UNKNOWN", "QUALITY_REVIEW_REQUIRED", "NEXT_ACTION_UNCLEAR", "READY_FOR_HUMAN_REVIEW", "HISTORICAL_REFERENCE",
)
#: States that only a person may give.
DISALLOWED_STATES = ("QUALIFIED", "WON", "LOST", "REJECTED")


def rule_errors(raw) -> list[str]:
    """All errors of a file of readiness rules at once; an empty list means that it may be used."""
    if not isinstance(raw, dict):
        return ["an object is needed"]
    errors = [] if str(raw.get("version") or "").strip() else ["version: is missing"]
    states = raw.get("states")
    if not isinstance(states, list):
        errors.append("states: a list is needed")
    held = [s.get("code") for s in states if isinstance(s, dict)] if isinstance(states, list) else []
    errors += [f"states: {s} is missing" for s in STATES if s not in held]
    errors += [f"states: {s} is not allowed" for s in DISALLOWED_STATES if s in held]
    reasons = raw.get("reason_codes")
    if not isinstance(reasons, dict):
        errors.append("reason_codes: an object is needed")
    errors += [f"reason_codes: {c} is missing" for c in REASONS if not (reasons if isinstance(reasons, dict) else {}).get(c)]
    actions, mapped = raw.get("allowed_next_actions"), raw.get("next_action_map")
    if mapped is not None and not isinstance(mapped, dict):
        errors.append("next_action_map: an object is needed")
    if actions is not None and not isinstance(actions, list):
        errors.append("allowed_next_actions: a list is needed")
    mapped = mapped if isinstance(mapped, dict) else {}
    if isinstance(actions, list):
        errors += [f"next_action_map: {a} is not allowed" for a in dict.fromkeys(mapped.values()) if a not in actions]
    return errors


def load_rules(raw: dict) -> dict:
    """The rules of a file; a file with errors is refused with all of them."""
    if errors := rule_errors(raw):
        raise ValueError("; ".join(errors))
    return raw


def _words(folded: Column) -> Column:
    return F.filter(F.split(folded, " "), lambda w: w != "")


def _has(c: Column) -> Column:
    return F.coalesce(has_text(c), F.lit(False))


def title_too_short(title: Column, generic=GENERIC_TITLES) -> Column:
    """A generic title, one word of less than 10 characters or two of at most 8 together; a blank title is not short."""
    t = fold_loose(title)
    n = F.size(_words(t))
    return (t != "") & (t.isin(*generic) | ((n == 1) & (F.length(t) < 10)) | ((n == 2) & (F.length(t) <= 8)))


def malformed_title(title: Column, source: Column) -> Column:
    """A feed's tail is left: the media's name, a URL or a domain."""
    tail = title.rlike(r"(?i)\s-\shttps?://\S+\s*$") | title.rlike(r"\s-\s[A-Za-z0-9.-]+\.[A-Za-z]{2,}\s*$")
    return (strip_suffix(title, media_name(F.coalesce(source, F.lit("")))) != F.btrim(title)) | tail


def long_without_spaces(title: Column) -> Column:
    t = F.btrim(title)
    return ((F.length(t) > 80) & ~t.rlike(r"\s")) | t.rlike(r"\S{91}")


def suspected_organization(organization: Column, title: Column) -> Column:
    """Not in the title, over eight words, words of URLs or topics, or a stop word after the first word."""
    o, t = fold_loose(organization), fold_loose(F.coalesce(title, F.lit("")))
    later = F.exists(F.transform(_words(o), lambda w, i: (i > 0) & w.isin(*NAME_STOP_WORDS)), lambda x: x)
    odd = organization.rlike(r"(?i)\b(?:https?|www|google news rss|rss)\b") | organization.rlike(rf"(?i)\b(?:{'|'.join(NAME_TOPICS)})\b")
    return _has(organization) & F.coalesce(((t != "") & ~F.contains(t, o)) | (F.size(_words(o)) > 8) | odd | later, F.lit(False))


def suspected_location(location: Column, title: Column) -> Column:
    """Not in the title, over four words, with a digit, a month or words of URLs."""
    c, t = fold_loose(location), fold_loose(F.coalesce(title, F.lit("")))
    odd = location.rlike(r"\d") | F.exists(_words(c), lambda w: w.isin(*MONTHS)) | location.rlike(r"(?i)\b(?:https?|www|rss)\b")
    return _has(location) & F.coalesce(((t != "") & ~F.contains(t, c)) | (F.size(_words(c)) > 4) | odd, F.lit(False))


def review_items(items: DataFrame, reference: Column, old_days: int = 1095) -> DataFrame:
    """Append issue_codes (in the fixed order) and severity to items of (id, type, title, source, link, date, organization, location).

    Nulls count as blank. Duplicate titles are counted by key first and joined back, so no group meets in one task.
    """
    title, blank = F.coalesce("title", F.lit("")), lambda c: ~_has(F.col(c))
    at = dates.parse_time(F.col("date"))
    key = title_key(title, F.coalesce("source", F.lit("")))
    rows = items.withColumn("__key", F.when(F.length(key) >= 12, F.sha2(F.concat_ws("\n", "type", key), 256)))
    rows = flag_duplicates(rows, F.col("__key"), out="__dup")
    tests = {
        "MISSING_TITLE": blank("title"),
        "TITLE_TOO_SHORT": title_too_short(title),
        "MISSING_SOURCE": blank("source"),
        "MISSING_LINK": blank("link"),
        "MALFORMED_RSS_TITLE": _has(title) & malformed_title(title, F.col("source")),
        "LONG_TITLE_WITHOUT_SPACES": _has(title) & long_without_spaces(title),
        "DUPLICATE_NORMALIZED_TITLE": F.col("__dup"),
        "SUSPECTED_ORGANIZATION_EXTRACTION": suspected_organization(F.col("organization"), title),
        "SUSPECTED_LOCATION_EXTRACTION": suspected_location(F.col("location"), title),
        "OLD_ITEM": dates.is_older_than(at, reference, old_days),
        "INVALID_DATE": reduce(lambda a, b: a | b, [_has(F.col(c)) & dates.parse_time(F.col(c)).isNull() for c in ("date", "published", "event_date") if c in items.columns]),
        "INCOMPLETE_CORE_FIELDS": blank("title") | blank("source") | blank("link"),
    }
    out = rows.withColumn("issue_codes", issue_codes({k: tests[k] for k in ISSUES}))
    return out.withColumn("severity", severity(F.col("issue_codes"), "MISSING_TITLE", "MISSING_LINK", "MISSING_SOURCE", list(MEDIUM))).drop("__key", "__dup")


def review_queue(reviewed: DataFrame, most: int = 500) -> DataFrame:
    """The items with issues, gravest and newest first, undated ones last within a severity: a top-k report."""
    at = dates.parse_time(F.col("date"))
    return reviewed.where(F.size("issue_codes") > 0).orderBy(severity_rank(F.col("severity")), at.desc_nulls_last(), "title", "id").limit(most)


def _terms(loose: Column, groups) -> Column:
    flat = {t for g in groups.values() for t in g} if isinstance(groups, dict) else set(groups)
    return matched_terms(loose, sorted(flat), boundary_term)


def checks(items: DataFrame, rules: dict, reference: Column) -> DataFrame:
    """Append ``checks``, a struct of the eight checks (pass, fail, unknown), to items that carry the severity of their review.

    ``rules`` is a rule file: product_relevance_terms, indirect_product_fit_terms, need_evidence_terms (grouped terms),
    counter_signal_terms, generic_organization_terms, organization_artifact_terms, expired_threshold_days and, under
    checks, TITLE_INFORMATIVE and DATA_QUALITY_ACCEPTABLE. Terms are looked for in title, source, organization and the
    optional column ``metadata``.
    """
    title_rule = rules.get("checks", {}).get("TITLE_INFORMATIVE", {})
    blocking = rules.get("checks", {}).get("DATA_QUALITY_ACCEPTABLE", {}).get("blocking_severities", ["high", "medium"])
    days = int(rules.get("expired_threshold_days") or 0)
    held = [c for c in ("title", "source", "organization", "metadata") if c in items.columns]
    rows = items.withColumn("__s", fold_loose(F.concat_ws(" ", *[F.col(c) for c in held])))
    found = {k: _terms(F.col("__s"), rules.get(k) or []) for k in ("need_evidence_terms", "product_relevance_terms", "indirect_product_fit_terms", "counter_signal_terms")}
    hit = {k: F.size(c) > 0 for k, c in found.items()}
    title, org, at = F.coalesce("title", F.lit("")), F.coalesce("organization", F.lit("")), dates.parse_time(F.col("date"))
    t, o = fold_loose(title), fold_loose(org)
    short = (F.length(t) < int(title_rule.get("min_chars") or 10)) | ((F.size(_words(t)) < int(title_rule.get("min_words") or 2)) & (F.length(t) < 16))
    bad_title = (t == "") | _in(t, title_rule.get("generic_titles")) | short | long_without_spaces(title) | title.rlike(r"(?i)\s-\shttps?://\S+\s*$")
    artifact = F.exists(F.transform(_words(o), lambda w, i: (i > 0) & _in(w, rules.get("organization_artifact_terms"))), lambda x: x)
    bad_org = _in(o, rules.get("generic_organization_terms")) | artifact | org.rlike(r"(?i)\b(?:https?|www|rss|google news rss)\b")
    traceable = _has(F.col("source")) & F.coalesce(F.btrim("link").rlike(r"(?i)^https?://\S+$"), F.lit(False))
    expired = dates.is_older_than(at, reference, days) if days > 0 else F.lit(False)
    none = F.lit(False)
    made = {
        "source_traceable": tri_state(traceable, none),
        "title_informative": tri_state(~bad_title, none),
        "organization_identifiable": tri_state(~bad_org, F.btrim(org) == ""),
        "need_evidence_present": F.when(hit["need_evidence_terms"] & ~hit["counter_signal_terms"], "pass").otherwise("unknown"),
        "product_fit_plausible": F.when(hit["product_relevance_terms"], "pass").when(hit["indirect_product_fit_terms"], "unknown").otherwise("fail"),
        "timing_actionable": tri_state(~expired, at.isNull()),
        "data_quality_acceptable": tri_state(~F.coalesce(F.col("severity").isin(*blocking), F.lit(False)), none),
        "next_action_possible": F.lit("pass"),
    }
    return rows.withColumn("checks", F.struct(*[c.alias(k) for k, c in made.items()])).drop("__s")


def _in(c: Column, terms) -> Column:
    flat = sorted({fold_term_loose(t) for t in terms or []})
    return c.isin(*flat) if flat else F.lit(False)


def state(c: Column) -> Column:
    """State of an item from its checks, first that applies; an unknown date alone does not keep an item from being ready."""
    ok = lambda *names: reduce(lambda a, b: a & b, [c[n] == "pass" for n in names])
    core = ok("source_traceable", "title_informative", "organization_identifiable", "need_evidence_present")
    return (
        F.when(c["data_quality_acceptable"] == "fail", STATES[0])
        .when(c["timing_actionable"] == "fail", STATES[1])
        .when(core & ok("product_fit_plausible"), STATES[2])
        .when(~core | (c["product_fit_plausible"] == "unknown") | (c["timing_actionable"] == "unknown"), STATES[3])
        .otherwise(STATES[4])
    )


def reasons(c: Column, of_state: Column) -> Column:
    """Reason codes of the checks and the state, in the fixed order."""
    untraced, expired = c["source_traceable"] == "fail", c["timing_actionable"] == "fail"
    tests = {
        "SOURCE_MISSING": untraced,
        "SOURCE_INVALID": untraced,
        "TITLE_UNINFORMATIVE": c["title_informative"] == "fail",
        "ORGANIZATION_UNCLEAR": c["organization_identifiable"] != "pass",
        "NEED_EVIDENCE_WEAK": c["need_evidence_present"] != "pass",
        "PRODUCT_NEED_UNCONFIRMED": c["product_fit_plausible"] == "unknown",
        "PRODUCT_FIT_WEAK": c["product_fit_plausible"] == "fail",
        "DATE_EXPIRED": expired,
        "DATE_UNKNOWN": c["timing_actionable"] == "unknown",
        "QUALITY_REVIEW_REQUIRED": c["data_quality_acceptable"] == "fail",
        "NEXT_ACTION_UNCLEAR": c["next_action_possible"] != "pass",
        "READY_FOR_HUMAN_REVIEW": of_state == "READY_FOR_HUMAN_QUALIFICATION",
        "HISTORICAL_REFERENCE": expired,
    }
    return issue_codes({k: tests[k] for k in REASONS})


def readiness(items: DataFrame, rules: dict, reference: Column) -> DataFrame:
    """Append checks, readiness_state, reason_codes, suggested_next_action and human_decision_required."""
    mapping, fallback = rules.get("next_action_map") or {}, "VERIFY_SOURCE"
    allowed = set(rules.get("allowed_next_actions") or mapping.values())
    pick = lambda code: F.lit(mapping[code] if mapping.get(code) in allowed else fallback)
    of = lambda c, codes, default: reduce(lambda a, k: a.when(c == k, pick(k)), codes, F.when(F.lit(False), fallback)).otherwise(default)
    rows = checks(items, rules, reference).withColumn("readiness_state", state(F.col("checks")))
    rows = rows.withColumn("reason_codes", reasons(F.col("checks"), F.col("readiness_state")))
    known = [r for r in REASONS if r in mapping]
    first = F.try_element_at(F.filter("reason_codes", lambda r: r.isin(*known)), F.lit(1)) if known else F.lit(None).cast("string")
    by_state = of(F.col("readiness_state"), [s for s in STATES if s in mapping], F.lit(fallback))
    unconfirmed = F.array_contains("reason_codes", "PRODUCT_NEED_UNCONFIRMED")
    more = F.when(unconfirmed, pick("PRODUCT_NEED_UNCONFIRMED") if "PRODUCT_NEED_UNCONFIRMED" in mapping else by_state).when(first.isNotNull(), of(first, known, F.lit(fallback))).otherwise(by_state)
    action = F.when(F.col("readiness_state") == "NEEDS_MORE_INFORMATION", more).otherwise(by_state)
    return rows.withColumn("suggested_next_action", action).withColumn("human_decision_required", F.lit(True))


def readiness_summary(ready: DataFrame) -> DataFrame:
    """(dim, value, n): items of each state, all states listed, and of each reason that occurs."""
    pairs = F.explode(F.concat(F.array(F.struct(F.lit("state").alias("dim"), F.col("readiness_state").alias("value"))).cast(_PAIRS), F.transform("reason_codes", lambda r: F.struct(F.lit("reason"), r)).cast(_PAIRS)))
    counts = ready.select(pairs.alias("p")).groupBy("p.dim", "p.value").agg(F.count("*").alias("n"))
    zero = ready.sparkSession.createDataFrame([("state", s, 0) for s in STATES], "dim string, value string, n long")
    return counts.unionByName(zero).groupBy("dim", "value").agg(F.sum("n").alias("n"))


_PAIRS = "array<struct<dim:string,value:string>>"
