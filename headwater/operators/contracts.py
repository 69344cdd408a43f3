"""What a finished output must fulfil: laws of every signal, of its triggers and evidence, and of the summary beside it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headwater.functions.guards import forbidden_members, json_members
from headwater.functions.rules import FORBIDDEN, ORIGINS, STRENGTHS, TIMING, RuleSet
from headwater.functions.text import fold_search, has_text
from headwater.operators.signals import DATA_ORIGIN, trigger_summary

#: What the record of an official source must tell, the fields that evidence may come from, and the longest excerpt.
PROVENANCE = ("source_name", "official_domain", "detail_url", "published_at", "retrieval_method")
EVIDENCE_FIELDS, EXCERPT = ("title", "excerpt"), 300


def _text(c: Column) -> Column:
    return F.coalesce(has_text(c), F.lit(False))


def _of_rule(rules: RuleSet, code: Column, value) -> Column:
    """A value of the rule that has this code, null if none has."""
    return reduce(lambda a, r: a.when(code == r.code, value(r)), rules.triggers, F.when(F.lit(False), value(rules.triggers[0])))


def signal_laws(rules: RuleSet) -> dict[str, Column]:
    """Conditions on a row (id, title, data_origin, source, organization, source_code, official_provenance, triggers, primary_trigger, timing_status, suggested_next_action, human_review_required).

    Null counts as broken. ``official_provenance`` is a struct; signals of feeds have none.
    """
    official = F.coalesce(F.col("data_origin") == DATA_ORIGIN["official"], F.lit(False))
    whole = reduce(lambda a, f: a & _text(F.col(f"official_provenance.{f}")), PROVENANCE, F.col("official_provenance").isNotNull() & _text(F.col("source_code")))
    named = _text(F.col("organization")) & (F.col("organization") == F.col("source"))
    actions = sorted({a for r in rules.triggers for a in r.actions} - set(FORBIDDEN))

    def evidence(t: Column, test) -> Column:
        return F.forall(t["matched_evidence"], lambda e: F.coalesce(test(e), F.lit(False)))

    def shown(t: Column) -> Column:
        forms = F.transform(t["matched_evidence"], lambda e: fold_search(e["term"]))
        return F.forall(t["matched_terms"], lambda m: F.array_contains(forms, fold_search(m)))

    each = lambda test: F.forall("triggers", lambda t: F.coalesce(test(t), F.lit(False)))
    text_array = lambda values: F.array(*map(F.lit, values)).cast("array<string>")
    return {
        "origin_known": F.col("data_origin").isin(*ORIGINS),
        "official_provenance_complete": ~official | whole,
        "publisher_is_no_organization": ~official | ~F.coalesce(named, F.lit(False)),
        "feed_has_no_official_provenance": official | F.col("official_provenance").isNull(),
        "review_by_a_person": F.col("human_review_required"),
        "timing_known": F.col("timing_status").isin(*TIMING),
        "has_triggers": F.size("triggers") > 0,
        "primary_is_a_trigger": F.exists("triggers", lambda t: t["trigger_code"] == F.col("primary_trigger")),
        "action_allowed": F.col("suggested_next_action").isin(*actions),
        "trigger_known": each(lambda t: t["trigger_code"].isin(*[r.code for r in rules.triggers])),
        "trigger_class_of_rule": each(lambda t: t["trigger_class"] == _of_rule(rules, t["trigger_code"], lambda r: F.lit(r.trigger_class))),
        "strength_known": each(lambda t: t["evidence_strength"].isin(*STRENGTHS)),
        "terms_present": each(lambda t: F.size(t["matched_terms"]) > 0),
        "evidence_present": each(lambda t: F.size(t["matched_evidence"]) > 0),
        "terms_have_evidence": each(shown),
        "evidence_valid": each(lambda t: evidence(t, lambda e: _text(e["term"]) & e["field"].isin(*EVIDENCE_FIELDS) & _text(e["excerpt"]) & (F.length(e["excerpt"]) <= EXCERPT))),
        "title_evidence_from_title": each(lambda t: evidence(t, lambda e: (e["field"] != "title") | F.contains(F.col("title"), e["excerpt"]))),
        "feed_evidence_from_title": official | each(lambda t: evidence(t, lambda e: e["field"] == "title")),
        "excerpt_valid": each(lambda t: _text(t["evidence_excerpt"]) & (F.length(t["evidence_excerpt"]) <= EXCERPT)),
        "trigger_review_by_a_person": each(lambda t: t["human_review_required"]),
        "hypotheses_of_rule": each(lambda t: t["product_hypotheses"] == _of_rule(rules, t["trigger_code"], lambda r: text_array(r.hypotheses))),
    }


def signal_violations(signals: DataFrame, rules: RuleSet) -> DataFrame:
    """(id, law) of every law that a signal breaks, and ``id_unique`` and ``no_score`` beside those of ``signal_laws``.

    One pass over the signals, and an aggregate of their ids.
    """
    absent = [F.lit(None).cast(kind).alias(n) for n, kind in (("source_code", "string"), ("official_provenance", f"struct<{','.join(f'{f}:string' for f in PROVENANCE)}>")) if n not in signals.columns]
    rows = signals.select("*", *absent)
    scores = F.filter(json_members(F.to_json(F.struct(*signals.columns))), lambda m: m["key"].rlike("(?i)score") & m["is_number"])
    laws = signal_laws(rules) | {"no_score": F.size(scores) == 0}
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in laws.items()]))
    twice = signals.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id", F.lit("id_unique").alias("law"))
    return rows.select("id", F.explode(broken).alias("law")).unionByName(twice)


def summary_differences(signals: DataFrame, summary: DataFrame, rules: RuleSet) -> DataFrame:
    """(data_origin, dim, value, told, counted) where a summary (data_origin, dim, value, n) does not say what its signals add up to."""
    told = summary.select("data_origin", "dim", "value", F.col("n").alias("told"))
    counted = trigger_summary(signals, rules).select("data_origin", "dim", "value", F.col("n").alias("counted"))
    both = told.join(counted, ["data_origin", "dim", "value"], "full_outer")
    return both.where(~F.col("told").eqNullSafe(F.col("counted")))


def forbidden_in(rows: DataFrame, key: str) -> DataFrame:
    """(key, found): the forbidden members of a row's values, at any depth, for rows that have some."""
    members = json_members(F.to_json(F.struct(*[c for c in rows.columns if c != key])))
    return rows.select(F.col(key), forbidden_members(members).alias("found")).where(F.size("found") > 0)
