"""Laws of finished outputs, the refresh item by item, validators and the small pieces of reports."""

import copy
import json
import random

import pytest
from pyspark.sql import functions as F

from headwater.functions import rules, text
from headwater.operators import contracts, diff, items, quality, review, signals
from headwater.operators.durable import shared_folder
from headwater.sources import sinks

RULES = rules.RuleSet(
    (
        rules.Trigger("NEW", "direct", phrases=("new plant",), positive=("tender",), actions=("VERIFY_TIMING",), label="New", hypotheses=("a", "b")),
        rules.Trigger("OLD", "historical", phrases=("old case",), actions=("ADD_TO_WATCHLIST",), label="Old"),
    )
)


def made(spark):
    rows = [
        ("1", "tender", "New plant tender opens", "feed", "https://h.example/1", "2026-07-01", None, "", "2026-07-01", None),
        ("2", "official", "Old case of a ministry", "Press", "https://h.example/2", "2026-07-01", "A ministry", "", "2026-07-01", "About a new plant"),
    ]
    df = spark.createDataFrame(rows, "id string, type string, title string, source string, link string, date string, organization string, event_date string, published string, excerpt string")
    shared_folder(spark, "")
    s = signals.build_signals(df, RULES, F.lit("2026-07-12").cast("date"))
    told = F.struct(*[F.lit("x").alias(f) for f in contracts.PROVENANCE])
    return s.withColumn("source_code", F.when(F.col("type") == "official", "S")).withColumn("official_provenance", F.when(F.col("type") == "official", told)).checkpoint()


def trigger(change):
    return F.transform("triggers", change)


def evidence(change):
    return trigger(lambda t: t.withField("matched_evidence", F.transform(t["matched_evidence"], change)))


#: law -> (id of the row that breaks it, column, its new value)
BROKEN = {
    "origin_known": ("1", "data_origin", lambda: F.lit("x")),
    "official_provenance_complete": ("2", "source_code", lambda: F.lit(" ")),
    "publisher_is_no_organization": ("2", "organization", lambda: F.col("source")),
    "feed_has_no_official_provenance": ("1", "official_provenance", lambda: F.struct(*[F.lit("x").alias(f) for f in contracts.PROVENANCE])),
    "review_by_a_person": ("1", "human_review_required", lambda: F.lit(False)),
    "timing_known": ("1", "timing_status", lambda: F.lit(None).cast("string")),
    "has_triggers": ("1", "triggers", lambda: F.slice("triggers", 1, 0)),
    "primary_is_a_trigger": ("1", "primary_trigger", lambda: F.lit("OLD")),
    "action_allowed": ("1", "suggested_next_action", lambda: F.lit("SEND_EMAIL")),
    "trigger_known": ("1", "triggers", lambda: trigger(lambda t: t.withField("trigger_code", F.lit("X")))),
    "trigger_class_of_rule": ("1", "triggers", lambda: trigger(lambda t: t.withField("trigger_class", F.lit("indirect")))),
    "strength_known": ("1", "triggers", lambda: trigger(lambda t: t.withField("evidence_strength", F.lit("HUGE")))),
    "terms_present": ("1", "triggers", lambda: trigger(lambda t: t.withField("matched_terms", F.slice(t["matched_terms"], 1, 0)))),
    "evidence_present": ("1", "triggers", lambda: trigger(lambda t: t.withField("matched_evidence", F.slice(t["matched_evidence"], 1, 0)))),
    "terms_have_evidence": ("1", "triggers", lambda: trigger(lambda t: t.withField("matched_terms", F.array(F.lit("unseen"))))),
    "evidence_valid": ("1", "triggers", lambda: evidence(lambda e: e.withField("excerpt", F.repeat(F.lit("y"), 301)))),
    "title_evidence_from_title": ("1", "triggers", lambda: evidence(lambda e: e.withField("excerpt", F.lit("not there")))),
    "feed_evidence_from_title": ("1", "triggers", lambda: evidence(lambda e: e.withField("field", F.lit("excerpt")))),
    "excerpt_valid": ("1", "triggers", lambda: trigger(lambda t: t.withField("evidence_excerpt", F.lit(" ")))),
    "trigger_review_by_a_person": ("1", "triggers", lambda: trigger(lambda t: t.withField("human_review_required", F.lit(False)))),
    "hypotheses_of_rule": ("1", "triggers", lambda: trigger(lambda t: t.withField("product_hypotheses", F.array(F.lit("b"), F.lit("a"))))),
    "no_score": ("1", "link", lambda: F.col("link")),
}


def test_every_law_of_a_signal_has_a_row_that_breaks_it(spark):
    s = made(spark)
    assert contracts.signal_violations(s, RULES).collect() == []
    assert set(BROKEN) == {*contracts.signal_laws(RULES), "no_score"}
    rows = None
    for law, (at, name, value) in BROKEN.items():
        one = s.where(F.col("id") == at).withColumn(name, value()).withColumn("id", F.lit(law))
        one = one.withColumn("details", F.when(F.lit(law == "no_score"), F.array(F.struct(F.lit(1).alias("Total_Score")))))
        rows = one if rows is None else rows.unionByName(one)
    found = {}
    for r in contracts.signal_violations(rows, RULES).collect():
        found.setdefault(r.id, set()).add(r.law)
    assert all(law in found[law] for law in BROKEN)
    alone = {law for law, laws in found.items() if laws == {law}}
    assert len(alone) >= 15
    twice = s.unionByName(s.where("id = '1'"))
    assert [tuple(r) for r in contracts.signal_violations(twice, RULES).collect()] == [("1", "id_unique")]


def test_summaries_are_counted_anew(spark):
    s = made(spark)
    told = signals.trigger_summary(s, RULES)
    assert contracts.summary_differences(s, told, RULES).collect() == []
    wrong = told.where("NOT (data_origin = 'all' AND value = 'OLD')").withColumn("n", F.when((F.col("value") == "NEW") & (F.col("data_origin") == "all"), 9).otherwise(F.col("n")))
    got = {(r.dim, r.value, r.told, r.counted) for r in contracts.summary_differences(s, wrong, RULES).collect()}
    assert got == {("code", "NEW", 9, 2), ("code", "OLD", None, 1)}


def test_forbidden_members_of_rows(spark):
    df = spark.createDataFrame([(1, '{"a": 1}', [("x", 2.0)]), (2, "x", [("x", None)])], "k int, j string, l array<struct<n:string,fit_score:double>>")
    assert [(r.k, r.found) for r in contracts.forbidden_in(df, "k").collect()] == [(1, ["fit_score"])]


def readiness_file():
    return {"version": "1", "states": [{"code": c} for c in review.STATES], "reason_codes": dict.fromkeys(review.REASONS, "x"), "allowed_next_actions": ["A"], "next_action_map": {"R": "A"}}


def test_readiness_rules_are_validated_field_by_field():
    assert review.rule_errors(readiness_file()) == [] and review.load_rules(readiness_file())["version"] == "1"
    changes = {
        "version": lambda r: r.update(version=" "),
        "states: a list": lambda r: r.update(states=None),
        f"states: {review.STATES[2]}": lambda r: r["states"].pop(2),
        "states: WON is not": lambda r: r["states"].append({"code": "WON"}),
        f"reason_codes: {review.REASONS[4]}": lambda r: r["reason_codes"].pop(review.REASONS[4]),
        "reason_codes: an object": lambda r: r.update(reason_codes=[]),
        "next_action_map: B": lambda r: r["next_action_map"].update(X="B"),
        "next_action_map: an object": lambda r: r.update(next_action_map=3),
        "allowed_next_actions": lambda r: r.update(allowed_next_actions="A"),
    }
    every = readiness_file()
    for start, change in changes.items():
        raw = copy.deepcopy(readiness_file())
        change(raw)
        assert any(e.startswith(start) for e in review.rule_errors(raw)), start
        if "an object" not in start and "a list" not in start and start != "allowed_next_actions":
            change(every)
    assert len(review.rule_errors(every)) == 5
    assert review.rule_errors([]) == ["an object is needed"]
    raw = readiness_file()
    del raw["allowed_next_actions"]  # then every mapped action is allowed
    assert review.rule_errors(raw) == []
    with pytest.raises(ValueError, match="version"):
        review.load_rules({})


ITEM = "id string, source_code string, source_name string, title string, link string, published_at string, organization_hint string, excerpt string, provenance struct<a:string>, quality struct<b:boolean>, classification_hint struct<code:string>, content_hash string"


def test_refresh_changes_against_a_loop(spark):
    rng = random.Random(3)

    def item(i):
        pick = lambda *v: rng.choice(v)
        return (f" {i} " if i % 5 == 0 else str(i), "s", None, pick("t", " t ", None), pick("l", "m"), pick(None, "d"), pick("o", None), pick("e" * 600, None), pick(None, ("x",), ("y",)), pick((True,), (False,)), pick(("c",), None), pick("h", "g"))

    old, new = ([item(i) for i in range(a, b)] for a, b in ((0, 60), (20, 80)))
    old += [("  ", *old[0][1:]), (None, *old[0][1:])]
    got = {r.id: r for r in diff.refresh_diff(spark.createDataFrame(old, ITEM), spark.createDataFrame(new, ITEM)).collect()}
    names = [c.split()[0] for c in ITEM.split(", ")]
    a, b = ({r[0].strip(): dict(zip(names, r)) for r in side if r[0] and r[0].strip()} for side in (old, new))
    assert set(got) == a.keys() | b.keys()
    for i, r in got.items():
        fields = sorted(f for fs in diff.CHANGE_RULES.values() for f in fs if i in a and i in b and a[i][f] != b[i][f])
        want = "ADDED" if i not in a else "REMOVED" if i not in b else "CHANGED" if fields else "UNCHANGED"
        assert (r.change, r.changed_fields, r.reasons) == (want, fields, sorted(k for k, fs in diff.CHANGE_RULES.items() if set(fs) & set(fields)))
        for side, held in ((a, r.old_item), (b, r.new_item)):
            if i not in side:
                assert held is None
            else:
                assert tuple(held.asDict()) == diff.SNAPSHOT_FIELDS and len(held.excerpt) <= 500 and held.title in ("t", "") and held.source_name == "" and held.id == i
    assert len({k for r in got.values() for k in r.reasons}) == 7


def test_reports_are_ordered(spark):
    rows = spark.createDataFrame([("b", 2), ("a", 2), ("c", 5), ("10", 1), ("z", 0)], "key string, n long")
    assert [r.key for r in quality.ordered_counts(rows).collect()] == ["c", "a", "b", "10", "z"]
    assert [r.key for r in quality.ordered_counts(rows, rank=["z", "b"]).collect()] == ["z", "b", "c", "a", "10"]
    df = spark.createDataFrame([("2", "a"), ("1", "b"), ("1", "a")], "id string, title string")
    assert [tuple(r) for r in diff.ordered(df).collect()] == [("1", "a"), ("1", "b"), ("2", "a")]


def test_dashboard_choices(spark):
    s = made(spark)
    ids = lambda **chosen: [r.id for r in items.dashboard_facets(s, chosen).orderBy("id").collect()]
    assert ids() == ["1", "2"] and ids(type="official") == ["2"] and ids(category="NEW") == ["1", "2"] and ids(category="OLD", **{"class": "direct"}) == ["2"] and ids(origin="tender_corpus", source_code="") == ["1"]
    with pytest.raises(ValueError):
        ids(price="1")


def test_unique_texts(spark):
    df = spark.createDataFrame([([" a", "", None, "b", "a ", "B"],), (None,), ([],)], "v array<string>")
    assert [r.u for r in df.select(text.unique_texts(F.col("v")).alias("u")).collect()] == [["a", "b", "B"], [], []]


def test_summary_documents():
    counts = {"baseline_total": 4, "added_count": 2, "date_completeness_percent": 80.0, "production_unchanged": True}
    page = sinks.source_markdown("REVIEW_REQUIRED", counts, {"source_code": "S", "status": "HEALTHY"}, ["S"], [], ["W:1"], [])
    for line in ("- Source: S", "- Source fetched: S", "- Rejected source excluded: NONE", "- Added: 2", "- Date completeness: 80.0%", "- Production unchanged: true", "- Acceptance recommendation: **REVIEW_REQUIRED**", "- W:1", "- None"):
        assert line in page.split("\n")
    assert "- Production gate: PASS" in sinks.trigger_markdown("X", {"production_change_count": 0, "new_trigger_count": 3}) and "- Production gate: FAIL" in sinks.trigger_markdown("X", {"production_change_count": 1})
    json.dumps(page)


def test_names_found_by_words_of_any_script(spark):
    from headwater.functions.rules import first_in_list

    df = spark.createDataFrame([("_Solo",), ("in SOLO!",), ("É solo",), ("soló",), ("ÉCOLE",)], "t string")
    assert [r.n for r in df.select(first_in_list(F.col("t"), ("Solo", "école")).alias("n")).collect()] == [None, "Solo", "Solo", None, "école"]
