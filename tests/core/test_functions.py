"""Scalar and keyed operators on small rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headwater.functions import dates, guards, html, ids, robots, rules, text
from headwater.operators import dedup, diff, feedback, feeds, items, official, quality, refresh, review, signals
from headwater.plans import catalogue
from headwater.sources import readers, sinks


def one(spark, column, **values):
    schema = ", ".join(f"{k} string" for k in values) or "x string"
    return spark.createDataFrame([tuple(values.values()) or (None,)], schema).select(column.alias("r")).first().r


def test_folding(spark):
    assert one(spark, text.fold_loose(F.col("a")), a="  Café &amp;quot; X ") == 'cafe " x'
    assert one(spark, text.fold_search(F.col("a")), a="Mark-Up: É!") == "mark up e"
    assert one(spark, text.first_text(F.col("a"), F.col("b")), a=" ", b=" y ") == "y"


def test_terms(spark):
    c = F.col("a")
    assert one(spark, text.contains_term(c, "new plant"), a="a new plant opens")
    assert not one(spark, text.contains_term(c, "plan"), a="a new plant opens")
    assert not one(spark, text.contains_term(c, " "), a="x")
    assert one(spark, text.boundary_term(c, "mark-up"), a="a mark-up, b")
    assert one(spark, text.ordered_context(c, ["invite"], ["attend"]), a="we invite all to attend")
    assert not one(spark, text.ordered_context(c, ["invite"], ["attend"]), a="attend and invite")


def test_suffix(spark):
    assert one(spark, text.strip_suffix(F.col("a"), text.media_name(F.col("b"))), a="Big news - The Post - thepost.com", b="Feed (The Post)") == "Big news"
    assert one(spark, text.strip_suffix(F.col("a"), F.lit("")), a="A - B") == "A - B"


def test_html(spark):
    page = "<title>T &amp; U</title><script>x<b></script><p>&lt;b&gt; &#65;&#x42; &amp;lt;</p><a class='x' href='/p?q=1#f'>L</a>"
    assert one(spark, html.clean_text(F.col("a")), a=page) == "T & U <b> AB &lt; L"
    assert one(spark, html.tag_text(F.col("a"), "title"), a=page) == "T & U"
    assert one(spark, F.transform(html.anchors(F.col("a")), lambda x: html.attribute(x, "href")), a=page) == ["/p?q=1#f"]
    assert one(spark, html.meta_content(F.col("a"), "description"), a='<meta content="d" name="description">') == "d"
    assert one(spark, html.resolve_url(F.lit("/p#f"), F.col("a")), a="https://h.example/x/y") == "https://h.example/p"
    assert one(spark, html.normalize_url(F.col("a")), a="HTTPS://H.example//a//b/?z=1&utm_source=x&a=2#f") == "https://h.example/a/b?a=2&z=1"
    assert one(spark, html.redact(F.col("a")), a="see https://x.y/z token=abc <b>") == "see [url] token=[redacted]"


@pytest.mark.parametrize(
    ("raw", "value", "status"),
    [("12 Juli 2026", "2026-07-12", "valid"), ("2026-02-30", "", "invalid"), ("", "", "missing"), (None, "", "missing"), ("soon", "", "invalid"), ("2026-02-30 atau 1 maret 2026", "2026-03-01", "valid"), ("12 July 2026", "", "invalid"), ("<b>2026-07-01</b>", "2026-07-01", "valid")],
)
def test_public_date(spark, raw, value, status):
    assert tuple(one(spark, dates.public_date(F.col("a")), a=raw)) == (value, status)


def test_times(spark):
    assert one(spark, dates.parse_time(F.col("a")), a="Sun, 12 Jul 2026 10:00:00 GMT") == dt.datetime(2026, 7, 12, 10)
    day = lambda x: F.lit(x).cast("date")
    assert not one(spark, dates.is_stale(day("2026-05-13"), day("2026-07-12"), 60))
    assert one(spark, dates.is_stale(day("2026-05-12"), day("2026-07-12"), 60))
    assert one(spark, dates.event_date(F.col("a")), a="Run 30-31 Februari 2026") == "2026-02-30"
    assert one(spark, dates.event_date(F.col("a")), a="Run 1 \u2013 2 Mei 2026 ") == "2026-05-01" and one(spark, dates.event_date(F.col("a")), a="Run 5 July 2026") is None
    for title, want in (("on 2026-06-45", True), ("on 2026.7.12", False), ("on 13/07/2026", True), ("12 Juli", False), ("agustus", False), ("1 agustus", False), ("agustus 2026", True), ("\u00e1gustus 2026", True), ("april 31 2026", False), ("32 juli", False), ("x2027", False), (None, False), ("on 2026-08-01", True), ("on 01-02-2026", False), ("in 2027", True), ("5 Agustus", True), ("5 Juni 2026", False), ("none", False)):
        assert one(spark, dates.names_future_date(F.col("a"), day("2026-07-12")), a=title) == want, title


def rule_file(**changes):
    entry = lambda code, kind, **k: {"code": code, "label": code, "description": code, "trigger_class": kind, "positive_terms": [], "phrase_terms": [], "negative_terms": [], "product_hypotheses": [], "allowed_actions": ["VERIFY_TRIGGER"]} | k
    raw = {
        "version": "1", "future_signal_max_published_age_days": 60, "class_precedence": ["direct", "historical", "indirect"],
        "strength_precedence": ["STRONG", "MODERATE", "WEAK"], "timing_statuses": list(rules.TIMING), "allowed_actions": ["VERIFY_TRIGGER", "VERIFY_TIMING", "VERIFY_ORGANIZATION"],
        "timing_rules": {
            "future_or_open_phrases": ["sign-up open"], "invitation_lead_terms": ["come"], "invitation_action_terms": ["join"], "completed_or_past_phrases": ["has been held"],
            "completed_actor_terms": ["runners"], "completed_action_terms": ["enliven"], "completed_passive_terms": ["attended"], "completed_quantity_terms": ["thousands"], "ambiguous_verbs": ["hold"],
        },
        "editorial_rules": {"terms": ["tips"], "suppressed_trigger_codes": ["OPEN"]},
        "primary_trigger_rules": {"active_direct_terms": ["plans"], "historical_dominant_terms": ["audit"]},
        "triggers": [
            entry("OPEN", "indirect", positive_terms=["opens", "Hall", "hall"], negative_terms=["closed"]),
            entry("HISTORICAL_PROCUREMENT_PATTERN", "historical", phrase_terms=["court case"]),
            entry("DIRECT_PROCUREMENT", "direct", phrase_terms=["will buy"], context_required_terms=["will buy"], context_terms=["uniforms"]),
            entry("NEWS", "indirect", positive_terms=["zone"], origin_scope=["official_source_pilot"]),
        ],
    }
    return raw | changes


def test_rule_file():
    assert rules.validate(rule_file()) == []
    bad = rule_file(version=" ", class_precedence=["direct"], future_signal_max_published_age_days=True, allowed_actions=["SEND_EMAIL"], editorial_rules={"terms": [""], "suppressed_trigger_codes": ["NONE"]})
    bad["triggers"] = [*bad["triggers"], {"code": "OPEN", "trigger_class": "odd"}, 3]
    found = rules.validate(bad)
    for part in ("version", "class_precedence", "future_signal", "SEND_EMAIL is forbidden", "editorial_rules.terms", "NONE is no trigger", "OPEN: stands twice", "trigger_class", "triggers[5]"):
        assert any(part in e for e in found), part
    assert rules.validate([]) and rules.validate({})
    with pytest.raises(ValueError, match="version"):
        rules.load(bad)


def test_rules(spark):
    good = rules.load(rule_file())
    c = F.col("a")
    found = lambda t, **k: {d.code: d.strength for d in one(spark, rules.detect_all(c, good, **k), a=t)}
    assert found("hall opens") == {"OPEN": "MODERATE"} and found("hall opens closed") == {} and found("hall") == {"OPEN": "WEAK"}
    assert found("will buy cars") == {} and found("will buy uniforms court case") == {"DIRECT_PROCUREMENT": "STRONG", "HISTORICAL_PROCUREMENT_PATTERN": "STRONG"}
    assert found("will buy uniforms", traceable=F.lit(False)) == {"DIRECT_PROCUREMENT": "MODERATE"}
    assert found("zone", origin=F.lit("tender_corpus")) == {} and found("zone", origin=F.lit("official_source_pilot")) == {"NEWS": "WEAK"}
    assert found("tips hall opens") == {} and found("") == {}
    assert one(spark, rules.editorial_suppressed(c, good), a="tips hall opens closed") and not one(spark, rules.editorial_suppressed(c, good), a="tips only")
    main = lambda t: one(spark, rules.primary(rules.detect_all(c, good), good, c), a=t).code
    assert main("court case hall opens") == "HISTORICAL_PROCUREMENT_PATTERN" and main("will buy uniforms court case") == "DIRECT_PROCUREMENT"
    assert main("audit will buy uniforms court case") == "HISTORICAL_PROCUREMENT_PATTERN" and main("plans audit will buy uniforms court case") == "DIRECT_PROCUREMENT"
    two = {d.code: d.strength for d in one(spark, rules.detect_all([c, F.col("b")], good), a="hall", b="opens")}
    assert two == {"OPEN": "MODERATE"}
    assert one(spark, rules.extract_name(c, [r"PT ([A-Z]\w+(?: \w+)*)"], ["akan"]), a="PT Maju Jaya akan buka") == "Maju Jaya"


@pytest.mark.parametrize(
    ("title", "kind", "event", "published", "state"),
    [
        ("sign up open", "historical", None, None, "HISTORICAL_REFERENCE"),
        ("tips sign up open", "indirect", None, None, "INFORMATIONAL_OR_EDITORIAL"),
        ("tips sign up open", "direct", None, None, "FUTURE_OR_OPEN"),
        ("sign up open", "indirect", "2026-07-11", None, "COMPLETED_OR_PAST"),
        ("has been held", "indirect", "2026-07-12", None, "CURRENT_OR_UNCLEAR"),
        ("has been held", "indirect", "2026-07-13", None, "FUTURE_OR_OPEN"),
        ("sign up open", "indirect", None, "2026-05-13", "FUTURE_OR_OPEN"),
        ("sign up open", "indirect", None, "2026-05-12", "CURRENT_OR_UNCLEAR"),
        ("sign up open 2027", "indirect", None, "2026-05-12", "FUTURE_OR_OPEN"),
        ("come all of you and join", "indirect", None, None, "FUTURE_OR_OPEN"),
        ("join and come", "indirect", None, None, "CURRENT_OR_UNCLEAR"),
        ("runners enliven", "indirect", None, None, "COMPLETED_OR_PAST"),
        ("attended by thousands of runners", "indirect", None, None, "COMPLETED_OR_PAST"),
        ("attended by thousands", "indirect", None, None, "CURRENT_OR_UNCLEAR"),
        ("they hold", "indirect", None, None, "CURRENT_OR_UNCLEAR"),
    ],
)
def test_timing(spark, title, kind, event, published, state):
    good, day = rules.load(rule_file()), lambda x: F.lit(x).cast("date")
    found = rules.timing(F.struct(F.lit(kind).alias("trigger_class")), day(event), day(published), day("2026-07-12"), F.col("a"), good, dates.names_future_date(F.col("a"), day("2026-07-12")))
    assert one(spark, found, a=title) == state


def test_greedy_against_loop(spark):
    rng = random.Random(1)
    rows = [(i, f"g{i % 3}", f"u{rng.randrange(20)}", f"h{rng.randrange(20)}") for i in range(120)] + [(200, "z", "u0", "h1"), (201, "z", "u1", "h1"), (202, "z", "u1", "h9")]
    df = spark.createDataFrame(rows, "i int, g string, u string, h string").withColumns({k: F.concat_ws("/", "g", k) for k in "uh"})
    got = {r.i: r.dropped_by for r in dedup.greedy_shared(df, "i", ["u", "h"]).collect()}
    taken = {}
    for i, g, u, h in rows:
        su, sh = taken.setdefault(g, (set(), set()))
        want = "u" if u in su else "h" if h in sh else ""
        if not want:
            su.add(u)
            sh.add(h)
        assert got[i] == want
    assert (got[200], got[201], got[202]) == ("", "h", "")


def test_greedy_shared_against_loop(spark):
    rng = random.Random(2)
    pick = lambda n: rng.choice([None, "", *map(str, range(n))])
    rows = [(i, f"g{i % 3}", pick(40), f"h{rng.randrange(40)}", pick(25)) for i in range(150)] + [(i, "z", "u", "same", None) for i in range(200, 240)] + [(7, "g1", None, None, "")] * 2 + [(300, "z", "x", "y", "w")] * 3
    df = spark.createDataFrame(rows, "i int, g string, u string, h string, t string").withColumn("t", F.when(F.col("t") != "", F.concat_ws("/", "g", "t")))
    got = sorted((r.i, r.dropped_by) for r in dedup.greedy_shared(df, "i", ["u", "h", "t"]).collect())
    taken, want = (set(), set(), set()), []
    for i, g, u, h, t in sorted(rows, key=lambda r: (r[0], r[2] or "", r[3] or "")):
        values = (u, h, t and f"{g}/{t}")
        reason = next((k for k, s, v in zip("uht", taken, values) if v and v in s), "")
        if not reason:
            for s, v in zip(taken, values):
                s.add(v)
        want.append((i, reason))
    assert got == sorted(want)


def test_greedy_query_sees_texts_of_other_sources(spark, tmp_path):
    rows = [(1, "One text.", "a"), (2, "one TEXT", "b"), (3, "another text", "b"), (4, "another text", "a"), (5, "one text", "a")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.dropped_by for r in catalogue.queries()["greedy_dedup"](spark, str(tmp_path)).collect()}
    assert got == {1: "", 2: "hash", 3: "", 4: "hash", 5: "hash"}


def test_greedy_query_keeps_texts_that_only_open_alike(spark, tmp_path):
    head = "the same twenty four letters and more "
    rows = [(1, head + "one", "a"), (2, head + "two", "a"), (3, head.upper() + "ONE!", "a")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.dropped_by for r in catalogue.queries()["greedy_dedup"](spark, str(tmp_path)).collect()}
    assert got == {1: "", 2: "", 3: "hash"}


def test_diff(spark):
    old = spark.createDataFrame([("keep", "a"), ("change", "a"), ("remove", None)], "id string, v string")
    new = spark.createDataFrame([("keep", "a"), ("change", None), ("add", "b"), ("add2", "b")], "id string, v string")
    got = {r.id: r.change for r in diff.snapshot_diff(old, new, "id", ["v"]).collect()}
    assert got == {"keep": "UNCHANGED", "change": "CHANGED", "remove": "REMOVED", "add": "ADDED", "add2": "ADDED"}
    assert one(spark, diff.percent(F.lit(1), F.lit(0))) == 0


def test_feedback_merge(spark):
    a = spark.createDataFrame([("x", "e1", 1, "KEEP"), ("x", "e2", 2, "DROP")], "item string, event_id string, ts int, decision string")
    b = spark.createDataFrame([("x", "e2", 2, "OTHER"), ("x", "e3", 3, "KEEP")], a.schema)
    merged = feedback.merge_histories(a, b, "item", "event_id")
    assert {r.event_id: r.decision for r in merged.collect()} == {"e1": "KEEP", "e2": "DROP", "e3": "KEEP"}
    s = feedback.current_state(merged, "item", "ts", "event_id", "decision").first()
    assert (s.decision, s.created_at, s.updated_at, s.n_events) == ("KEEP", 1, 3, 3)


FEEDBACK = {
    "schema_version": "1", "storage_key": "s", "reviewer_key": "r", "reason_codes": {"GOOD": "g", "CHECK": "c", "LATER": "l", "OFF": "o"}, "allowed_next_actions": {"VERIFY_SOURCE": "v"}, "validation": {"note_max_length": 10},
    "decision_states": {
        "QUALIFIED": {"reason_codes": ["GOOD"], "requires_next_action": True}, "NEEDS_RESEARCH": {"reason_codes": ["CHECK"]},
        "WATCHLIST": {"reason_codes": ["LATER"], "requires_review_date_or_next_action": True}, "NOT_RELEVANT": {"reason_codes": ["OFF"]},
    },
}
ENTRY = "struct<event_id:string,event_type:string,previous_decision:string,new_decision:string,reason_codes:array<string>,next_action:string,reviewer_alias:string,note:string,timestamp:string>"
RECORD = f"item_id string, human_decision string, reason_codes array<string>, reviewer_alias string, note string, next_action string, review_date string, created_at string, updated_at string, history array<{ENTRY}>"


def record(item="a", decision="NEEDS_RESEARCH", reasons=("CHECK",), alias="me", note="", action="", day="", at="2026-07-01", changed="2026-07-02", events=("e1",)):
    history = [(e, "DECISION_CREATED", "UNREVIEWED", decision, list(reasons), action, "me", "", f"2026-07-0{i + 1}T00:00:00Z") for i, e in enumerate(events)]
    return (item, decision, list(reasons) if reasons is not None else None, alias, note, action, day, at, changed, history)


def test_feedback_config():
    assert feedback.validate_config(FEEDBACK) == []
    found = feedback.validate_config(FEEDBACK | {"schema_version": "", "validation": 3, "allowed_next_actions": {"SEND_EMAIL": ""}, "decision_states": {"QUALIFIED": {"reason_codes": ["ODD"]}, "WON": {}}})
    assert len(found) == 8 and feedback.validate_config(None)


@pytest.mark.parametrize(
    ("values", "errors"),
    [
        ({}, []),
        ({"decision": "WON", "reasons": ["GOOD"]}, ["UNKNOWN_DECISION", "HISTORY_EVENT_INVALID"]),
        ({"alias": None, "note": "x" * 11}, ["ALIAS_REQUIRED", "NOTE_TOO_LONG"]),
        ({"alias": "y" * 51}, ["ALIAS_TOO_LONG"]),
        ({"reasons": [" ", ""]}, ["REASON_REQUIRED", "HISTORY_EVENT_INVALID"]),
        ({"decision": "QUALIFIED", "reasons": ["CHECK"]}, ["REASON_OF_OTHER_DECISION", "NEXT_ACTION_REQUIRED", "HISTORY_EVENT_INVALID"]),
        ({"decision": "WATCHLIST", "reasons": ["LATER"]}, ["ACTION_OR_DATE_REQUIRED"]),
        ({"decision": "WATCHLIST", "reasons": ["LATER"], "day": "2026-08-01"}, []),
        ({"action": "SEND", "day": "2026-02-30"}, ["NEXT_ACTION_UNKNOWN", "REVIEW_DATE_INVALID", "HISTORY_EVENT_INVALID"]),
        ({"item": " ", "at": "", "changed": None, "events": ()}, ["ITEM_ID_REQUIRED", "CREATED_AT_INVALID", "UPDATED_AT_INVALID", "HISTORY_REQUIRED"]),
        ({"events": ("e", "e")}, ["EVENT_ID_REPEATED"]),
    ],
)
def test_feedback_records(spark, values, errors):
    assert feedback.record_errors(spark.createDataFrame([record(**values)], RECORD), FEEDBACK).first().errors == errors


def test_feedback_import(spark):
    rows = [record("a", events=("e1",)), record("b", events=("e1", "e2")), record("c", events=("e2",)), record("d", alias="", events=("e9",)), record("e", events=("e9",))]
    current, active = spark.createDataFrame([record("a")], RECORD), spark.createDataFrame([("a",), ("b",), ("c",)], "item_id string")
    got = {r.item_id: tuple(r)[1:] for r in feedback.import_records(current, spark.createDataFrame(rows, RECORD), active, FEEDBACK).collect()}
    assert got == {"a": ("ACCEPTED", True, False), "b": ("EVENT_ID_REUSED", False, False), "c": ("ACCEPTED", False, False), "d": ("INVALID", False, True), "e": ("ACCEPTED", False, True)}
    assert feedback.import_records(current, spark.createDataFrame([], RECORD), active, FEEDBACK).count() == 0


def test_feedback_records_merge(spark):
    local = [record("a", note="mine", events=("e1", "e2")), record("b", note="tie"), record("l")]
    new = [record("a", note="new", at="2026-06-01", changed="2026-07-09", events=("e2", "e0")), record("b", note="other", at="2026-07-05"), record("i")]
    got = {r.item_id: r for r in feedback.merge_records(spark.createDataFrame(local, RECORD), spark.createDataFrame(new, RECORD)).collect()}
    assert set(got) == {"a", "b", "l", "i"} and got["b"].note == "tie" and got["b"].created_at == "2026-07-01"
    a = got["a"]
    assert (a.note, a.created_at, a.updated_at) == ("new", "2026-06-01", "2026-07-09")
    assert [(e.event_id, e.timestamp[:10]) for e in a.history] == [("e1", "2026-07-01"), ("e0", "2026-07-02"), ("e2", "2026-07-02")]


def test_quality_and_ids(spark):
    schema = T.StructType([T.StructField("a", T.ArrayType(T.StructType([T.StructField("lead_score", T.DoubleType())]))), T.StructField("n", T.LongType())])
    assert quality.score_fields(schema) == ["a.lead_score"]
    g = spark.createDataFrame([("a", 0, 9), ("b", 3, 9), ("c", 20, None), ("d", 20, 100), ("e", 30, 100)], "label string, current int, previous int")
    assert [r.verdict for r in quality.drop_guard(g).orderBy("label").collect()] == ["EMPTY", "TOO_FEW", "NO_BASELINE", "DROP", "OK"]
    assert one(spark, ids.stable_id("x_", F.lit("a"), F.lit("b"))).startswith("x_") and len(one(spark, ids.stable_id("x_", F.lit("a")))) == 22


def test_readers_and_sinks(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"t": "x"}, 5]')
    (tmp_path / "b.json").write_text('{"generated_at": "2026", "items": [{"t": "y"}]}')
    item = T.StructType([T.StructField("t", T.StringType())])
    assert [tuple(r) for r in readers.read_items(spark, str(tmp_path / "b.json"), item).collect()] == [("2026", 0, "y")]
    assert readers.read_items(spark, str(tmp_path / "a.json"), T.StructType([T.StructField("t", T.StringType())])).count() >= 0
    (tmp_path / "f.xml").write_text('<rss><channel><item><title>T</title><link>l</link><pubDate>p</pubDate><source url="u">S</source></item></channel></rss>')
    assert [tuple(r) for r in readers.read_rss(spark, str(tmp_path / "f.xml")).collect()] == [("T", "l", "p", "S")]
    (tmp_path / "o.json").write_text('{"releases": [{"ocid": "1"}, {"ocid": "2"}]}')
    assert readers.read_releases(spark, str(tmp_path / "o.json"), T.StructType([T.StructField("ocid", T.StringType())])).count() == 2
    df = spark.range(3)
    assert sinks.publish(df, str(tmp_path / "out"), "v1") == "v1" and sinks.publish(df, str(tmp_path / "out"), "v2", accept=False) == "v1"
    assert "<" not in sinks.script_safe({"a": "</script>"})
    with pytest.raises(ValueError):
        readers.option({"N": "7"}, "N", "int", 1, 1, 5)


@pytest.mark.parametrize(
    ("rules_text", "path", "free"),
    [
        (None, "/x", True),
        ("User-agent: *\nDisallow: /a # no\nAllow: /a/b", "/a/c", False),
        ("User-agent: *\nDisallow: /a\nAllow: /a/b", "/a/b/1", True),
        ("User-agent: *\r\nDisallow: /a\r\nAllow: /a", "/a", True),
        ("User-agent: ours\nUser-agent: other\nDisallow: /", "/", True),
        ("User-agent: OUR\nDisallow: /", "/", False),
        ("Disallow: /\nUser-agent: *\nDisallow:", "/", True),
    ],
)
def test_robots(spark, rules_text, path, free):
    assert one(spark, robots.robots_allow(F.col("a"), F.col("b"), "ourbot"), a=rules_text, b=path) is free


def test_guards(spark):
    assert one(spark, guards.safe_stage(F.col("a")), a="tls") == "TLS" and one(spark, guards.safe_stage(F.col("a")), a=None) == "LISTING_REQUEST"
    assert one(spark, guards.safe_code(F.col("a")), a="http_403") == "HTTP_403" and one(spark, guards.safe_code(F.col("a")), a="x y") == "SOURCE_ERROR"
    assert one(spark, guards.safe_content_type(F.col("a")), a="text/html; charset=utf-8\r\n") == "text/html; charset=utf-8"
    assert one(spark, guards.safe_content_type(F.col("a")), a="text html") == ""
    allowed = lambda u: one(spark, guards.safe_url(F.col("a"), "h.example", ["/n/"]), a=u)
    assert allowed("https://h.example/n/1") and allowed("https://h.example/robots.txt") and allowed("http://h.example/n/1") == allowed("https://h.example/x") == allowed(None) == ""
    assert one(spark, guards.names_forbidden_action("next_action", F.col("a")), a="Send WhatsApp") and not one(spark, guards.names_forbidden_action("title", F.col("a")), a="contact")
    schema = T.StructType.fromDDL("a string, b array<struct<send_email boolean>>")
    assert guards.forbidden_fields(schema) == ["b.send_email"]


def test_official_pages(spark):
    page = (
        '<a href="/n/1#x"><h3>12 Juli 2026 First item Unduh</h3><span class="the date">12 Juli 2026</span></a><a href="https://else.example/n/2">out</a>'
        '<a href="/n/1">again</a><a href="/other">no</a><a href="/n">self</a><a href="mailto:a@b">m</a><a href="n/3">rel</a>'
    )
    df = spark.createDataFrame([(1, "https://h.example/n", page), (2, "https://h.example/n", None)], "id long, url string, html string")
    links = official.listing_links(df, F.lit("h.example"), "/", "/n")
    got = [(r.link, r.is_external, r.is_record) for r in links.orderBy("pos").collect()]
    assert got == [
        ("https://h.example/n/1", False, True), ("https://else.example/n/2", True, False), ("https://h.example/n/1", False, True), ("https://h.example/other", False, False),
        ("https://h.example/n", False, False), ("mailto:a@b", True, False), ("https://h.example/n/3", False, True),
    ]
    first = official.listing_records(links, "id").orderBy("pos").collect()
    assert [r.link[-1] for r in first] == ["1", "3"] and first[0].title == "First item" and first[0].published_text == "12 Juli 2026"
    d = one(spark, official.detail_fields(F.col("a"), F.col("b")), a="<title>Site - The item - more</title><meta content='d &amp; e' name='description'>", b="https://h.example/n/1")
    assert (d.title, d.canonical_url, d.excerpt) == ("The item - more", "https://h.example/n/1", "d & e")
    rows = official.official_record(links.withColumn("excerpt", F.lit("")), F.lit("S"), F.lit("h.example"), "/n").orderBy("pos").collect()
    assert rows[0].published_at == "2026-07-12" and rows[0].link_valid and not rows[1].link_valid and rows[1].date_status == "missing"


def test_detail_fields_equal_their_sql(spark, tmp_path):
    import duckdb

    heads = [
        'token = &quot;0b96&quot; &lt;x&gt; &#39;y&#39; &#65;', "a &amp; b &amp;quot; &amp;amp;", " <b>in</b>\n\tner \f x ", "a<script>var t;</script>b", "a\x0bb\xa0c&nbsp;d", "",
    ]
    rows = [(i, f"https://h.example/n/{i}#top", f"<title>T</title><h1 class='c'>{h}</h1 ><p>z</p><h1>no</h1>") for i, h in enumerate(heads)]
    rows += [(100, "n/1?q#f", "<H1>t</H1>"), (101, None, "<h1>t</h1>"), (102, "https://h.example", None), (103, " https://h.example/a ", "<h1>t</h1>")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    got = [tuple(r) for r in catalogue.queries()["detail_fields"](spark, str(tmp_path)).orderBy("page_id").collect()]
    assert got == con.execute(f"SELECT * FROM ({catalogue.oracle_sql()['detail_fields']}) ORDER BY page_id").fetchall()
    # the operator itself decodes every entity
    assert one(spark, official.detail_fields(F.col("a"), F.col("b")), a=rows[0][2], b=rows[0][1]).title == "token = \"0b96\" <x> 'y' A"


def test_source_state(spark):
    state = lambda e, w, n, bad: one(spark, official.source_state(F.lit(e), F.array(*map(F.lit, w)), F.lit(n), F.lit(bad)))
    assert state("HTTP_429", ["x"], 0, 0) == "BLOCKED" and state("DNS", ["x"], 0, 0) == "UNAVAILABLE" and state("DETAIL_PARSE_EMPTY", ["x"], 0, 0) == "DEGRADED"
    assert state(None, ["x"], 3, 0) == "HEALTHY" and state(None, ["x"], 3, 1) == state(None, ["DATE_MISSING"], 3, 0) == "DEGRADED"
    errors = official.record_errors(F.lit(None).cast("boolean"), F.lit(True), F.lit(False), F.lit("valid"), F.lit("2026-1-1"), F.lit("e"), F.lit(True))
    assert one(spark, errors) == ["TITLE_INVALID", "PROVENANCE_INVALID", "DATE_INVALID"]


def test_items(spark):
    df = spark.createDataFrame([(" ", "Run ", "S", "2026-07-01", None)], "nama_event string, title string, sumber string, tanggal string, lokasi string")
    r = items.normalize_items(df, "event", extra={"location": ["lokasi"]}).first()
    assert (r.title, r.source, r.date, r.event_date, r.link, r.location, r.folded_title) == ("Run", "S", "2026-07-01", "2026-07-01", "", "", "run")
    assert df.select(items.resolved_by(df, ["nama_event", "title"])).first()[0] == "title" and df.select(items.resolved_by(df, ["lokasi"])).first()[0] is None
    assert one(spark, items.searchable(F.col("a"), F.col("b")), a=" x ", b=None) == "x"
    assert items.facets(df, {"sumber": "S", "lokasi": ""}).count() == 1 and items.facets(df, {"sumber": "T"}).count() == 0
    assert not one(spark, items.complete_provenance(F.col("a"), F.col("b")), a="x", b=" ")


def test_accept_records_against_loop(spark):
    rng = random.Random(3)
    rows = sorted({(r, rng.randrange(260)) for r in range(120) for _ in range(rng.randrange(1, 4))})
    taken, want = set(), {}
    for r in range(120):
        mine = {e for q, e in rows if q == r}
        want[r] = not mine & taken
        taken |= mine if want[r] else set()
    got = feedback.accept_records(spark.createDataFrame(rows, "r long, e long"), "r", "e").collect()
    assert {x.r: x.accepted for x in got} == want and 0 < sum(want.values()) < 120 and len(got) == 120


def accepted_by_loop(rows):
    taken, want = set(), {}
    for r in sorted({r for r, _ in rows}):
        mine = {e for q, e in rows if q == r and e is not None}
        want[r] = not mine & taken
        taken |= mine if want[r] else set()
    return want


@pytest.mark.parametrize("kind", ["chain", "chains", "star", "dense", "wheel", "null"])
def test_accept_records_of_shapes_in_bounded_rounds(spark, kind, monkeypatch):
    rng = random.Random(4)
    made = {
        "chain": lambda: [(r, r + k) for r in range(5000) for k in (0, 1)],
        "chains": lambda: [(r * 50 + c, c * 1000 + r + k) for c in range(30) for r in range(40) for k in (0, 1)],
        "star": lambda: [(r, e) for r in range(300) for e in (0, r + 1)],
        "dense": lambda: [(r, rng.randrange(12)) for r in range(200) for _ in range(3)],
        "wheel": lambda: [(r, e) for r in range(1, 200) for e in (r, r + 1, 1000 + r % 7)],
        "null": lambda: [(r, None) for r in range(5)] + [(9, 1), (9, None), (10, 1)],
    }[kind]()
    if kind == "chain":
        want = {r: r % 2 == 0 for r in range(5000)}
    else:
        want = accepted_by_loop(made)
    steps = []
    monkeypatch.setattr(feedback, "durable", lambda df, f=feedback.durable: (steps.append(1), f(df))[1])
    got = feedback.accept_records(spark.createDataFrame(made, "r long, e long").repartition(5), "r", "e").collect()
    assert {x.r: x.accepted for x in got} == want and len(got) == len(want)
    assert len(steps) < 20


def test_components_against_union_find(spark):
    from headwater.operators.components import components

    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(1000 + i, 1001 + i) for i in range(300)] + [(3000, 3000 + i) for i in range(100)] + [(5, 5)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = root(u), root(v)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: root(x) for u, v in edges if u != v for x in (u, v)}


def test_merged_history_of_many_entries(spark):
    entry = "struct<event_id:string,timestamp:string,note:string>"
    df = spark.range(1).select(
        *[F.transform(F.sequence(F.lit(a), F.lit(b)), lambda i: F.struct(F.concat(F.lit("e"), i).alias("event_id"), F.lpad(10000 - i, 5, "0").alias("timestamp"), F.lit("s").alias("note"))).cast(f"array<{entry}>").alias(side) for side, a, b in (("l", 0, 3000), ("i", 1000, 5000))]
    )
    got = df.select(feedback.merged_history(F.col("l"), F.col("i"), f"array<{entry}>").alias("h")).first().h
    assert [e.event_id for e in got] == [f"e{i}" for i in range(5000, -1, -1)]


def test_sources_and_outputs(spark, tmp_path):
    registry = [{"code": "a", "enabled": True, "status": "ACCEPTED"}, {"code": "b", "enabled": False, "status": "ACCEPTED"}]
    assert [s["code"] for s in readers.select_sources(registry)] == ["a"]
    for bad in ("b", "c"):
        with pytest.raises(ValueError):
            readers.select_sources(registry, bad)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "p.html").write_text("<h1>é</h1>")
    p = readers.read_pages(spark, str(tmp_path / "in"), "https://h.example/").first()
    assert (p.url, p.html) == ("https://h.example/p.html", "<h1>é</h1>") and readers.file_hashes(spark, str(tmp_path / "in")).first().sha256 == p.content_sha256
    with pytest.raises(PermissionError):
        sinks.check_target("/data/live/x", ["/data/live"])
    assert sinks.check_target("/data/live2", ["/data/live"]) == "/data/live2"
    assert "</script><b>" not in sinks.report_html("<t>", {"x": "</script><b>"})
    df = spark.createDataFrame([(1, 'a "q", b')], "k long, v string")
    assert spark.read.option("header", True).option("escape", '"').csv(sinks.export_rows(df, f"{tmp_path}/c")).first().v == 'a "q", b'
    assert spark.read.json(sinks.export_rows(df, f"{tmp_path}/j", "json")).first().k == 1


ITEM = "id string, type string, title string, source string, link string, date string, organization string, event_date string, published string, excerpt string"


def test_signals(spark):
    good = rules.load(rule_file())
    rows = [
        ("a", "tender", "Court case: Hall opens", "S", "https://h.example/a", "2026-07-01", "Org", "", "2026-07-01", None),
        ("b", "official", "News", "S", "https://h.example/b", "2026-07-01", "", "", "", "A zone, sign-up open"),
        ("c", "tender", "zone", "S", "x", "", None, "", "", "zone"),
        ("d", "event", None, None, None, None, None, None, None, None),
        ("e", "event", "tips: hall opens", "S", "https://h.example/e", "2026-07-01", "", "", "", None),
    ]
    df = spark.createDataFrame(rows, ITEM)
    got = {r.id: r for r in signals.build_signals(df, good, F.lit("2026-07-12").cast("date")).collect()}
    assert set(got) == {"a", "b"}
    a, b = got["a"], got["b"]
    assert (a.primary_trigger, a.timing_status, [t.trigger_code for t in a.triggers]) == ("HISTORICAL_PROCUREMENT_PATTERN", "HISTORICAL_REFERENCE", ["OPEN", "HISTORICAL_PROCUREMENT_PATTERN"])
    assert a.triggers[0].matched_terms == ["opens", "Hall"] and a.triggers[1].evidence_strength == "STRONG" and a.suggested_next_action == "VERIFY_TRIGGER"
    assert (b.timing_status, b.data_origin, b.triggers[0].evidence_excerpt) == ("FUTURE_OR_OPEN", "official_source_pilot", "A zone, sign-up open")
    assert [(e.term, e.field) for e in b.triggers[0].matched_evidence] == [("zone", "excerpt")]
    assert {r.id for r in signals.with_detections(df, good).where("editorial_suppressed").collect()} == {"e"}
    found = signals.build_signals(df, good, F.lit("2026-07-12").cast("date"))
    n = {(r.data_origin, r.dim, r.value): r.n for r in signals.trigger_summary(found, good).collect()}
    assert (n["all", "class", "historical"], n["all", "code", "OPEN"], n["tender_corpus", "class", "indirect"], n["event_corpus", "timing", "FUTURE_OR_OPEN"]) == (1, 1, 0, 0)
    assert [r.id for r in signals.dashboard_order(found).collect()] == ["b", "a"]
    assert signals.build_signals(df.limit(0), good, F.lit("2026-07-12").cast("date")).count() == 0


def test_match_official(spark):
    item = lambda i, title, link, day: (i, "tender", title, "S", link, day, "", "", day, None)
    feed = spark.createDataFrame([item("p2", "B", "https://h.example/x", "2026-07-01"), item("p1", "A", "https://h.example/x?utm_source=q", "2026-07-01"), item("p3", "Same Title", "https://o.example/1", "2026-07-02T08:00:00Z")], ITEM)
    rows = [item("o1", "z", "https://h.example/x", ""), item("o2", "z", "https://h.example/x#f", ""), item("o3", "same  title!", "https://n.example/", "2026-07-02"), item("o4", "same title 2", "", "2026-07-02"), item("o5", "same title", None, None)]
    own = spark.createDataFrame(rows, ITEM)
    m = signals.match_official(own, feed)
    assert {r.id: (r.tier, r.item_id) for r in m.collect()} == {"o1": (1, "p2"), "o2": (2, "p1"), "o3": (3, "p3")}
    assert {r.id for r in signals.suppress_matched(own, m).collect()} == {"o4", "o5"}
    held = {r.id: [p.official_id for p in r.official_provenance] for r in signals.attach_provenance(feed, m, own, ["link"]).collect()}
    assert held == {"p1": ["o2"], "p2": ["o1"], "p3": ["o3"]}


REVIEW = "id string, type string, title string, source string, link string, date string, organization string, location string, severity string"


@pytest.mark.parametrize(
    ("title", "source", "codes"),
    [
        ("News", "S", ["TITLE_TOO_SHORT"]), ("Short one", "S", []), ("ab cdefg", "S", ["TITLE_TOO_SHORT"]), ("Big plans - The Post", "Feed (The Post)", ["MALFORMED_RSS_TITLE"]),
        ("Big plans - post.example", "S", ["MALFORMED_RSS_TITLE"]), ("x" * 81, "S", ["LONG_TITLE_WITHOUT_SPACES"]), ("some " + "x" * 91, "S", ["LONG_TITLE_WITHOUT_SPACES"]), ("some " + "x" * 90, "S", []),
        (None, "S", ["MISSING_TITLE", "INCOMPLETE_CORE_FIELDS"]), ("A plain title", " ", ["MISSING_SOURCE", "INCOMPLETE_CORE_FIELDS"]),
    ],
)
def test_review_titles(spark, title, source, codes):
    df = spark.createDataFrame([("1", "tender", title, source, "https://h.example/", None, None, None, None)], REVIEW)
    r = review.review_items(df, F.to_timestamp(F.lit("2026-07-12 00:00:00"))).first()
    assert r.issue_codes == codes


def test_review_queue(spark):
    row = lambda i, **k: tuple(({"id": i, "type": "event", "title": f"Run number {i} in the city of Solo", "source": "S", "link": "https://h.example/", "date": "2026-07-01", "organization": None, "location": None, "severity": None} | k).values())
    rows = [row("a"), row("b", organization="Elsewhere"), row("c", organization="city of", location="Solo"), row("d", organization="number d in the city of Solo run akan"), row("e", title="Same title for all"), row("f", title="same TITLE, for all"),
            row("g", title="same title for all", type="tender"), row("h", date="2020-01-01"), row("i", date="soon"), row("j", title=None, date=None), row("k", location="Hall 5"), row("l", title="Expo juli", location="juli")]
    out = review.review_items(spark.createDataFrame(rows, REVIEW), F.to_timestamp(F.lit("2026-07-12 00:00:00")))
    got = {r.id: (r.issue_codes, r.severity) for r in out.collect()}
    assert got["a"] == ([], "low") and got["c"] == ([], "low") and got["g"] == ([], "low")
    assert got["b"] == got["d"] == (["SUSPECTED_ORGANIZATION_EXTRACTION"], "medium") and got["k"] == got["l"] == (["SUSPECTED_LOCATION_EXTRACTION"], "medium")
    assert got["e"] == got["f"] == (["DUPLICATE_NORMALIZED_TITLE"], "medium") and got["h"] == (["OLD_ITEM"], "low") and got["i"] == (["INVALID_DATE"], "low")
    assert got["j"][1] == "high" and len(got) == len(rows)
    queue = [r.id for r in review.review_queue(out).collect()]
    assert queue[0] == "j" and queue[-2:] == ["h", "i"] and "a" not in queue


def test_readiness(spark):
    rules_file = {"product_relevance_terms": {"a": ["jersey"]}, "indirect_product_fit_terms": {"b": ["fun run"]}, "need_evidence_terms": {"c": ["tender"]}, "counter_signal_terms": ["mark-up"], "generic_organization_terms": ["Dinas"],
                  "organization_artifact_terms": ["akan"], "expired_threshold_days": 1095, "next_action_map": {"NEEDS_MORE_INFORMATION": "VERIFY_SOURCE", "PRODUCT_NEED_UNCONFIRMED": "VERIFY_PRODUCT_NEED", "ORGANIZATION_UNCLEAR": "VERIFY_ORGANIZATION", "EXPIRED_OR_HISTORICAL": "SEND"},
                  "allowed_next_actions": ["VERIFY_SOURCE", "VERIFY_PRODUCT_NEED", "VERIFY_ORGANIZATION"]}
    row = lambda i, title, **k: tuple(({"id": i, "type": "tender", "title": title, "source": "S", "link": "https://h.example/", "date": "2026-07-01", "organization": "PT Maju", "location": None, "severity": None} | k).values())
    rows = [row("ready", "Tender jersey baru"), row("undated", "Tender jersey baru", date=None), row("old", "Tender jersey baru", date="2020-01-01"), row("review", "Tender jersey baru", severity="medium", date="2020-01-01"), row("low", "Tender meja kantor"),
            row("indirect", "Tender fun run", organization=None), row("counter", "Tender jersey mark-up"), row("generic", "Tender jersey baru", organization="DINAS"), row("cut", "Tender jersey baru", organization="PT akan buka"), row("nolink", "Tender jersey baru", link="ftp://x"), row("null", None, source=None)]
    got = {r.id: r for r in review.readiness(spark.createDataFrame(rows, REVIEW), rules_file, F.to_timestamp(F.lit("2026-07-12 00:00:00"))).collect()}
    want = {"ready": "READY_FOR_HUMAN_QUALIFICATION", "undated": "READY_FOR_HUMAN_QUALIFICATION", "old": "EXPIRED_OR_HISTORICAL", "review": "NEEDS_DATA_REVIEW", "low": "LOW_PRODUCT_RELEVANCE"}
    assert {i: r.readiness_state for i, r in got.items()} == {i: want.get(i, "NEEDS_MORE_INFORMATION") for i in got}
    assert got["ready"].reason_codes == ["READY_FOR_HUMAN_REVIEW"] and got["undated"].reason_codes == ["DATE_UNKNOWN", "READY_FOR_HUMAN_REVIEW"] and got["old"].reason_codes == ["DATE_EXPIRED", "HISTORICAL_REFERENCE"]
    assert got["indirect"].suggested_next_action == "VERIFY_PRODUCT_NEED" and got["generic"].suggested_next_action == "VERIFY_ORGANIZATION" and got["counter"].suggested_next_action == "VERIFY_SOURCE" and got["old"].suggested_next_action == "VERIFY_SOURCE"
    assert got["nolink"].reason_codes == ["SOURCE_MISSING", "SOURCE_INVALID"] and got["cut"].checks.organization_identifiable == "fail" and got["indirect"].checks.organization_identifiable == "unknown"


def test_feeds(spark, tmp_path):
    item = lambda t, d="", s="": f"<item><title>{t}</title><link>https://n.example/{len(t)}</link><pubDate>{d}</pubDate>{s}</item>"
    wrap = lambda *x: "<?xml version='1.0'?><rss><channel><title>no item</title>" + "".join(x) + "</channel></rss>"
    (tmp_path / "a.xml").write_text(wrap(item("Dinas Pendidikan Kota Solo Akan Beli Seragam - Pos Kota", "Sun, 12 Jul 2026 10:00:00 GMT", "<source url='https://p.example'>Pos Kota</source>"), item(" "), item("Jersey A &amp; B")))
    (tmp_path / "b.xml").write_text(wrap(item("jersey  a &amp; b", "odd"), item("Bank Jateng Gelar Fun Run di Semarang 12-13 Juli 2026"), item("x" * 90)))
    rss = readers.read_keyword_feeds(spark, {"seragam": f"{tmp_path}/a.xml", "jersey": f"{tmp_path}/b.xml"})
    got = {(r.keyword, r.pos): r for r in feeds.tender_items(rss).collect()}
    assert set(got) == {("seragam", 0), ("seragam", 2), ("jersey", 1), ("jersey", 2)}
    r = got["seragam", 0]
    assert (r.judul, r.instansi_terdeteksi, r.jenis_klien_tebakan) == ("Dinas Pendidikan Kota Solo Akan Beli Seragam", "Dinas Pendidikan Kota Solo", "pemerintah")
    assert (r.sumber, r.published) == ("google_news_rss (Pos Kota)", "2026-07-12T10:00:00+00:00") and got["jersey", 2].judul == "x" * 80 + "[...]" and got["seragam", 2].published is None
    e = {(r.keyword, r.pos): r for r in feeds.event_items(rss).collect()}["jersey", 1]
    assert (e.tanggal, e.lokasi, e.kategori, e.penyelenggara, e.segmen, e.kontak_resmi) == ("2026-07-12", "Semarang", "lari", "Bank Jateng", "korporat", None)


def test_price_records(spark, tmp_path):
    releases = """[{"ocid": "o1", "date": "2025-03-01", "tender": {"title": " Seragam Batik ", "value": {"amount": 5}}, "buyer": {"name": "B"}, "awards": [{"value": {"currency": "IDR"}}, {"value": {"amount": 7.5}}, {"value": 9}], "planning": {"budget": {"amount": {"amount": 10, "currency": "IDR"}}}},
      {"ocid": "o2", "date": "", "tender": {"title": "PDH", "value": "12"}, "planning": {"budget": {"amount": 3}}}, {"ocid": "o3", "tender": {"title": "Meja"}}, {"ocid": "o4"}]"""
    for name, body in (("bare", releases), ("package", '{"releases": ' + releases + "}")):
        (tmp_path / name).write_text(body)
        rows = readers.read_releases(spark, f"{tmp_path}/{name}", T._parse_datatype_string(feeds.RELEASE))
        got = [tuple(r) for r in feeds.price_records(rows).orderBy("ocid").collect()]
        assert got == [("o1", "Seragam Batik", "B", "2025", 10.0, 5.0, 7.5), ("o2", "PDH", None, None, 3.0, None, None)]


def test_source_hint(spark):
    hint = lambda t, x: one(spark, feeds.source_hint(F.col("a"), F.col("b")), a=t, b=x)
    h = hint("Rekrutmen massal", "Pabrik baru &amp; gerai <b>baru</b>")
    assert (h.code, h.matched_terms, h.evidence_excerpt) == ("FACILITY_OPENING_CANDIDATE", ["pabrik baru", "gerai baru"], "Pabrik baru & gerai baru")
    assert hint("Hiring now", None).evidence_excerpt == "Hiring now" and hint("Plain", "").code == "OTHER_OFFICIAL_NEWS" and hint("Plain", "").evidence_excerpt == "Plain"


META = "id string, title string, excerpt string, organization_hint string, organization_status string, organization_source string, source_name string, published_at string, date_status string, date_source string, excerpt_status string, hint_code string"


@pytest.mark.parametrize(
    ("change", "warnings", "errors"),
    [
        ({}, [], []),
        ({"organization_hint": None, "organization_status": None}, ["ORGANIZATION_MISSING"], []),
        ({"organization_hint": "", "organization_status": "explicit"}, [], ["ORGANIZATION_INVALID"]),
        ({"organization_status": "fabricated"}, [], ["ORGANIZATION_FABRICATION_DETECTED"]),
        ({"organization_source": "Publisher name"}, [], ["ORGANIZATION_FABRICATION_DETECTED"]),
        ({"organization_hint": "the  SOURCE"}, [], ["ORGANIZATION_FABRICATION_DETECTED"]),
        ({"organization_hint": "Kementerian Investasi dan Hilirisasi/BKPM"}, [], ["ORGANIZATION_FABRICATION_DETECTED"]),
        ({"organization_hint": "PT Lain"}, [], ["ORGANIZATION_FABRICATION_DETECTED"]),
        ({"organization_status": "guess"}, [], ["ORGANIZATION_INVALID"]),
        ({"published_at": "", "date_status": "missing"}, ["PUBLISHED_DATE_MISSING"], []),
        ({"published_at": None, "date_status": "valid"}, [], ["PUBLISHED_DATE_INVALID"]),
        ({"published_at": "2026-02-30"}, [], ["PUBLISHED_DATE_INVALID"]),
        ({"date_source": "retrieval time"}, [], ["PUBLISHED_DATE_FABRICATION_DETECTED"]),
        ({"excerpt_status": "fabricated", "hint_code": "unknown"}, ["CLASSIFICATION_HINT_UNKNOWN"], ["EXCERPT_FABRICATION_DETECTED"]),
    ],
)
def test_metadata(spark, change, warnings, errors):
    row = {"id": "1", "title": "PT Maju opens", "excerpt": "a hall", "organization_hint": "pt  maju", "organization_status": "explicit", "organization_source": None, "source_name": "The Source", "published_at": "2026-07-01", "date_status": "valid", "date_source": None, "excerpt_status": "available", "hint_code": "X"} | change
    found = refresh.metadata_findings(spark.createDataFrame([tuple(row.values())], META))
    r = found.first()
    assert (r.warnings, r.errors) == (warnings, errors)
    total = refresh.metadata_summary(found).first()
    assert (total.invalid_item_count, total.below_threshold) == (int(bool(errors)), not r.date_valid)


def test_metadata_of_no_items(spark):
    r = refresh.metadata_summary(refresh.metadata_findings(spark.createDataFrame([], META))).first()
    assert (r.items, r.date_completeness_percent, r.below_threshold) == (0, 0.0, False)


def test_run_summary_of_nothing(spark):
    none = lambda s: spark.createDataFrame([], s)
    r = refresh.run_summary(none("status string, raw_items int, invalid_items int"), none("published_at string"), none("x int")).first()
    assert (r.configured_sources, r.raw_items, r.normalized_items, r.content_reference_date) == (0, 0, 0, "")


def test_proposal(spark):
    schema = "source_code string, link_valid boolean, provenance_complete boolean, published_at string, date_status string, organization_hint string, organization_status string, source_name string, title string, excerpt string, title_valid boolean, excerpt_status string"
    good = ("A", True, True, "2026-07-01", "valid", "", "missing", "S", "T", "E", True, "available")
    bad = ("B", None, False, "2026-02-30", "valid", "s", "explicit", "S", "", "E", True, "available")
    out = refresh.proposal_item_errors(spark.createDataFrame([good] * 5, schema), ["A"])
    r = refresh.proposal_summary(out).first()
    assert r.proposal_eligible and (r.valid_item_count, r.missing_organization_count, r.valid_link_percent) == (5, 5, 100.0)
    out = refresh.proposal_item_errors(spark.createDataFrame([good, bad], schema), ["A"])
    assert [r.errors for r in out.where("source_code = 'B'").collect()] == [["SOURCE_NOT_ACCEPTED", "OFFICIAL_LINK_INVALID", "PROVENANCE_INCOMPLETE", "DATE_UNVERIFIED_OR_FABRICATED", "ORGANIZATION_HINT_UNVERIFIED", "SOURCE_FIELDS_INCOMPLETE"]]
    r = refresh.proposal_summary(out).first()
    assert not r.proposal_eligible and r.valid_link_percent == 50.0


def test_signal_changes(spark):
    good = rules.load(rule_file())
    row = lambda i, t, link="https://h.example/": (i, "tender", t, "S", link, "2026-07-01", "", "", "", None)
    made = lambda *rows: signals.build_signals(spark.createDataFrame(list(rows), ITEM), good, F.lit("2026-07-12").cast("date"))
    old = made(row("same", "hall opens"), row("gone", "hall"), row("text", "hall"), row("class", "hall opens"))
    new = made(row("same", "hall opens"), row("new", "hall"), row("text", "hall", "https://h.example/2"), row("class", "hall opens court case"))
    got = {r.id: (r.change, r.changes) for r in refresh.signal_changes(old, new).collect()}
    assert got == {"same": ("UNCHANGED", []), "gone": ("REMOVED", []), "new": ("ADDED", []), "text": ("CHANGED", ["content"]), "class": ("CHANGED", ["classification", "timing", "evidence", "content"])}
    p = F.struct(*[F.lit("x").alias(n) for n in ("source_name", "official_domain", "detail_url", "published_at", "retrieval_method")])
    changes = refresh.signal_changes(old, new)
    assert [tuple(r) for r in refresh.new_signal_errors(new.withColumn("official_provenance", p), changes).collect()] == [("new", [])]
