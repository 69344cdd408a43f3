"""Driver queries of the refresh contract, reports, feed items and feedback records, each with its SQL equivalent."""

from __future__ import annotations

from pyspark.sql import functions as F

from headwater.operators import diff, feedback, feeds, quality, refresh, reports, signals
from headwater.plans.catalogue import _CLEAN, _FOLD, FEEDBACK_RULES, _t, query

_FAILED = "o_orderpriority IN ('1-URGENT', '5-LOW')"


def _health(spark, sf):
    p = F.col("o_orderpriority")
    h = _t(spark, sf, "orders").select(p).distinct()
    said = F.when(p == "1-URGENT", "LIVE_FETCH_FAILED_DNS").otherwise("OK")
    failed = diff.fetch_failed(said, F.lit("HEALTHY"), F.when(p == "5-LOW", 0).otherwise(3), F.when(p == "5-LOW", "HTTP_500").otherwise(" "))
    return h.withColumn("failed", failed)


@query(
    f"""WITH o AS (SELECT o_orderkey, o_orderpriority, o_totalprice, o_orderstatus FROM orders WHERE o_orderkey % 10 <> 0),
n AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderstatus FROM orders WHERE o_orderkey % 10 <> 1 AND NOT {_FAILED}
  UNION ALL SELECT o_orderkey, o_totalprice, o_orderstatus FROM o WHERE {_FAILED})
SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey, CASE WHEN o.o_orderkey IS NULL THEN 'ADDED' WHEN n.o_orderkey IS NULL THEN 'REMOVED' WHEN o.o_totalprice <> n.o_totalprice THEN 'CHANGED' ELSE 'UNCHANGED' END AS change
FROM o FULL JOIN n ON o.o_orderkey = n.o_orderkey"""
)
def fetch_failed_diff(spark, sf):
    o, k = _t(spark, sf, "orders"), F.col("o_orderkey")
    new = o.where(k % 10 != 1).withColumn("o_totalprice", F.when(k % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return diff.guarded_diff(o.where(k % 10 != 0), new, "o_orderkey", ["o_totalprice", "o_orderstatus"], _health(spark, sf), "o_orderpriority").select("o_orderkey", "change")


@query(
    """WITH p AS (SELECT p_brand AS source_code, p_partkey % 700 AS id, CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END AS undated, CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END AS unnamed,
CASE WHEN p_partkey % 11 = 0 THEN 0 ELSE 1 END AS link, CASE WHEN p_partkey % 13 = 0 THEN 0 ELSE 1 END AS whole, CASE WHEN p_partkey % 5 = 1 THEN 1 ELSE 0 END AS baddate FROM part WHERE p_brand <> 'Brand#13'),
g AS (SELECT source_code, count(*) AS n, count(DISTINCT id) AS ids, count(*) FILTER (link = 0 OR whole = 0 OR baddate = 1) AS bad, sum(undated) AS undated, sum(unnamed) AS unnamed, sum(link) AS links, sum(whole) AS whole,
 max(1 - link) AS e1, max(1 - whole) AS e2, max(baddate) AS e3 FROM p GROUP BY source_code),
r AS (SELECT p_brand AS source_code, count(*) AS all_n, count(*) // 3 AS dups FROM part GROUP BY p_brand),
j AS (SELECT r.source_code, all_n, dups, coalesce(n, 0) AS n, coalesce(ids, 0) AS ids, coalesce(bad, 0) AS bad, coalesce(undated, 0) AS undated, coalesce(unnamed, 0) AS unnamed, coalesce(links, 0) AS links, coalesce(whole, 0) AS whole, e1, e2, e3 FROM r LEFT JOIN g USING (source_code))
SELECT source_code, CAST(greatest(1, least(5, 25, greatest(1, all_n))) AS BIGINT) AS least, CAST(n - bad AS BIGINT) AS valid, CAST(bad AS BIGINT) AS invalid, round(CASE WHEN n = 0 THEN 0 ELSE 100.0 * links / n END, 2) AS link_percent,
round(CASE WHEN n = 0 THEN 0 ELSE 100.0 * whole / n END, 2) AS whole_percent,
array_to_string(list_filter([CASE WHEN dups > 0 THEN 'DUPLICATES_REMOVED:' || dups END, CASE WHEN undated > 0 THEN 'MISSING_DATE:' || CAST(undated AS BIGINT) END, CASE WHEN unnamed > 0 THEN 'MISSING_ORGANIZATION:' || CAST(unnamed AS BIGINT) END], lambda x: x IS NOT NULL), ',') AS warnings,
array_to_string(list_sort(list_filter([CASE WHEN n = 0 THEN 'PROPOSED_OUTPUT_EMPTY' END, CASE WHEN n < greatest(1, least(5, 25, greatest(1, all_n))) THEN 'VALID_ITEM_COUNT_BELOW_MINIMUM' END, CASE WHEN ids <> n THEN 'DUPLICATE_STABLE_ID' END,
CASE WHEN all_n <> n THEN 'NORMALIZED_COUNT_MISMATCH' END, CASE WHEN source_code = 'Brand#21' THEN 'SOURCE_HTTP_NOT_200' END, CASE WHEN source_code = 'Brand#22' THEN 'PROPOSED_HEALTH_MISSING' END, CASE WHEN source_code = 'Brand#23' THEN 'SOURCE_HEALTH_UNACCEPTABLE' END,
CASE WHEN source_code = 'Brand#23' THEN 'LIVE_FETCH_FAILED' END, CASE WHEN source_code = 'Brand#31' THEN 'SOURCE_NOT_HTML' END, CASE WHEN e1 = 1 THEN 'OFFICIAL_LINK_INVALID' END, CASE WHEN e1 = 1 THEN 'SOURCE_FIELDS_INCOMPLETE' END, CASE WHEN e2 = 1 THEN 'PROVENANCE_INCOMPLETE' END, CASE WHEN e3 = 1 THEN 'DATE_UNVERIFIED_OR_FABRICATED' END], lambda x: x IS NOT NULL)), ',') AS errors FROM j"""
)
def proposal_contract(spark, sf):
    k = F.col("p_partkey")
    part = _t(spark, sf, "part")
    items = part.where("p_brand <> 'Brand#13'").select(
        F.col("p_brand").alias("source_code"), (k % 700).alias("id"), F.col("p_name").alias("title"), F.col("p_type").alias("excerpt"), F.when(k % 5 == 1, "2026-02-30").when(k % 5 > 0, "2026-02-03").alias("published_at"),
        F.lit("valid").alias("date_status"), F.when(k % 3 > 0, "A ministry").alias("organization_hint"), F.lit("explicit").alias("organization_status"), F.lit("publisher").alias("source_name"), (k % 11 != 0).alias("link_valid"),
        (k % 13 != 0).alias("provenance_complete"), F.lit(True).alias("title_valid"), F.lit("available").alias("excerpt_status"),
    )
    registry = part.select(F.col("p_brand").alias("source_code"), F.lit(True).alias("known")).distinct()
    b, n = F.col("p_brand"), F.count("*")
    runs = part.groupBy("p_brand").agg(n.alias("old_total"), n.alias("raw_items"), n.alias("normalized_items"), F.floor(n / 3).alias("duplicate_items")).select(
        b.alias("source_code"), "old_total", F.lit(25).alias("requested"), "raw_items", "normalized_items", "duplicate_items", F.lit(0).alias("invalid_items"), F.lit("OK").alias("fetch_status"),
        F.when(b == "Brand#22", F.lit(None)).when(b == "Brand#23", "BLOCKED").otherwise("HEALTHY").alias("status"), F.when(b == "Brand#21", 404).otherwise(200).alias("http_status"),
        F.when(b == "Brand#31", "text/htmlx").otherwise("text/html; charset=utf-8").alias("content_type"), F.lit(0).alias("n_errors"), F.lit("").alias("error_code"),
    )
    out = refresh.proposal_contract(refresh.proposal_item_errors(items.join(registry, "source_code", "left"), F.col("known")).drop("known"), runs)
    return out.select(
        "source_code", F.col("reasonable_minimum_valid_items").alias("least"), F.col("valid_item_count").alias("valid"), F.col("invalid_item_count").alias("invalid"), F.col("valid_link_percent").alias("link_percent"),
        F.col("provenance_completeness_percent").alias("whole_percent"), F.array_join("warnings", ",").alias("warnings"), F.array_join("errors", ",").alias("errors"),
    )


def _tagged(spark, sf):
    k = F.col("doc_id")
    origin = F.when(k % 4 == 0, "tender_corpus").when(k % 4 == 1, "event_corpus").otherwise(reports.OFFICIAL)
    outcome = F.when(k % 4 < 2, "evaluated").when(k % 5 == 0, "duplicate").when(k % 5 == 1, "rejected").otherwise("evaluated")
    return _t(spark, sf, "documents").select(origin.alias("data_origin"), outcome.alias("outcome"), (F.col("lang") == "en").alias("has_signal"), (F.col("lang") == "de").alias("editorial_suppressed"))


_TAGGED = "t AS (SELECT doc_id % 4 AS o, CASE WHEN doc_id % 4 < 2 THEN 2 ELSE doc_id % 5 END AS c, coalesce(lang = 'en', false) AS s, coalesce(lang = 'de', false) AS m FROM documents)"


@query(
    f"""WITH {_TAGGED} SELECT count(*) FILTER (o = 0) AS tender_total, count(*) FILTER (o = 1) AS event_total, count(*) FILTER (o < 2) AS production_evaluated_total, count(*) FILTER (o < 2) AS evaluated_total,
count(*) FILTER (o < 2 AND s) AS production_signal_total, count(*) FILTER (o < 2 AND s) AS signal_total, count(*) FILTER (o < 2 AND NOT s) AS production_items_without_trigger, count(*) FILTER (o < 2 AND NOT s) AS items_without_trigger,
count(*) FILTER (o < 2 AND m) AS suppressed_editorial_total, count(*) FILTER (o > 1) AS source_pilot_input_total, count(*) FILTER (o > 1 AND c > 1) AS source_pilot_integrated_total, count(*) FILTER (o > 1 AND c > 1 AND s) AS source_pilot_signal_total,
count(*) FILTER (o > 1 AND c > 1 AND NOT s) AS source_pilot_without_trigger, count(*) FILTER (o > 1 AND c > 1 AND m) AS source_pilot_suppressed_editorial_total, count(*) FILTER (o > 1 AND c = 0) AS cross_corpus_duplicates,
count(*) FILTER (o > 1 AND c = 1) AS rejected_source_items, count(*) FILTER (c > 1) AS total_evaluated, count(*) FILTER (c > 1 AND s) AS total_signal_total, count(*) FILTER (c > 1 AND NOT s) AS total_items_without_trigger FROM t"""
)
def source_counters(spark, sf):
    return reports.source_counters(_tagged(spark, sf))


@query(
    f"""WITH {_TAGGED}, n AS (SELECT count(*) FILTER (o = 0) AS te, count(*) FILTER (o = 1) AS ev, count(*) FILTER (o < 2) AS pe, count(*) FILTER (o < 2 AND s) AS ps, count(*) FILTER (o < 2 AND NOT s) AS pw, count(*) FILTER (o > 1) AS pi, count(*) FILTER (o > 1 AND c > 1) AS pj,
count(*) FILTER (o > 1 AND c > 1 AND s) AS js, count(*) FILTER (o > 1 AND c > 1 AND NOT s) AS jw, count(*) FILTER (o > 1 AND c = 0) AS du, count(*) FILTER (o > 1 AND c = 1) AS re, count(*) FILTER (c > 1) AS ta, count(*) FILTER (c > 1 AND s) AS ts, count(*) FILTER (c > 1 AND NOT s) AS tw FROM t)
SELECT x.law, CAST(x.bad AS BIGINT) AS n FROM (SELECT unnest([{{'law': 'production_is_tender_and_event', 'bad': pe <> te + ev}}, {{'law': 'production_splits', 'bad': pe <> ps + pw}}, {{'law': 'pilot_splits', 'bad': pj <> js + jw}}, {{'law': 'pilot_input_splits', 'bad': pi <> pj + du + re}},
{{'law': 'evaluated_adds_up', 'bad': ta <> pe + pj}}, {{'law': 'signals_add_up', 'bad': ts <> ps + js}}, {{'law': 'rest_adds_up', 'bad': tw <> ta - ts}}]) AS x FROM n)"""
)
def source_laws(spark, sf):
    return quality.violations(reports.source_counters(_tagged(spark, sf)), reports.source_laws())


@query(
    """WITH p AS (SELECT doc_id % 9 <> 0 AS obj, coalesce(trim(text), '') <> '' AS t, coalesce(trim(source), '') <> '' AND doc_id % 7 <> 0 AS s, doc_id % 5 <> 0 OR coalesce(trim(lang), '') <> '' AS k FROM documents)
SELECT count(*) FILTER (obj AND t AND s AND k) AS valid_items, count(*) FILTER (NOT (obj AND t AND s AND k)) AS problematic_items, count(*) FILTER (obj AND NOT t) AS missing_title, count(*) FILTER (obj AND NOT s) AS missing_source,
count(*) FILTER (obj AND NOT k) AS missing_link, count(*) FILTER (NOT obj) AS non_object_items FROM p"""
)
def quality_summary(spark, sf):
    k = F.col("doc_id")
    d = _t(spark, sf, "documents").select("doc_id", "text", F.when(k % 7 != 0, F.col("source")).alias("sumber"), F.when(k % 5 != 0, "https://h.example/").alias("link"), F.col("lang").alias("url"))
    return reports.quality_summary(d, ["text"], ["sumber"], ["link", "url"], k % 9 != 0)


@query("SELECT CASE WHEN coalesce(trim(lang), '') = '' OR doc_id % 3 = 0 THEN 'none' ELSE source END AS type, CASE WHEN coalesce(trim(lang), '') = '' OR doc_id % 3 = 0 THEN '' ELSE lang END AS field, count(*) AS n FROM documents GROUP BY ALL")
def organization_field_usage(spark, sf):
    return reports.field_usage(_t(spark, sf, "documents"), "source", F.when(F.col("doc_id") % 3 != 0, F.col("lang")))


@query("SELECT count(*) AS sources, CAST(sum(CASE WHEN user_id % 3 = 0 THEN 2 WHEN user_id % 3 = 1 THEN 1 ELSE 0 END) AS BIGINT) AS warning_count, CAST(sum(user_id) AS BIGINT) AS valid_item_count FROM events")
def health_totals(spark, sf):
    k = F.col("user_id") % 3
    warnings = F.when(k == 0, F.array(F.lit("a"), F.lit("b"))).when(k == 1, F.array(F.lit("a")))
    return reports.health_totals(_t(spark, sf, "events").select(warnings.alias("warnings"), F.col("user_id").alias("valid_items")))


@query(
    """WITH s AS (SELECT CASE WHEN event_id % 2 = 0 THEN 'tender' ELSE 'event' END AS type, event_type, ts, event_id % 3 AS k, DATE '2024-01-05' + CAST(event_id % 3 - 1 AS INTEGER) AS day FROM events)
SELECT 'new_by_client' AS section, event_type AS key, count(*) AS n FROM s WHERE CAST(ts AS DATE) = DATE '2024-01-05' GROUP BY event_type UNION ALL SELECT 'upcoming_events', '', count(*) FROM s WHERE type = 'event' AND day >= DATE '2024-01-05' HAVING count(*) > 0
UNION ALL SELECT 'priority', '', count(*) FROM s WHERE type = 'tender' AND k > 0 AND epoch(TIMESTAMP '2024-01-05 12:00:00') - floor(epoch(ts)) BETWEEN 0 AND 172800 HAVING count(*) > 0"""
)
def daily_digest(spark, sf):
    k = F.col("event_id")
    s = _t(spark, sf, "events").select(
        F.when(k % 2 == 0, "tender").otherwise("event").alias("type"), F.col("event_type").alias("client_kind"), F.col("ts").alias("published"),
        F.date_add(F.lit("2024-01-05").cast("date"), (k % 3 - 1).cast("int")).alias("event_date"), F.when(k % 3 > 0, "An office").alias("organization"),
    )
    return reports.daily_digest(s, F.lit("2024-01-05 12:00:00").cast("timestamp"))


@query("SELECT strftime(max(ts), '%Y-%m-%d %H:%M') AS latest FROM events")
def latest_time(spark, sf):
    rows = _t(spark, sf, "events").select(F.col("ts").cast("string").alias("a"), F.when(F.col("event_id") % 2 == 0, "soon").alias("b"))
    return reports.latest_time(rows, "a", "b").select(F.date_format("latest", "yyyy-MM-dd HH:mm").alias("latest"))


@query("SELECT o_orderkey FROM orders ORDER BY o_orderpriority, o_orderdate DESC, o_orderstatus, o_orderkey LIMIT 20")
def source_order(spark, sf):
    rows = _t(spark, sf, "orders").select(F.col("o_orderpriority").alias("source_code"), F.col("o_orderdate").alias("published_at"), F.col("o_orderstatus").alias("title"), F.col("o_orderkey").alias("id"))
    return reports.visible(rows, reports.source_order(rows)).select(F.col("id").alias("o_orderkey"))


@query("WITH k AS (SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 500) SELECT count(*) AS kept, (SELECT count(*) FROM orders) - count(*) AS skipped_total FROM k")
def limited_items(spark, sf):
    kept, skipped = reports.limited(_t(spark, sf, "orders"), [F.col("o_totalprice").desc(), F.col("o_orderkey")], 500)
    return kept.agg(F.count("*").alias("kept")).withColumn("skipped_total", F.lit(skipped()).cast("long"))


@query("SELECT o_custkey, array_to_string(list_sort(list_distinct(list_concat(list(o_orderpriority), list(o_orderstatus)))), ',') AS codes FROM orders GROUP BY o_custkey")
def union_codes(spark, sf):
    g = _t(spark, sf, "orders").groupBy("o_custkey").agg(F.collect_set("o_orderpriority").alias("a"), F.collect_set("o_orderstatus").alias("b"))
    return g.select("o_custkey", F.array_join(reports.union_codes(F.col("a"), F.col("b")), ",").alias("codes"))


@query(
    """WITH o AS (SELECT * FROM orders WHERE o_orderkey % 10 <> 0), n AS (SELECT * FROM orders WHERE o_orderkey % 10 <> 1)
SELECT o_orderkey, CASE WHEN n.o_orderkey IS NULL THEN 'REMOVED' WHEN o.o_orderkey IS NULL THEN 'ADDED' ELSE 'UNCHANGED' END AS change, CASE WHEN n.o_orderkey IS NULL THEN 'old ' || o.o_orderstatus ELSE 'new ' || n.o_orderstatus END AS title FROM o FULL JOIN n USING (o_orderkey)"""
)
def report_items(spark, sf):
    o = _t(spark, sf, "orders")
    old, new = o.where("o_orderkey % 10 <> 0"), o.where("o_orderkey % 10 <> 1")
    changes = diff.snapshot_diff(old, new, "o_orderkey", ["o_totalprice"]).select("o_orderkey", "change")
    side = lambda df, n: df.select("o_orderkey", F.concat(F.lit(f"{n} "), F.col("o_orderstatus")).alias("title"))
    return reports.report_items(changes, side(old, "old"), side(new, "new"), "o_orderkey", ["title"])


_LAST = "s AS (SELECT user_id AS c_custkey, arg_max(event_type, (ts, event_id)) AS decision FROM events GROUP BY user_id)"


def _decided(spark, sf):
    return feedback.current_state(_t(spark, sf, "events"), "user_id", "ts", "event_id", "event_type").withColumnRenamed("user_id", "c_custkey")


@query(f"WITH {_LAST} SELECT c_custkey FROM customer LEFT JOIN s USING (c_custkey) WHERE decision IS NULL")
def decision_filter(spark, sf):
    return feedback.with_decision(_t(spark, sf, "customer").select("c_custkey"), _decided(spark, sf), "c_custkey", "UNREVIEWED").select("c_custkey")


@query(f"WITH {_LAST}, d AS (SELECT unnest(['view', 'click', 'never']) AS decision) SELECT d.decision, count(c_custkey) AS n FROM d LEFT JOIN (SELECT decision, c_custkey FROM customer JOIN s USING (c_custkey)) x USING (decision) GROUP BY d.decision")
def decision_distribution(spark, sf):
    return feedback.decision_distribution(_t(spark, sf, "customer").select("c_custkey"), _decided(spark, sf), "c_custkey", ("view", "click", "never"))


#: Record of one decision, as ``feedback.record_errors`` reads it.
RECORD = """item_id string, human_decision string, reason_codes array<string>, reviewer_alias string, note string, next_action string, review_date string, created_at string, updated_at string,
history array<struct<event_id:string,event_type:string,previous_decision:string,new_decision:string,reason_codes:array<string>,next_action:string,reviewer_alias:string,note:string,timestamp:string>>"""


def _records(spark, sf, event: str):
    """A record of one event for every customer, with the event id made from the given column."""
    entry = F.struct(
        F.concat(F.lit("e"), F.expr(event).cast("string")).alias("event_id"), F.lit("DECISION_CREATED").alias("event_type"), F.lit("UNREVIEWED").alias("previous_decision"), F.lit("NOT_RELEVANT").alias("new_decision"), F.array(F.lit("error")).alias("reason_codes"),
        F.lit("").alias("next_action"), F.lit("me").alias("reviewer_alias"), F.lit("").alias("note"), F.lit("2026-01-01T00:00:00Z").alias("timestamp"),
    )
    time = F.lit("2026-01-01T00:00:00Z")
    return _t(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("item_id"), F.lit("NOT_RELEVANT").alias("human_decision"), F.array(F.lit("error")).alias("reason_codes"), F.lit("me").alias("reviewer_alias"), F.lit("").alias("note"), F.lit("").alias("next_action"),
        F.lit("").alias("review_date"), time.alias("created_at"), time.alias("updated_at"), F.array(entry).alias("history"),
    )


@query(
    """WITH c AS (SELECT c_custkey AS k, c_custkey % 3 <> 0 AS known, c_custkey % 2 = 0 AS asked FROM customer), e AS (SELECT *, CASE WHEN NOT asked THEN '' WHEN k % 4 = 0 AND known AND k % 10 = 0 THEN 'NEXT_ACTION_REQUIRED,EVENT_ID_REPEATED' WHEN k % 4 = 0 THEN 'NEXT_ACTION_REQUIRED' WHEN known AND k % 10 = 0 THEN 'EVENT_ID_REPEATED' ELSE '' END AS errors FROM c WHERE known OR asked)
SELECT CAST(k AS VARCHAR) AS item_id, CASE WHEN asked AND errors = '' THEN 'QUALIFIED' WHEN known THEN 'NOT_RELEVANT' END AS decision, CASE WHEN asked AND errors = '' THEN (CASE WHEN known THEN 'e' || k || ':DECISION_CREATED,' ELSE '' END) || 'n' || k || (CASE WHEN known THEN ':DECISION_UPDATED' ELSE ':DECISION_CREATED' END)
 WHEN known THEN 'e' || k || ':DECISION_CREATED' END AS history, errors FROM e"""
)
def apply_decisions(spark, sf):
    k = F.col("item_id").cast("long")
    every = _records(spark, sf, "c_custkey")
    action = F.when(k % 4 != 0, "VERIFY_SOURCE")
    event = F.concat(F.when(k % 10 == 0, F.lit("e")).otherwise("n"), F.col("item_id"))
    made = every.where(k % 2 == 0).select(
        "item_id", F.lit("QUALIFIED").alias("human_decision"), F.array(F.lit("view")).alias("reason_codes"), "reviewer_alias", "note", action.alias("next_action"), F.lit("").alias("review_date"),
        F.when((k % 10 == 0) & (k % 3 == 0), F.concat(F.lit("n"), F.col("item_id"))).otherwise(event).alias("event_id"), F.lit("2026-02-01T00:00:00Z").alias("now"),
    )
    out = feedback.apply_decisions(every.where(k % 3 != 0), made, FEEDBACK_RULES)
    history = F.array_join(F.transform("history", lambda e: F.concat(e["event_id"], F.lit(":"), e["event_type"])), ",")
    return out.select("item_id", F.col("human_decision").alias("decision"), history.alias("history"), F.array_join("errors", ",").alias("errors"))


@query(
    """WITH c AS (SELECT c_custkey AS k, c_custkey % 3 <> 0 AS mine, c_custkey % 2 = 0 AS theirs FROM customer)
SELECT CAST(k AS VARCHAR) AS item_id, CASE WHEN mine AND theirs THEN array_to_string(list_sort(['e' || k, 'e' || (k + 1000000000)]), ',') WHEN theirs THEN 'e' || (k + 1000000000) ELSE 'e' || k END AS events,
'2' AS schema_version, '2026-03-01T00:00:00Z' AS updated_at, (SELECT count(*) FROM c WHERE mine OR theirs) AS n_records FROM c WHERE mine OR theirs"""
)
def apply_import(spark, sf):
    k = F.col("item_id").cast("long")
    every = _records(spark, sf, "c_custkey")
    current, imported = every.where(k % 3 != 0), _records(spark, sf, "c_custkey + 1000000000").where(k % 2 == 0)
    outcomes = feedback.import_records(current, imported, every.select("item_id"), FEEDBACK_RULES)
    merged, root = feedback.apply_import(current, imported, outcomes, "2", F.lit("2026-03-01T00:00:00Z"))
    events = F.array_join(F.array_sort(F.transform("history", lambda e: e["event_id"])), ",")
    return merged.select("item_id", events.alias("events")).join(F.broadcast(root))  # the root is one row


@query("SELECT CAST(c_custkey AS VARCHAR) AS item_id, CASE WHEN c_custkey % 2 = 0 THEN array_to_string(list_sort(['e' || c_custkey, 'e' || (c_custkey + 1000000000)]), ',') ELSE 'e' || c_custkey END AS events FROM customer WHERE c_custkey % 3 <> 0 UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'e' || (c_custkey + 1000000000) FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 2 = 0")
def merge_records(spark, sf):
    k = F.col("item_id").cast("long")
    out = feedback.merge_records(_records(spark, sf, "c_custkey").where(k % 3 != 0), _records(spark, sf, "c_custkey + 1000000000").where(k % 2 == 0))
    return out.select("item_id", F.array_join(F.transform("history", lambda e: e["event_id"]), ",").alias("events"))


def _rss(spark, sf):
    k = F.col("c_custkey")
    title = F.concat(F.lit("Kementerian Kesehatan tender sewa "), F.lower("c_mktsegment"), F.lit(" nomor "), (k % 100).cast("string"))
    return _t(spark, sf, "customer").select(
        F.lit("tender").alias("keyword"), F.lit(0).alias("kw_pos"), k.alias("pos"), title.alias("title"), F.concat(F.lit("https://h.example/"), k.cast("string")).alias("link"),
        F.when(k % 2 == 0, "Mon, 05 Jan 2026 10:00:00 GMT").otherwise("soon").alias("pub_date"), F.lit("Media").alias("source"),
    )


@query(
    """WITH t AS (SELECT min(c_custkey) AS pos, 'Kementerian Kesehatan tender sewa ' || lower(c_mktsegment) || ' nomor ' || (c_custkey % 100) AS judul FROM customer GROUP BY judul)
SELECT pos, judul, 'https://h.example/' || pos AS link, 'google_news_rss (Media)' AS sumber, CASE WHEN pos % 2 = 0 THEN '2026-01-05T10:00:00+00:00' END AS published FROM t"""
)
def tender_items(spark, sf):
    return feeds.tender_items(_rss(spark, sf)).select("pos", "judul", "link", "sumber", "published")


@query(
    """WITH t AS (SELECT min(c_custkey) AS pos, 'Pameran ' || lower(c_mktsegment) || ' di Jakarta ' || (1 + c_custkey % 28) || ' Juli 2026' AS nama_event, '2026-07-' || lpad(CAST(1 + c_custkey % 28 AS VARCHAR), 2, '0') AS tanggal FROM customer GROUP BY ALL)
SELECT pos, nama_event, tanggal, 'Jakarta' AS lokasi, 'https://h.example/' || pos AS link_resmi FROM t"""
)
def event_items(spark, sf):
    title = F.concat(F.lit("Pameran "), F.lower(F.split("title", " ")[4]), F.lit(" di Jakarta "), (1 + F.col("pos") % 28).cast("string"), F.lit(" Juli 2026"))
    return feeds.event_items(_rss(spark, sf).withColumn("title", title)).select("pos", "nama_event", "tanggal", "lokasi", "link_resmi")


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS ocid, 'Sewa Tenda ' || o_orderpriority AS judul_paket, o_orderstatus AS instansi, substr(CAST(o_orderdate AS VARCHAR), 1, 4) AS tahun, o_totalprice AS nilai_pagu, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice + 1 END AS nilai_hps,
CASE WHEN o_orderkey % 3 = 0 THEN 7.5 WHEN o_orderkey % 3 = 1 THEN o_totalprice + 2 END AS nilai_penetapan_pemenang FROM orders WHERE o_orderpriority <> '5-LOW'"""
)
def price_records(spark, sf):
    k, price = F.col("o_orderkey"), F.col("o_totalprice")
    v = lambda c: F.parse_json(F.to_json(c))
    title = F.when(F.col("o_orderpriority") == "5-LOW", "Jalan tol").otherwise(F.concat(F.lit("Sewa Tenda "), F.col("o_orderpriority")))
    hps = F.when(k % 2 == 0, v(F.struct((price + 1).alias("amount"))))
    awards = F.array(F.struct(F.parse_json(F.lit('"9"')).alias("value")), F.struct(F.when(k % 3 == 0, F.parse_json(F.lit("7.5"))).when(k % 3 == 1, v(F.struct((price + 2).alias("amount")))).alias("value")))
    releases = _t(spark, sf, "orders").select(
        k.cast("string").alias("ocid"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.struct(title.alias("title"), hps.alias("value")).alias("tender"), F.struct(F.col("o_orderstatus").alias("name")).alias("buyer"), awards.alias("awards"),
        F.struct(F.struct(v(F.struct(price.alias("amount"))).alias("amount")).alias("budget")).alias("planning"),
    )
    return feeds.price_records(releases, ("sewa tenda",))


@query(
    """WITH l AS (SELECT l_orderkey AS id, list_sort(list(DISTINCT l_partkey)) AS p FROM lineitem GROUP BY l_orderkey) SELECT o_orderkey, coalesce(array_to_string(p, ','), '') AS official FROM orders LEFT JOIN l ON id = o_orderkey"""
)
def attach_provenance(spark, sf):
    s = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))
    m = _t(spark, sf, "lineitem").select(F.concat_ws(":", "l_partkey", "l_orderkey").alias("id"), F.col("l_orderkey").alias("item_id"), F.col("l_partkey").alias("detail")).distinct()
    out = signals.attach_provenance(s, m.select("id", "item_id"), m.select("id", "detail"), ["detail"])
    return out.select(F.col("id").alias("o_orderkey"), F.array_join(F.array_sort(F.transform("official_provenance", lambda p: p["detail"])).cast("array<string>"), ",").alias("official"))


@query(
    """WITH s AS (SELECT doc_id AS id, CASE doc_id % 3 WHEN 0 THEN 1 ELSE 0 END AS off, ['FUTURE_OR_OPEN', 'CURRENT_OR_UNCLEAR', 'COMPLETED_OR_PAST', 'INFORMATIONAL_OR_EDITORIAL', 'HISTORICAL'][1 + doc_id % 5] AS t, lang = 'en' AS direct FROM documents),
r AS (SELECT id, CASE WHEN off = 1 AND t = 'FUTURE_OR_OPEN' THEN 0 WHEN t = 'FUTURE_OR_OPEN' AND direct THEN 1 WHEN off = 1 AND t = 'CURRENT_OR_UNCLEAR' THEN 2 WHEN t = 'FUTURE_OR_OPEN' THEN 3 WHEN t = 'CURRENT_OR_UNCLEAR' THEN 4 WHEN t = 'COMPLETED_OR_PAST' THEN 5 ELSE 6 END AS rank FROM s WHERE t <> 'INFORMATIONAL_OR_EDITORIAL')
SELECT id, CAST(rank AS INTEGER) AS rank FROM r ORDER BY rank, id LIMIT 20"""
)
def dashboard_order(spark, sf):
    k = F.col("doc_id")
    states = F.array(*map(F.lit, ("FUTURE_OR_OPEN", "CURRENT_OR_UNCLEAR", "COMPLETED_OR_PAST", "INFORMATIONAL_OR_EDITORIAL", "HISTORICAL")))
    s = _t(spark, sf, "documents").select(
        k.alias("id"), F.when(k % 3 == 0, signals.DATA_ORIGIN["official"]).otherwise("tender_corpus").alias("data_origin"), F.get(states, (k % 5).cast("int")).alias("timing_status"), F.when(F.col("lang") == "en", "direct").otherwise("indirect").alias("primary_class")
    )
    return signals.dashboard_order(s).select("id", F.col("rank").cast("int").alias("rank"))


_CLEANED = lambda c: _CLEAN.replace("html,", f"{c},", 1)
_FOLDED = lambda c: _FOLD.replace("(text,", f"({c},", 1)
_HINTED = """CASE doc_id % 5 WHEN 0 THEN text WHEN 1 THEN '<b>Pabrik</b> baru ' || source WHEN 2 THEN 'Penambahan Kapasitas ' || source ELSE source END AS title,
CASE doc_id % 5 WHEN 3 THEN text || ' membuka-lowongan dan hiring' WHEN 2 THEN 'cabang baru ' || text WHEN 4 THEN NULL ELSE text END AS excerpt"""
_HITS = lambda terms: "list_filter([" + ", ".join(f"CASE WHEN contains(t, ' {x} ') OR contains(x, ' {x} ') THEN '{x}' END" for x in terms) + "], lambda v: v IS NOT NULL)"


@query(
    f"""WITH a AS (SELECT doc_id, {_HINTED} FROM documents), c AS (SELECT doc_id, coalesce(title, '') AS title, coalesce(excerpt, '') AS excerpt, {_CLEANED("coalesce(title, '')")} AS ct, {_CLEANED("coalesce(excerpt, '')")} AS cx FROM a),
f AS (SELECT *, ' ' || {_FOLDED("ct")} || ' ' AS t, ' ' || {_FOLDED("cx")} || ' ' AS x FROM c),
h AS (SELECT *, {", ".join(f"{_HITS(terms)} AS h{i}" for i, (_, terms) in enumerate(feeds.HINTS))} FROM f),
g AS (SELECT *, CASE {" ".join(f"WHEN len(h{i}) > 0 THEN {code!r}" for i, (code, _) in enumerate(feeds.HINTS))} ELSE 'OTHER_OFFICIAL_NEWS' END AS code, CASE {" ".join(f"WHEN len(h{i}) > 0 THEN h{i}" for i in range(len(feeds.HINTS)))} ELSE [] END AS terms FROM h)
SELECT doc_id, code, array_to_string(terms, ',') AS terms, md5(substr(CASE WHEN len(terms) > 0 AND contains(t, ' ' || terms[1] || ' ') THEN ct WHEN len(terms) > 0 OR excerpt <> '' THEN cx ELSE ct END, 1, 500)) AS evidence FROM g"""
)
def source_hint(spark, sf):
    k, source, body = F.col("doc_id") % 5, F.col("source"), F.col("text")
    title = F.when(k == 0, body).when(k == 1, F.concat(F.lit("<b>Pabrik</b> baru "), source)).when(k == 2, F.concat(F.lit("Penambahan Kapasitas "), source)).otherwise(source)
    excerpt = F.when(k == 3, F.concat(body, F.lit(" membuka-lowongan dan hiring"))).when(k == 2, F.concat(F.lit("cabang baru "), body)).when(k != 4, body)
    rows = _t(spark, sf, "documents").select("doc_id", feeds.source_hint(title, excerpt).alias("h"))
    return rows.select("doc_id", "h.code", F.array_join("h.matched_terms", ",").alias("terms"), F.md5("h.evidence_excerpt").alias("evidence"))
