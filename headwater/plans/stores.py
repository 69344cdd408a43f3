"""Queries through what is stored: accepted versions, bucketed snapshots, folded decisions, feed files, members of JSON."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from headwater.functions import guards
from headwater.operators import diff, increments, reports
from headwater.operators.durable import shared_folder
from headwater.plans.catalogue import _DIFF, _FIELDS, _SQL, _STATE, _t, _versions, query
from headwater.plans.reports import _tagged
from headwater.sources import feed_files, snapshots, versions


@query(_SQL["source_counters"])
def observed_counters(spark, sf):
    counters = reports.source_counter_columns()
    known = {"origin_known": F.col("data_origin").isNotNull()}
    marker = versions.publish(_tagged(spark, sf), shared_folder(spark, "published"), "v1", counters, known, reports.source_laws())
    values = {n: marker["counters"][n] for n in counters}
    return spark.createDataFrame([tuple(values.values())], T.StructType([T.StructField(n, T.LongType()) for n in values]))


@query(f"WITH {_DIFF} SELECT o_orderkey, change, array_to_string(list_sort(list_filter([CASE WHEN s AND change = 'CHANGED' THEN 'o_orderstatus' END, CASE WHEN p AND change = 'CHANGED' THEN 'o_totalprice' END], lambda x: x IS NOT NULL)), ',') AS fields FROM j")
def bucketed_diff(spark, sf):
    folder = shared_folder(spark, "snapshots")
    name = "snapshot_" + folder[-32:]
    old, new = (snapshots.write_snapshot(df, f"{name}_{side}", f"{folder}/{side}", "o_orderkey", 16) for df, side in zip(_versions(spark, sf), ("old", "new")))
    return diff.snapshot_diff(old, new, "o_orderkey", _FIELDS).select("o_orderkey", "change", F.array_join("changed_fields", ",").alias("fields"))


@query(f"WITH {_STATE} SELECT user_id, decision, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, strftime(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at, n_events FROM s")
def folded_state(spark, sf):
    base = shared_folder(spark, "decisions")
    e = _t(spark, sf, "events").select("event_id", "user_id", "ts", F.col("event_type").alias("decision"))
    # events arrive in three parts, the second one twice, the third with events of the first
    parts = [e.where("event_id % 3 = 0"), e.where("event_id % 3 = 1"), e.where("event_id % 3 = 1"), e.where("event_id % 3 = 2 OR event_id % 5 = 0")]
    for part in parts:
        increments.fold_events(part, base, "user_id", "ts", "event_id", "decision", 16)
    at = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return increments.read_state(spark, base).select("user_id", "decision", at("created_at"), at("updated_at"), "n_events")


@query("SELECT lang AS keyword, doc_id, md5(text) AS title FROM documents")
def feed_files_read(spark, sf):
    folder = shared_folder(spark, "feeds")
    docs = _t(spark, sf, "documents")
    item = F.concat(F.lit("<item><title>"), F.base64(F.encode("text", "utf-8")), F.lit("</title><link>"), F.col("doc_id"), F.lit("</link></item>"))
    docs.select("lang", item.alias("value")).write.partitionBy("lang").text(folder)
    feeds = {r.lang: f"{folder}/lang={r.lang}" for r in docs.select("lang").distinct().orderBy("lang").collect()}  # one feed for each language
    rows = feed_files.read_feed_files(spark, feeds, range_bytes=8 << 20)
    return rows.select("keyword", F.col("link").cast("long").alias("doc_id"), F.md5(F.unbase64("title")).alias("title"))


@query(
    """WITH d AS (SELECT doc_id, '{"id":' || doc_id || ',"meta":{"lang":' || to_json(lang) || CASE WHEN doc_id % 3 = 0 THEN ',"risk_Score":' || n_chars ELSE ',"score":"none"' END || ',"list":[{"k":' || to_json(text) || '},"send_email"' || CASE WHEN doc_id % 4 = 0 THEN ',{"deep":[{"send_email":true}]}' ELSE '' END
|| ']},"next_action":' || CASE WHEN doc_id % 5 = 0 THEN '"Set price"' ELSE '"wait"' END || '}' AS j FROM documents),
m AS (SELECT doc_id, t.key, t.type, t.atom FROM d, json_tree(d.j::JSON) t WHERE t.key IS NOT NULL AND NOT regexp_full_match(t.key, '[0-9]+'))
SELECT doc_id, count(*) AS n_members, coalesce(array_to_string(list_sort(list_distinct(list(key) FILTER (regexp_matches(key, 'outreach_action|contact_action|send_email|send_whatsapp|set_price', 'i') OR (regexp_matches(key, 'score', 'i') AND type IN ('UBIGINT', 'BIGINT', 'DOUBLE'))
OR (regexp_matches(key, 'action|outreach|contact', 'i') AND type = 'VARCHAR' AND regexp_matches(atom::VARCHAR, 'outreach|contact|send[_ -]?(email|whatsapp)|set[_ -]?price', 'i'))))), ','), '') AS found FROM m GROUP BY doc_id"""
)
def forbidden_members(spark, sf):
    k = F.col("doc_id")
    deep = F.array(F.struct(F.when(k % 4 == 0, F.lit(True)).alias("send_email")))
    listed = F.concat(
        F.array(F.parse_json(F.to_json(F.struct(F.col("text").alias("k")))), F.parse_json(F.lit('"send_email"'))),
        F.when(k % 4 == 0, F.array(F.parse_json(F.to_json(F.struct(deep.alias("deep")))))).otherwise(F.array().cast("array<variant>")),
    )
    meta = F.struct("lang", F.when(k % 3 == 0, F.col("n_chars")).alias("risk_Score"), F.when(k % 3 != 0, F.lit("none")).alias("score"), listed.alias("list"))
    value = F.struct(k.alias("id"), meta.alias("meta"), F.when(k % 5 == 0, "Set price").otherwise("wait").alias("next_action"))
    members = guards.json_members(F.to_json(value))
    return _t(spark, sf, "documents").select("doc_id", members.alias("m")).select("doc_id", F.size("m").cast("long").alias("n_members"), F.array_join(guards.forbidden_members(F.col("m")), ",").alias("found"))
