"""Queries of finished outputs: a source's refresh item by item, laws of signals, counts in the order of reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from headwater.operators import contracts, diff, feeds, quality, signals
from headwater.plans.catalogue import _DETECT, RULES, _label_sql, _signals, _t, query

_KEPT = "doc_id % 9 <> 0"


def _items(spark, sf):
    d, k = _t(spark, sf, "documents"), F.col("doc_id")
    text = lambda c: c.cast("string")
    return d.select(
        text(k).alias("id"), F.lit(" s ").alias("source_code"), F.col("source").alias("source_name"), F.col("text").alias("title"), F.concat(F.lit("https://h.example/"), k).alias("link"), F.lit("2026-07-01").alias("published_at"),
        F.col("lang").alias("organization_hint"), F.col("text").alias("excerpt"), F.struct(F.col("source").alias("listing_url")).alias("provenance"), F.struct((k % 2 == 0).alias("title_valid")).alias("quality"),
        F.md5("text").alias("content_hash"),
    )


_TRIM = "trim(text)"


@query(
    f"""SELECT CAST(doc_id AS VARCHAR) AS id, 's' AS source_code, trim(source) AS source_name, md5(trim(text, ' ')) AS title, 'https://h.example/' || doc_id AS link, '2026-07-01' AS published_at, trim(lang) AS organization_hint, md5(substr(trim(text, ' '), 1, 500)) AS excerpt,
source AS listing_url, doc_id % 2 = 0 AS title_valid, CAST(NULL AS VARCHAR) AS classification_hint, md5(text) AS content_hash FROM documents"""
)
def snapshot_items(spark, sf):
    rows = _items(spark, sf)
    item = rows.select(diff.snapshot_item(dict(rows.dtypes)).alias("i")).select("i.*")
    return item.select(
        "id", "source_code", "source_name", F.md5("title").alias("title"), "link", "published_at", "organization_hint", F.md5("excerpt").alias("excerpt"), "provenance.listing_url", "quality.title_valid", "classification_hint", "content_hash"
    )


@query(
    f"""WITH c AS (SELECT doc_id AS k, {_KEPT} AS o, doc_id % 10 <> 0 AS n, doc_id % 2 = 0 AS a, doc_id % 3 = 0 AS b, doc_id % 4 = 0 AS c, doc_id % 5 = 0 AS d, doc_id % 6 = 0 AS e, doc_id % 7 = 0 AND lang IS DISTINCT FROM 'xx' AS f, doc_id % 8 = 0 AS g FROM documents),
x AS (SELECT *, o AND n AND (a OR b OR c OR d OR e OR f OR g) AS ch FROM c WHERE o OR n)
SELECT CAST(k AS VARCHAR) AS id, CASE WHEN NOT o THEN 'ADDED' WHEN NOT n THEN 'REMOVED' WHEN ch THEN 'CHANGED' ELSE 'UNCHANGED' END AS change,
CASE WHEN ch THEN array_to_string(list_filter([CASE WHEN g THEN 'classification_hint' END, CASE WHEN a THEN 'content_hash' END, CASE WHEN c THEN 'link' END, CASE WHEN f THEN 'organization_hint' END, CASE WHEN e THEN 'provenance' END, CASE WHEN b THEN 'published_at' END, CASE WHEN d THEN 'quality' END], lambda v: v IS NOT NULL), ',') ELSE '' END AS fields,
CASE WHEN ch THEN array_to_string(list_filter([CASE WHEN g THEN 'CLASSIFICATION_HINT_CHANGED' END, CASE WHEN a THEN 'CONTENT_CHANGED' END, CASE WHEN b THEN 'DATE_CHANGED' END, CASE WHEN c THEN 'LINK_CHANGED' END, CASE WHEN f THEN 'ORGANIZATION_HINT_CHANGED' END, CASE WHEN e THEN 'PROVENANCE_CHANGED' END, CASE WHEN d THEN 'QUALITY_CHANGED' END], lambda v: v IS NOT NULL), ',') ELSE '' END AS reasons FROM x"""
)
def refresh_changes(spark, sf):
    k = F.col("id").cast("long")
    rows = _items(spark, sf).withColumn("classification_hint", F.struct(F.lit("x").alias("code")))
    when = lambda n, new, c: F.when(k % n == 0, new).otherwise(F.col(c)).alias(c)
    new = rows.where(k % 10 != 0).select(
        "id", "source_code", "source_name", "title", when(4, F.lit("https://h.example/moved"), "link"), when(3, F.lit("2026-07-02"), "published_at"), when(7, F.lit("xx"), "organization_hint"), "excerpt",
        F.struct(F.when(k % 6 == 0, F.concat("provenance.listing_url", F.lit("+"))).otherwise(F.col("provenance.listing_url")).alias("listing_url")).alias("provenance"),
        F.struct(F.when(k % 5 == 0, ~F.col("quality.title_valid")).otherwise(F.col("quality.title_valid")).alias("title_valid")).alias("quality"), when(2, F.lit("0"), "content_hash"),
        F.struct(F.when(k % 8 == 0, "y").otherwise("x").alias("code")).alias("classification_hint"),
    )
    found = diff.refresh_diff(rows.where(k % 9 != 0), new)
    return found.select("id", "change", F.array_join("changed_fields", ",").alias("fields"), F.array_join("reasons", ",").alias("reasons"))


@query(
    f"""WITH {_DETECT}, s AS (SELECT DISTINCT doc_id AS id FROM f), c AS (SELECT *, (SELECT max(id) FROM s) AS top FROM s)
SELECT id, law FROM (SELECT id, unnest(list_filter([CASE WHEN id % 4 = 0 THEN 'action_allowed' END, CASE WHEN id % 5 = 0 THEN 'no_score' END, CASE WHEN id % 3 = 0 THEN 'timing_known' END, CASE WHEN id % 7 = 0 THEN 'primary_is_a_trigger' END,
CASE WHEN id % 2 = 0 THEN 'review_by_a_person' END, CASE WHEN id % 11 = 0 THEN 'origin_known' END, CASE WHEN id % 11 = 0 THEN 'hypotheses_of_rule' END], lambda v: v IS NOT NULL)) AS law FROM s)"""
)
def signal_contract(spark, sf):
    k = F.col("id").cast("long")
    found = F.when(k % 11 == 0, F.transform("triggers", lambda t: t.withField("product_hypotheses", F.array(F.lit("other"))))).otherwise(F.col("triggers"))
    rows = _signals(spark, sf).withColumns(
        {
            "suggested_next_action": F.when(k % 4 == 0, "SEND_EMAIL").otherwise(F.col("suggested_next_action")), "risk_score": F.when(k % 5 == 0, F.lit(0.5)), "timing_status": F.when(k % 3 != 0, F.col("timing_status")),
            "primary_trigger": F.when(k % 7 == 0, "OTHER").otherwise(F.col("primary_trigger")), "human_review_required": k % 2 != 0, "data_origin": F.when(k % 11 == 0, "elsewhere").otherwise(F.col("data_origin")), "triggers": found,
        }
    )
    return contracts.signal_violations(rows, RULES).select(k.alias("id"), "law")


@query(
    f"""WITH {_DETECT}, a AS (SELECT code, count(*) AS n FROM f GROUP BY code), r(value, add) AS (VALUES ('ALPHA', 1), ('GAMMA', -2))
SELECT o.data_origin, 'code' AS dim, r.value, coalesce(n, 0) + add AS told, coalesce(n, 0) AS counted FROM r LEFT JOIN a ON a.code = r.value, (VALUES ('all')) o(data_origin)"""
)
def summary_contract(spark, sf):
    s = _signals(spark, sf)
    wrong = F.when((F.col("data_origin") == "all") & (F.col("value") == "ALPHA"), 1).when((F.col("data_origin") == "all") & (F.col("value") == "GAMMA"), -2).otherwise(0)
    told = signals.trigger_summary(s, RULES).withColumn("n", F.col("n") + wrong)
    return contracts.summary_differences(s, told, RULES)


@query("SELECT trim(o_orderpriority) AS key, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, key")
def ordered_counts(spark, sf):
    return quality.ordered_counts(quality.count_by(_t(spark, sf, "orders"), F.col("o_orderpriority")))


_TAIL = r"(?:\s* - \s*(?:https?://\S+|[A-Za-z0-9.\-]+\.[a-z]{2,}"
_CLEAN = f"trim(regexp_replace(trim(raw, ' '), '{_TAIL}' || CASE WHEN coalesce(trim(source, ' '), '') <> '' THEN '|(?i:' || regexp_escape(trim(source, ' ')) || ')' ELSE '' END || '))+\\s*$', ''), ' ')"
_ARRIVED = f"""c AS (SELECT doc_id, lang, source, CASE WHEN doc_id % 3 = 0 THEN text || ' - ' || source WHEN doc_id % 3 = 1 THEN text || ' - news.example.com' ELSE replace(text, ' ', '') END AS raw FROM documents),
e AS (SELECT doc_id, lang, source, {_CLEAN} AS t FROM c), s AS (SELECT doc_id, lang, source, CASE WHEN length(t) > 80 AND NOT contains(t, ' ') THEN substr(t, 1, 80) || '[...]' ELSE t END AS text FROM e),
r AS (SELECT *, row_number() OVER (PARTITION BY trim(regexp_replace(lower(text), '\\s+', ' ', 'g'), ' ') ORDER BY CASE lang WHEN 'en' THEN 0 ELSE 1 END, doc_id) AS n FROM s WHERE text <> '')"""


def _feed(spark, sf):
    k = F.col("doc_id")
    title = F.when(k % 3 == 0, F.concat("text", F.lit(" - "), "source")).when(k % 3 == 1, F.concat("text", F.lit(" - news.example.com"))).otherwise(F.replace("text", F.lit(" "), F.lit("")))
    return _t(spark, sf, "documents").select(
        F.col("lang").alias("keyword"), F.when(F.col("lang") == "en", 0).otherwise(1).alias("kw_pos"), k.alias("pos"), title.alias("title"), F.concat(F.lit(" https://h.example/"), k).alias("link"),
        F.when(k % 2 == 0, "Mon, 05 Jan 2026 10:00:00 GMT").otherwise("soon").alias("pub_date"), "source",
    )


@query(
    f"""WITH {_ARRIVED} SELECT doc_id AS pos, lang AS keyword, md5(text) AS title, {_label_sql(feeds.CLIENT_KINDS, 'tidak_diketahui')} AS kind, 'https://h.example/' || doc_id AS link, 'google_news_rss' || coalesce(' (' || nullif(trim(source, ' '), '') || ')', '') AS sumber,
CASE WHEN doc_id % 2 = 0 THEN '2026-01-05T10:00:00+00:00' END AS published FROM r WHERE n = 1"""
)
def document_tenders(spark, sf):
    return feeds.tender_items(_feed(spark, sf)).select("pos", "keyword", F.md5("judul").alias("title"), F.col("jenis_klien_tebakan").alias("kind"), "link", "sumber", "published")


@query(
    f"""WITH {_ARRIVED} SELECT doc_id AS pos, md5(text) AS title, {_label_sql(feeds.CATEGORIES, 'lainnya', False)} AS category, {_label_sql(feeds.SEGMENTS, 'tidak_diketahui')} AS segment, lang AS keyword FROM r WHERE n = 1"""
)
def document_events(spark, sf):
    return feeds.event_items(_feed(spark, sf)).select("pos", F.md5("nama_event").alias("title"), F.col("kategori").alias("category"), F.col("segmen").alias("segment"), "keyword")
