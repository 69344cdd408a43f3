"""Signals: items with the triggers found in them, their summary, and official records matched with feed items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headwater.functions import dates, html
from headwater.functions.rules import TIMING, RuleSet, allowed_actions, detect_all, editorial_suppressed, primary, suggested_action, timing
from headwater.functions.text import evidence_excerpt, fold_search, has_text, matched_evidence, unique_terms

#: Where each type of item comes from.
DATA_ORIGIN = {"tender": "tender_corpus", "event": "event_corpus", "official": "official_source_pilot"}


def with_detections(items: DataFrame, rules: RuleSet) -> DataFrame:
    """Append data_origin, found (detections), primary and editorial_suppressed to normalized items.

    Terms are looked for in the title and, for official items, in the excerpt. Null titles hold no term. No exchange.
    """
    excerpt = F.coalesce(F.col("excerpt"), F.lit("")) if "excerpt" in items.columns else F.lit("")
    origin = F.coalesce(*[F.when(F.col("type") == t, F.lit(o)) for t, o in DATA_ORIGIN.items()])
    rows = items.withColumn("data_origin", origin)
    folded = F.struct(fold_search(F.coalesce("title", F.lit(""))).alias("__t"), F.when(F.col("data_origin") == DATA_ORIGIN["official"], fold_search(excerpt)).otherwise("").alias("__x"))
    # A generator of one row: without it a filter on the detections is pushed down with the folding copied into every term.
    rows = rows.select("*", F.explode(F.array(folded)).alias("__f")).select(*rows.columns, "__f.__t", "__f.__x")
    fields = [F.col("__t"), F.col("__x")]
    dated = dates.parse_time(F.col("date")).isNotNull()
    found = detect_all(fields, rules, origin=F.col("data_origin"), traceable=F.coalesce(html.is_traceable(F.col("source"), F.col("link")), F.lit(False)), dated=dated)
    return rows.withColumn("found", found).withColumn("editorial_suppressed", editorial_suppressed(fields, rules, F.col("data_origin"))).withColumn("primary", primary(F.col("found"), rules, F.col("__t")))


def build_signals(items: DataFrame, rules: RuleSet, reference: Column) -> DataFrame:
    """One row per item with a trigger: id, type, data_origin, title, source, link, date, organization, triggers, primary_trigger,
    primary_class, primary_strength, timing_status, suggested_next_action, human_review_required.

    Triggers carry the terms found, the evidence of each and an excerpt; every signal is left to a person.
    """
    rows = with_detections(items, rules).where(F.size("found") > 0)
    excerpt = F.coalesce(F.col("excerpt"), F.lit("")) if "excerpt" in items.columns else F.lit("")
    official = F.col("data_origin") == DATA_ORIGIN["official"]
    title = F.coalesce("title", F.lit(""))
    made = []
    for r in rules.triggers:
        d = F.try_element_at(F.filter("found", _is(r.code)), F.lit(1))
        terms = unique_terms((*r.phrases, *r.positive))
        evidence = matched_evidence({"title": title, "excerpt": F.when(official, excerpt).otherwise("")}, terms, {"title": F.col("__t"), "excerpt": F.col("__x")})
        shown = F.when(official, F.coalesce(F.try_element_at(evidence, F.lit(1))["excerpt"], F.lit(""))).otherwise(_around(title, terms))
        made.append(
            F.when(
                d.isNotNull(),
                F.struct(
                    F.lit(r.code).alias("trigger_code"), F.lit(r.label).alias("trigger_label"), F.lit(r.trigger_class).alias("trigger_class"), d["strength"].alias("evidence_strength"),
                    d["terms"].alias("matched_terms"), evidence.alias("matched_evidence"), shown.alias("evidence_excerpt"),
                    F.array(*map(F.lit, r.hypotheses)).cast("array<string>").alias("product_hypotheses"), F.lit(True).alias("human_review_required"),
                ),
            )
        )
    day = F.to_date(dates.parse_time(F.col("event_date")))
    published = dates.parse_time(F.col("published"))
    explicit = dates.names_future_date(title, reference) | F.when(official, dates.names_future_date(excerpt, reference)).otherwise(False)
    rows = rows.withColumn("timing_status", timing(F.col("primary"), day, published, reference, [F.col("__t"), F.col("__x")], rules, explicit))
    action = suggested_action(F.col("timing_status"), F.col("primary.trigger_class"), F.col("primary.strength"), F.col("organization"), allowed_actions(F.col("primary"), rules))
    return rows.select(
        "id", "type", "data_origin", "title", "source", "link", "date", "organization", F.array_compact(F.array(*made)).alias("triggers"),
        F.col("primary.code").alias("primary_trigger"), F.col("primary.trigger_class").alias("primary_class"), F.col("primary.strength").alias("primary_strength"),
        "timing_status", action.alias("suggested_next_action"), F.lit(True).alias("human_review_required"),
    )


def _is(code: str):
    return lambda x: x["code"] == code


def _around(title: Column, terms: list[str]) -> Column:
    return evidence_excerpt(title, terms) if terms else title


def trigger_summary(signals: DataFrame, rules: RuleSet) -> DataFrame:
    """(data_origin, dim, value, n), all origins together under ``all``: every match by code, the rest by the primary trigger.

    Codes, classes, strengths and states that do not occur are listed with zero. One pass over the signals; the map side
    adds up, so the exchange holds a row per distinct value and task.
    """
    kind = "array<struct<dim:string,value:string>>"
    pairs = F.flatten(
        F.array(
            F.transform("triggers", lambda t: F.struct(F.lit("code").alias("dim"), t["trigger_code"].alias("value"))).cast(kind),
            F.array(*[F.struct(F.lit(d).alias("dim"), F.col(c).alias("value")) for d, c in (("class", "primary_class"), ("strength", "primary_strength"), ("timing", "timing_status"))]).cast(kind),
        )
    )
    counts = signals.select(F.explode(F.array(F.lit("all"), F.col("data_origin"))).alias("data_origin"), pairs.alias("p")).select("data_origin", F.explode("p").alias("p"))
    counts = counts.groupBy("data_origin", "p.dim", "p.value").agg(F.count("*").alias("n"))
    values = {"code": [r.code for r in rules.triggers], "class": rules.class_precedence, "strength": rules.strength_precedence, "timing": TIMING}
    whole = [(o, d, v) for o in ("all", *DATA_ORIGIN.values()) for d, vs in values.items() for v in vs]
    frame = signals.sparkSession.createDataFrame(whole, "data_origin string, dim string, value string")
    return frame.join(counts, ["data_origin", "dim", "value"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def _keys(df: DataFrame, urls: list[str]) -> Column:
    """Structs (tier, key): the exact addresses, the normalized ones, and the folded title with its day."""
    exact = F.array_distinct(F.array_compact(F.array(*[F.when(has_text(F.col(u)), F.btrim(F.col(u))) for u in urls])))
    as_key = lambda tier: lambda k: F.struct(F.lit(tier).alias("tier"), k.alias("key"))
    normal = F.filter(F.array_distinct(F.transform(exact, html.normalize_url)), lambda u: u != "")
    title, day = fold_search(F.col("title")), F.date_format(dates.parse_time(F.col("published")), "yyyy-MM-dd")
    titled = F.when((title != "") & day.isNotNull(), F.concat_ws("\n", day, title))
    return F.concat(F.transform(exact, as_key(1)), F.transform(normal, as_key(2)), F.transform(F.array_compact(F.array(titled)), as_key(3)))


def match_official(official: DataFrame, items: DataFrame, urls: tuple[str, ...] = ("link",)) -> DataFrame:
    """(id, tier, item_id): each official row's feed item of the lowest tier, then the first by type, title, source and id.

    The feed side is reduced to one item per key before the join, so an address that many items share costs one row.
    """
    held = lambda df: [u for u in urls if u in df.columns]
    rank = F.struct("type", "title", "source", F.col("id").alias("item_id")).alias("rank")
    right = items.select(rank, F.explode(_keys(items, held(items))).alias("k")).groupBy("k").agg(F.min("rank").alias("rank"))
    left = official.select("id", F.explode(_keys(official, held(official))).alias("k"))
    best = left.join(right, "k").groupBy("id").agg(F.min(F.struct(F.col("k.tier").alias("tier"), "rank")).alias("m"))
    return best.select("id", "m.tier", F.col("m.rank.item_id").alias("item_id"))


def suppress_matched(official: DataFrame, matches: DataFrame) -> DataFrame:
    """The official rows without a feed item."""
    return official.join(matches.select("id"), "id", "left_anti")


def attach_provenance(signals: DataFrame, matches: DataFrame, official: DataFrame, fields: list[str]) -> DataFrame:
    """Append official_provenance to the signals: the fields of the official rows that match each one, by official id; else an empty list."""
    rows = official.select("id", F.struct(F.col("id").alias("official_id"), *fields).alias("p")).join(matches.select("id", "item_id"), "id")
    held = rows.groupBy(F.col("item_id").alias("id")).agg(F.array_sort(F.collect_list("p")).alias("official_provenance"))
    return signals.join(held, "id", "left").withColumn("official_provenance", F.coalesce("official_provenance", F.array().cast(held.schema["official_provenance"].dataType)))


def dashboard_order(signals: DataFrame, n: int = 20) -> DataFrame:
    """The first n signals: official and future, direct and future, official and current, other future, current, completed, historical; editorial ones stay out."""
    official, state = F.col("data_origin") == DATA_ORIGIN["official"], F.col("timing_status")
    future, current = state == "FUTURE_OR_OPEN", state == "CURRENT_OR_UNCLEAR"
    rank = F.when(official & future, 0).when(future & (F.col("primary_class") == "direct"), 1).when(official & current, 2).when(future, 3).when(current, 4).when(state == "COMPLETED_OR_PAST", 5).otherwise(6)
    return signals.where(state != "INFORMATIONAL_OR_EDITORIAL").withColumn("rank", rank).orderBy("rank", "id").limit(n)
