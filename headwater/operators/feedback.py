"""Event-sourced decisions: history, current state, merging, metrics."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from headwater.functions.dates import is_strict_date, parse_time
from headwater.functions.text import has_text, let, unique_texts
from headwater.operators.components import components
from headwater.operators.durable import durable
from headwater.operators.quality import issue_codes


def history(events: DataFrame, item: str, ts: str, event_id: str, decision: str) -> DataFrame:
    """Append ``previous_decision`` and ``event_type``; an item starts as UNREVIEWED."""
    w = Window.partitionBy(item).orderBy(ts, event_id)
    return events.withColumn("previous_decision", F.lag(decision, 1, "UNREVIEWED").over(w)).withColumn(
        "event_type", F.when(F.row_number().over(w) == 1, "CREATED").otherwise("UPDATED")
    )


def current_state(events: DataFrame, item: str, ts: str, event_id: str, decision: str) -> DataFrame:
    """One row per item: last decision, first and last time, number of events. Aggregates alone, no window."""
    last = F.max_by(F.col(decision), F.struct(ts, event_id))
    return events.groupBy(item).agg(last.alias("decision"), F.min(ts).alias("created_at"), F.max(ts).alias("updated_at"), F.count("*").alias("n_events"))


def merge_histories(local: DataFrame, imported: DataFrame, item: str, event_id: str) -> DataFrame:
    """Union by (item, event id); where both have an event the local one stays."""
    both = local.withColumn("__rank", F.lit(0)).unionByName(imported.withColumn("__rank", F.lit(1)))
    rest = [c for c in local.columns if c not in (item, event_id)]
    return both.groupBy(item, event_id).agg(F.min_by(F.struct(*rest), "__rank").alias("__r")).select(item, event_id, "__r.*")


def metrics(items: DataFrame, state: DataFrame, item: str) -> DataFrame:
    """One row: total, reviewed, unreviewed, decision changes, completion in percent to one decimal."""
    j = items.join(state, item, "left")
    n, r = F.count("*"), F.count("decision")
    changes = F.coalesce(F.sum(F.greatest(F.lit(0), F.col("n_events") - 1)), F.lit(0))
    return j.agg(
        n.alias("total"), r.alias("reviewed"), (n - r).alias("unreviewed"), changes.cast("long").alias("decision_changes"), F.coalesce(F.floor(F.try_divide(1000.0 * r, n) + 0.5) / 10, F.lit(0.0)).alias("completion")
    )


def next_unreviewed(items: DataFrame, state: DataFrame, item: str, priority: Column) -> DataFrame:
    return items.join(state.select(item), item, "left_anti").orderBy(priority, item).limit(1)


def preview_import(current: DataFrame, imported: DataFrame, active: DataFrame, item: str) -> DataFrame:
    """One row: how many imported records are new, conflict with a differing one, agree, or belong to no active item."""
    c = current.select(item, F.col("decision").alias("mine"))
    j = imported.select(item, "decision").join(c, item, "left").join(active.select(item).distinct().withColumn("active", F.lit(True)), item, "left")
    return j.agg(
        F.count_if(F.col("mine").isNull()).alias("added"),
        F.count_if(F.col("mine") != F.col("decision")).alias("conflicts"),
        F.count_if(F.col("mine") == F.col("decision")).alias("same"),
        F.count_if(F.col("active").isNull()).alias("orphaned"),
    )


def accept_records(events: DataFrame, record: str, event_id: str) -> DataFrame:
    """(record, accepted): a record is rejected if an accepted record before it, in key order, has one of its event ids.

    A rejected record reserves no ids. Records that share no id are accepted at once. Of the others, rounds accept the
    least open record of all of its ids and reject what shares an id with it, as long as a round at least halves the
    open rows; so there are as many rounds as the rows have binary digits at most. What is left, chains above all, is
    decided record by record within its connected component, the components spread over tasks. Null records are left
    out; null ids are shared with none.
    """
    e = events.select(F.col(record).alias("r"), F.col(event_id).alias("e")).where("r IS NOT NULL").distinct()
    e = durable(e)
    shared = e.where("e IS NOT NULL").groupBy("e").agg(F.count("*").alias("n")).where("n > 1").select("e")
    open_ = durable(e.join(shared, "e"))
    contested, accepted, size = open_.select("r").distinct(), [], open_.count()
    while size:
        least = open_.groupBy("e").agg(F.min("r").alias("least"))
        marked = open_.join(least, "e").groupBy("r").agg(F.min(F.col("r") == F.col("least")).alias("first"))
        taken = durable(marked.where("first").select("r"))
        accepted.append(taken)
        ids = open_.join(taken, "r", "left_semi").select("e").distinct()
        gone = open_.join(ids, "e", "left_semi").select("r").distinct()
        open_ = durable(open_.join(gone, "r", "left_anti"))
        before, size = size, open_.count()
        if size * 2 > before:
            accepted.append(_accept_in_order(open_))
            break
    free = e.select("r").distinct().join(contested, "r", "left_anti")
    for part in accepted:
        free = free.unionByName(part)
    everyone = e.select("r").distinct()
    return everyone.join(free.withColumn("accepted", F.lit(True)), "r", "left").select(F.col("r").alias(record), F.coalesce("accepted", F.lit(False)).alias("accepted"))


def _accept_in_order(open_: DataFrame) -> DataFrame:
    """The accepted records of ``open_(r, e)``, decided in order within each component.

    The rows of a component stream through one task, sorted by record, first to test a record's ids and then to reserve
    them; only ids that a later record has too are held, and each until its last record has passed.
    """
    ends = open_.groupBy("e").agg(F.min("r").alias("least"), F.max("r").alias("last"))
    linked = durable(open_.join(ends, "e"))
    groups = components(linked.select(F.col("r").alias("u"), F.col("least").alias("v")))
    # a record that shares no id with an open one any more is a component of its own
    placed = linked.join(groups.withColumnRenamed("node", "r"), "r", "left").withColumn("component", F.coalesce("component", "r"))
    phases = F.explode(F.array(F.lit(0), F.lit(1))).alias("phase")
    rows = placed.select(F.xxhash64("component").alias("part"), "component", "r", F.col("e").alias("id"), (F.col("r") == F.col("last")).alias("ends"), phases)
    kind = open_.schema["r"].dataType
    out = T.StructType([T.StructField("r", kind)])
    arrow = to_arrow_schema(out)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        component = record = None
        taken, good, told = set(), False, False
        for b in batches:
            kept = []
            for c, r, key, ends, phase in zip(*[b.column(i).to_pylist() for i in range(1, 6)]):
                if c != component:
                    component, taken = c, set()
                    record = None
                if r != record:
                    record, good, told = r, True, False
                if phase == 0:
                    good = good and key not in taken
                    continue
                if good and not told:
                    kept.append(r)
                    told = True
                if ends:
                    taken.discard(key)
                elif good:
                    taken.add(key)
            if kept:
                yield pa.RecordBatch.from_arrays([pa.array(kept, arrow.field(0).type)], schema=arrow)

    return durable(rows.repartition("part").sortWithinPartitions("part", "component", "r", "phase").mapInArrow(decide, out))


#: Decisions that a person may take, actions that no rule file may offer, and kinds of events.
DECISIONS = ("QUALIFIED", "NEEDS_RESEARCH", "WATCHLIST", "NOT_RELEVANT")
FORBIDDEN = ("SEND_WHATSAPP", "SEND_EMAIL", "CONTACT_PERSON", "SUBMIT_BID", "SEND_OFFER", "SET_PRICE")
EVENT_TYPES = ("DECISION_CREATED", "DECISION_UPDATED")


def validate_config(raw: dict) -> list[str]:
    """All errors of a file of feedback rules; an empty list means that it may be used."""
    if not isinstance(raw, dict):
        return ["an object is needed"]
    errors = [f"{k}: is missing" for k in ("schema_version", "storage_key", "reviewer_key") if not str(raw.get(k) or "").strip()]
    part = {k: raw.get(k) if isinstance(raw.get(k), dict) else {} for k in ("decision_states", "reason_codes", "allowed_next_actions", "validation")}
    errors += [f"{k}: an object is needed" for k in part if not isinstance(raw.get(k), dict)]
    for d in DECISIONS:
        codes = (part["decision_states"].get(d) or {}).get("reason_codes")
        if not codes:
            errors.append(f"{d}: no state or no reason codes")
        errors += [f"{d}: unknown reason {c}" for c in codes or [] if c not in part["reason_codes"]]
    errors += [f"{d}: is no decision" for d in part["decision_states"] if d not in DECISIONS]
    return errors + [f"{a}: is forbidden" for a in FORBIDDEN if a in part["allowed_next_actions"]]


def decision_errors(c: dict[str, Column] | Column, config: dict) -> Column:
    """Error codes of a decision (human_decision, reason_codes, reviewer_alias, note, next_action, review_date); nulls count as blank.

    Reasons must be those of the decision; which decisions need an action, or an action or a date, is the file's.
    """
    text = lambda n: F.coalesce(F.btrim(c[n]), F.lit(""))
    states = {d: config["decision_states"][d] for d in DECISIONS if d in config["decision_states"]}
    limits = config.get("validation") or {}
    decision, alias, action, day = text("human_decision"), text("reviewer_alias"), text("next_action"), text("review_date")
    reasons = unique_texts(c["reason_codes"])
    need = lambda key: decision.isin(*[d for d, r in states.items() if r.get(key)])
    foreign = F.lit(False)
    for d, r in states.items():
        foreign = foreign | ((decision == d) & (F.size(F.array_except(reasons, F.array(*map(F.lit, r["reason_codes"])))) > 0))
    tests = {
        "UNKNOWN_DECISION": ~decision.isin(*states),
        "ALIAS_REQUIRED": alias == "",
        "ALIAS_TOO_LONG": F.length(alias) > int(limits.get("reviewer_alias_max_length") or 50),
        "NOTE_TOO_LONG": F.length(text("note")) > int(limits.get("note_max_length") or 500),
        "REASON_REQUIRED": F.size(reasons) < int(limits.get("minimum_reason_codes") or 1),
        "REASON_OF_OTHER_DECISION": foreign,
        "NEXT_ACTION_REQUIRED": need("requires_next_action") & (action == ""),
        "ACTION_OR_DATE_REQUIRED": need("requires_review_date_or_next_action") & (action == "") & (day == ""),
        "NEXT_ACTION_UNKNOWN": (action != "") & ~action.isin(*config["allowed_next_actions"]),
        "REVIEW_DATE_INVALID": (day != "") & ~is_strict_date(day),
    }
    return issue_codes(tests)


def record_errors(records: DataFrame, config: dict) -> DataFrame:
    """Append errors to records (item_id, the fields of a decision, created_at, updated_at, history).

    History entries are structs of event_id, event_type, previous_decision, new_decision, reason_codes, next_action,
    reviewer_alias, note, timestamp. An entry that puts an item on the watch list without an action needs no date.
    """
    own = decision_errors({n: F.col(n) for n in ("human_decision", "reason_codes", "reviewer_alias", "note", "next_action", "review_date")}, config)

    def entry_fails(e: Column) -> Column:
        blank = F.coalesce(F.btrim(e["next_action"]), F.lit("")) == ""
        fields = {n: e[n] for n in ("reason_codes", "reviewer_alias", "note", "next_action")} | {"human_decision": e["new_decision"], "review_date": F.when((e["new_decision"] == "WATCHLIST") & blank, "2099-01-01").otherwise("")}
        known = e["event_type"].isin(*EVENT_TYPES) & e["previous_decision"].isin("UNREVIEWED", *DECISIONS) & (F.btrim(e["event_id"]) != "") & parse_time(e["timestamp"]).isNotNull()
        return ~F.coalesce(known & (F.size(decision_errors(fields, config)) == 0), F.lit(False))

    held = F.coalesce(F.size("history"), F.lit(0)) > 0
    ids = F.transform("history", lambda e: e["event_id"])
    more = {
        "ITEM_ID_REQUIRED": ~F.coalesce(has_text(F.col("item_id")), F.lit(False)),
        "CREATED_AT_INVALID": parse_time(F.col("created_at")).isNull(),
        "UPDATED_AT_INVALID": parse_time(F.col("updated_at")).isNull(),
        "HISTORY_REQUIRED": ~held,
        "HISTORY_EVENT_INVALID": held & F.exists("history", entry_fails),
        "EVENT_ID_REPEATED": held & (F.size(F.array_distinct(ids)) < F.size(ids)),
    }
    return records.withColumn("errors", F.concat(own, issue_codes(more)))


def import_records(current: DataFrame, imported: DataFrame, active: DataFrame, config: dict) -> DataFrame:
    """(item_id, outcome, is_conflict, is_orphan) of each imported record: invalid, EVENT_ID_REUSED or ACCEPTED.

    Invalid records reserve no event ids. A conflict is an item that has a record already, an orphan one that is not active.
    """
    checked = durable(record_errors(imported, config).select("item_id", F.size("errors").alias("n"), F.transform("history", lambda e: e["event_id"]).alias("ids")))
    events = checked.where("n = 0").select("item_id", F.explode("ids").alias("event_id"))
    taken = accept_records(events, "item_id", "event_id")
    flag = lambda df, name: df.select("item_id").distinct().withColumn(name, F.lit(True))
    out = checked.join(taken, "item_id", "left").join(flag(current, "c"), "item_id", "left").join(flag(active, "a"), "item_id", "left")
    outcome = F.when(F.col("n") > 0, "INVALID").when(F.col("accepted"), "ACCEPTED").otherwise("EVENT_ID_REUSED")
    return out.select("item_id", outcome.alias("outcome"), F.coalesce("c", F.lit(False)).alias("is_conflict"), F.col("a").isNull().alias("is_orphan"))


def merged_history(local: Column, imported: Column, imported_type) -> Column:
    """Both histories by time and event id; of entries of one id the first stays, local ones before imported ones."""
    none = F.array().cast(imported_type)
    both = F.filter(F.concat(F.coalesce(local, none), F.coalesce(imported, none)), lambda e: F.coalesce(has_text(e["event_id"]), F.lit(False)))

    def entries(both: Column) -> Column:
        # sorted by id and place, an entry is the first of its id if the one before it has another id
        order = F.array_sort(F.transform(both, lambda e, i: F.struct(e["event_id"].alias("i"), i.alias("n"))))
        first = lambda order: F.filter(order, lambda x, n: (n == 0) | (F.get(order, n - 1)["i"] != x["i"]))
        return F.transform(let(order, first), lambda x: F.get(both, x["n"]))

    return F.transform(F.array_sort(F.transform(let(both, entries), lambda e: F.struct(e["timestamp"].alias("t"), e["event_id"].alias("i"), e.alias("e")))), lambda x: x["e"])


def merge_records(local: DataFrame, imported: DataFrame) -> DataFrame:
    """Records of both sides by item_id: the later update wins, a tie stays local; created_at is the earlier one; histories merge."""
    fields = [c for c in local.columns if c not in ("item_id", "created_at", "history")]
    side = lambda df, n: df.select("item_id", F.struct("created_at", "history", *fields).alias(n))
    j = side(local, "l").join(side(imported, "i"), "item_id", "full_outer")
    newer = F.col("l").isNull() | F.coalesce(parse_time(F.col("i.updated_at")) > parse_time(F.col("l.updated_at")), F.lit(False))
    earlier = F.col("i").isNull() | F.coalesce(parse_time(F.col("l.created_at")) <= parse_time(F.col("i.created_at")), F.lit(False))
    kept = [F.when(newer, F.col(f"i.{f}")).otherwise(F.col(f"l.{f}")).alias(f) for f in fields]
    history = merged_history(F.col("l.history"), F.col("i.history"), local.schema["history"].dataType)
    return j.select("item_id", *kept, F.when(earlier, F.col("l.created_at")).otherwise(F.col("i.created_at")).alias("created_at"), history.alias("history")).select(*local.columns)


def with_decision(items: DataFrame, state: DataFrame, item: str, wanted: str = "") -> DataFrame:
    """Items with their decision, ``UNREVIEWED`` where there is none; only those of the wanted one, if one is named."""
    out = items.join(state.select(item, F.col("decision").alias("__d")), item, "left").withColumn("decision", F.coalesce("__d", F.lit("UNREVIEWED"))).drop("__d")
    return out.where(F.col("decision") == wanted) if wanted else out


def decision_distribution(items: DataFrame, state: DataFrame, item: str, decisions=DECISIONS) -> DataFrame:
    """(decision, n) of every decision, also of those that no item has."""
    held = items.join(state.select(item, "decision"), item).agg(*[F.count_if(F.col("decision") == d).alias(d) for d in decisions])
    return held.select(F.explode(F.array(*[F.struct(F.lit(d).alias("decision"), F.col(d).alias("n")) for d in decisions])).alias("x")).select("x.*")


def apply_decisions(records: DataFrame, inputs: DataFrame, config: dict) -> DataFrame:
    """All records after one decision per item, with ``errors`` of the inputs; a decision with errors changes nothing.

    ``records`` are as for ``record_errors``. ``inputs`` have item_id, human_decision, reason_codes, reviewer_alias, note,
    next_action, review_date, event_id and now. History only grows: an event is appended, and one whose id the record has
    already is refused. Refused inputs without a record are listed with their errors and no history. Several inputs for
    one item are all refused (``INPUT_REPEATED``), so an item keeps one row.
    """
    fields = ("human_decision", "reason_codes", "reviewer_alias", "note", "next_action", "review_date")
    asked = inputs.groupBy("item_id").agg(F.min_by(F.struct(*fields, "event_id", "now"), F.struct("now", "event_id")).alias("i"), F.count("*").alias("n_inputs"))
    j = records.select("item_id", F.struct(*[c for c in records.columns if c != "item_id"]).alias("r")).join(asked, "item_id", "full_outer")
    asked, prior = F.col("i").isNotNull(), F.col("r").isNotNull()
    used = F.coalesce(F.exists("r.history", lambda e: e["event_id"] == F.col("i.event_id")), F.lit(False))
    more = {"ITEM_ID_REQUIRED": ~F.coalesce(has_text(F.col("item_id")), F.lit(False)), "EVENT_ID_REQUIRED": ~F.coalesce(has_text(F.col("i.event_id")), F.lit(False)), "EVENT_ID_REPEATED": used, "INPUT_REPEATED": F.col("n_inputs") > 1}
    errors = F.when(asked, F.concat(decision_errors({n: F.col(f"i.{n}") for n in fields}, config), issue_codes(more))).otherwise(F.array().cast("array<string>"))
    j = j.withColumn("errors", errors)
    done = asked & (F.size("errors") == 0)
    trimmed = lambda n: F.coalesce(F.btrim(F.col(f"i.{n}")), F.lit(""))
    reasons = unique_texts(F.col("i.reason_codes"))
    given = {n: reasons if n == "reason_codes" else trimmed(n) for n in fields}
    entry = {
        "event_id": trimmed("event_id"), "event_type": F.when(prior, EVENT_TYPES[1]).otherwise(EVENT_TYPES[0]), "previous_decision": F.coalesce("r.human_decision", F.lit("UNREVIEWED")), "new_decision": given["human_decision"],
        "reason_codes": reasons, "next_action": given["next_action"], "reviewer_alias": given["reviewer_alias"], "note": given["note"], "timestamp": F.col("i.now"),
    }
    kind = records.schema["history"].dataType
    event = F.array(F.struct(*[entry[f.name].alias(f.name) for f in kind.elementType.fields]))
    old_start = F.when(parse_time(F.col("r.created_at")).isNotNull(), F.col("r.created_at")).otherwise(F.col("i.now"))
    made = {n: F.when(done, given[n]).otherwise(F.col(f"r.{n}")) for n in fields}
    made |= {
        "created_at": F.when(done, old_start).otherwise(F.col("r.created_at")), "updated_at": F.when(done, F.col("i.now")).otherwise(F.col("r.updated_at")),
        "history": F.when(done, F.concat(F.coalesce("r.history", F.array().cast(kind)), event)).otherwise(F.col("r.history")),
    }
    return j.select(*[F.col(c) if c == "item_id" else made.get(c, F.col(f"r.{c}")).alias(c) for c in records.columns], "errors")


def apply_import(current: DataFrame, imported: DataFrame, outcomes: DataFrame, schema_version: str, now: Column) -> tuple[DataFrame, DataFrame]:
    """(all records with the accepted ones merged in, one row of the root: schema_version, updated_at, n_records).

    ``outcomes`` are those of ``import_records``; records that are invalid or reuse an event id are left out.
    """
    fine = imported.join(outcomes.where("outcome = 'ACCEPTED'").select("item_id").distinct(), "item_id", "left_semi")
    merged = merge_records(current, fine)
    return merged, merged.agg(F.lit(schema_version).alias("schema_version"), F.first(now).alias("updated_at"), F.count("*").alias("n_records"))
