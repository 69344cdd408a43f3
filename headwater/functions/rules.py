"""Rules as data: validated on the driver, compiled to Columns."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from headwater.functions.text import any_term, contains_term, has_text, matched_terms, ordered_context, unique_terms

CLASSES = ("direct", "historical", "indirect")


STRENGTHS = ("STRONG", "MODERATE", "WEAK")
#: Origins that a trigger may be limited to, states of timing, and actions that no rule may name.
ORIGINS = ("tender_corpus", "event_corpus", "official_source_pilot")
TIMING = ("FUTURE_OR_OPEN", "CURRENT_OR_UNCLEAR", "COMPLETED_OR_PAST", "HISTORICAL_REFERENCE", "INFORMATIONAL_OR_EDITORIAL")
FORBIDDEN = ("CONTACT_PERSON", "SEND_EMAIL", "SEND_WHATSAPP", "SUBMIT_OFFER", "SUBMIT_BID", "SET_PRICE")


@dataclass(frozen=True)
class Trigger:
    """One detectable code with its terms."""

    code: str
    trigger_class: str
    phrases: tuple[str, ...] = ()
    positive: tuple[str, ...] = ()
    required_any: tuple[str, ...] = ()
    negative: tuple[str, ...] = ()
    context_required: tuple[str, ...] = ()
    context: tuple[str, ...] = ()
    origins: tuple[str, ...] = ()
    actions: tuple[str, ...] = ("VERIFY_TRIGGER",)
    label: str = ""
    hypotheses: tuple[str, ...] = ()


@dataclass(frozen=True)
class RuleSet:
    """A rule file: triggers, orders of precedence and the terms of timing, editorial and primary rules."""

    triggers: tuple[Trigger, ...]
    class_precedence: tuple[str, ...] = CLASSES
    strength_precedence: tuple[str, ...] = STRENGTHS
    future: tuple[str, ...] = ()
    completed: tuple[str, ...] = ()
    invitation_leads: tuple[str, ...] = ()
    invitation_actions: tuple[str, ...] = ()
    completed_actors: tuple[str, ...] = ()
    completed_actions: tuple[str, ...] = ()
    completed_passive: tuple[str, ...] = ()
    completed_quantity: tuple[str, ...] = ()
    editorial: tuple[str, ...] = ()
    suppressed: tuple[str, ...] = ()
    active_direct: tuple[str, ...] = ()
    historical_dominant: tuple[str, ...] = ()
    rivals: tuple[str, str] = ("DIRECT_PROCUREMENT", "HISTORICAL_PROCUREMENT_PATTERN")
    stale_days: int = 60


#: Sections and keys of a rule file, with the fields that they fill.
_SECTIONS = {
    "timing_rules": {
        "future_or_open_phrases": "future", "invitation_lead_terms": "invitation_leads", "invitation_action_terms": "invitation_actions",
        "completed_or_past_phrases": "completed", "completed_actor_terms": "completed_actors", "completed_action_terms": "completed_actions",
        "completed_passive_terms": "completed_passive", "completed_quantity_terms": "completed_quantity",
    },
    "editorial_rules": {"terms": "editorial", "suppressed_trigger_codes": "suppressed"},
    "primary_trigger_rules": {"active_direct_terms": "active_direct", "historical_dominant_terms": "historical_dominant"},
}
_TRIGGER = {
    "phrase_terms": "phrases", "positive_terms": "positive", "negative_terms": "negative", "allowed_actions": "actions", "product_hypotheses": "hypotheses",
    "required_any_terms": "required_any", "context_required_terms": "context_required", "context_terms": "context", "origin_scope": "origins",
}
#: Keys that every trigger of a rule file has.
_NEEDED = ("phrase_terms", "positive_terms", "negative_terms", "allowed_actions", "product_hypotheses")


def _texts(value, where: str, errors: list[str]) -> list[str]:
    if not isinstance(value, list) or any(not isinstance(t, str) or not t.strip() for t in value):
        errors.append(f"{where}: a list of texts is needed")
        return []
    return value


def validate(raw: dict) -> list[str]:
    """All errors of a rule file at once; an empty list means that it may be used."""
    if not isinstance(raw, dict):
        return ["an object is needed"]
    errors, seen = [], set()
    if not str(raw.get("version") or "").strip():
        errors.append("version: is missing")
    for name, whole in (("class_precedence", CLASSES), ("strength_precedence", STRENGTHS), ("timing_statuses", TIMING)):
        if sorted(map(str, raw.get(name) or [])) != sorted(whole):
            errors.append(f"{name}: must hold {', '.join(whole)} once each")
    age = raw.get("future_signal_max_published_age_days")
    if isinstance(age, bool) or not isinstance(age, int) or age < 0:
        errors.append("future_signal_max_published_age_days: must be a whole number")
    for section, keys in _SECTIONS.items():
        held = raw.get(section)
        for key in (*keys, *(("ambiguous_verbs",) if section == "timing_rules" else ())):
            _texts(held.get(key) if isinstance(held, dict) else None, f"{section}.{key}", errors)
    allowed = _texts(raw.get("allowed_actions"), "allowed_actions", errors)
    if allowed == []:
        errors.append("allowed_actions: must not be empty")
    errors += [f"allowed_actions: {a} is forbidden" for a in allowed if a in FORBIDDEN]
    entries = raw.get("triggers")
    if not isinstance(entries, list) or not entries:
        return [*errors, "triggers: a non-empty list is needed"]
    for i, e in enumerate(entries):
        if not isinstance(e, dict):
            errors.append(f"triggers[{i}]: an object is needed")
            continue
        at = f"triggers[{i}]"
        errors += [f"{at}.{k}: is missing" for k in ("code", "label", "description") if not str(e.get(k) or "").strip()]
        if e.get("code") in seen:
            errors.append(f"{e['code']}: stands twice")
        seen.add(e.get("code"))
        if e.get("trigger_class") not in CLASSES:
            errors.append(f"{at}.trigger_class: is unknown")
        optional = [k for k in _TRIGGER if k not in _NEEDED and k in e] + (["context_terms"] if "context_required_terms" in e and "context_terms" not in e else [])
        got = {k: _texts(e.get(k), f"{at}.{k}", errors) for k in (*_NEEDED, *optional)}
        errors += [f"{at}.origin_scope: {o} is unknown" for o in got.get("origin_scope", []) if o not in ORIGINS]
        errors += [f"{at}.allowed_actions: {a} is not allowed" for a in got["allowed_actions"] if a not in allowed]
    rules = raw.get("editorial_rules")
    if isinstance(rules, dict) and isinstance(rules.get("suppressed_trigger_codes"), list):
        errors += [f"editorial_rules: {c} is no trigger" for c in rules["suppressed_trigger_codes"] if c not in seen]
    return errors


def load(raw: dict) -> RuleSet:
    """The rules of a file; a file with errors is refused with all of them."""
    if errors := validate(raw):
        raise ValueError("; ".join(errors))
    terms = {field: tuple(raw[section][key]) for section, keys in _SECTIONS.items() for key, field in keys.items()}
    made = tuple(
        Trigger(e["code"], e["trigger_class"], label=e["label"], **{field: tuple(e[key]) for key, field in _TRIGGER.items() if key in e}) for e in raw["triggers"]
    )
    return RuleSet(made, tuple(raw["class_precedence"]), tuple(raw["strength_precedence"]), stale_days=raw["future_signal_max_published_age_days"], **terms)


def first_match(c: Column, rules, default: str, match) -> Column:
    """Label of the first rule of which some key matches."""
    out = None
    for label, keys in rules:
        hit = reduce(lambda a, b: a | b, [match(c, k) for k in keys])
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(default)


def first_in_list(c: Column, names) -> Column:
    """The first name in list order that stands in the text as a word, any case."""
    import re

    return F.coalesce(*[F.when(c.rlike(rf"(?iu)(^|[^\p{{L}}\p{{N}}_]){re.escape(n)}([^\p{{L}}\p{{N}}_]|$)"), F.lit(n)) for n in names])


def extract_name(c: Column, patterns, stop_words, least: int = 2) -> Column:
    """Name from the first pattern that leaves enough words before a stop word (not counting the first word)."""
    tries = []
    for p in patterns:
        words = F.split(F.btrim(F.regexp_extract(c, p, 1)), r"\s+")
        stop = F.transform(words, lambda w, i: (i > 0) & F.lower(F.btrim(w, F.lit(".,"))).isin(*stop_words))
        at = F.array_position(stop, True)
        kept = F.when(at > 0, F.slice(words, F.lit(1), (at - 1).cast("int"))).otherwise(words)
        tries.append(F.when(F.size(kept) >= least, F.array_join(kept, " ")))
    return F.coalesce(*tries)


def _fields(folded) -> list[Column]:
    return list(folded) if isinstance(folded, (list, tuple)) else [folded]


def _any(folded, test) -> Column:
    return reduce(lambda a, b: a | b, [test(c) for c in _fields(folded)])


def any_hit(folded, terms) -> Column:
    """Whether a term stands in any of the fields."""
    return _any(folded, lambda c: any_term(c, terms))


def hits(folded, terms) -> Column:
    """The terms that stand in any of the fields, in rule order, once for each folded form."""
    return matched_terms(None, unique_terms(terms), lambda _, t: _any(folded, lambda c: contains_term(c, t)))


def detect(folded, rule: Trigger, rules: RuleSet | None = None, origin: Column | None = None, traceable: Column | None = None, dated: Column | None = None) -> Column:
    """STRUCT of a detection or null: scope, terms, required terms, context, editorial and negative terms, in this order.

    ``folded`` is one folded text or a list of them (title, excerpt); a term counts if any of them holds it.
    """
    phrase, positive = hits(folded, rule.phrases), hits(folded, rule.positive)
    ok = (F.size(phrase) > 0) | (F.size(positive) > 0)
    if rule.origins and origin is not None:
        ok = origin.isin(*rule.origins) & ok
    if rule.required_any:
        ok &= any_hit(folded, rule.required_any)
    if rule.context_required:
        only = F.size(F.array_except(phrase, F.array(*map(F.lit, rule.context_required)))) == 0
        ok &= ~(any_hit(folded, rule.context_required) & ~any_hit(folded, rule.context) & only)
    if rules is not None and rule.code in rules.suppressed:
        ok &= ~any_hit(folded, rules.editorial)
    if rule.negative:
        ok &= ~any_hit(folded, rule.negative)
    traceable = F.lit(True) if traceable is None else traceable
    dated = F.lit(True) if dated is None else dated
    strong = (F.size(phrase) > 0) & F.lit(rule.trigger_class in ("direct", "historical")) & traceable & dated
    strength = F.when(strong, "STRONG").when(F.size(phrase) > 0, "MODERATE").when((F.size(positive) >= 2) & traceable, "MODERATE").otherwise("WEAK")
    terms = hits(folded, (*rule.phrases, *rule.positive))
    return F.when(ok, F.struct(F.lit(rule.code).alias("code"), F.lit(rule.trigger_class).alias("trigger_class"), strength.alias("strength"), terms.alias("terms")))


def detect_all(folded, rules: RuleSet, **context) -> Column:
    return F.array_compact(F.array(*[detect(folded, r, rules, **context) for r in rules.triggers]))


def editorial_suppressed(folded, rules: RuleSet, origin: Column | None = None) -> Column:
    """Whether an editorial term kept a trigger of the suppressed codes from a text that it fits otherwise."""
    out = F.lit(False)
    for r in rules.triggers:
        if r.code in rules.suppressed:
            out = out | detect(folded, replace(r, negative=()), origin=origin).isNotNull()
    return out & any_hit(folded, rules.editorial)


def primary(detections: Column, rules: RuleSet, title: Column | None = None) -> Column:
    """The detection of the least (class rank, strength rank, rule rank, code), found within the row.

    Where both rivals of the rules are detected and the folded title is given, terms of an active case choose the first
    rival, else terms of a past case the second one.
    """
    place = lambda c, names: reduce(lambda a, n: a.when(c == n[1], n[0]), enumerate(names), F.when(F.lit(False), 0)).otherwise(len(names))
    ranked = F.transform(
        detections,
        lambda d: F.struct(
            place(d["trigger_class"], rules.class_precedence).alias("a"),
            place(d["strength"], rules.strength_precedence).alias("b"),
            place(d["code"], [r.code for r in rules.triggers]).alias("c"),
            d.alias("d"),
        ),
    )
    least = F.array_min(ranked)["d"]
    if title is None:
        return least
    of = lambda code: F.try_element_at(F.filter(detections, lambda d: d["code"] == code), F.lit(1))
    first, second = map(of, rules.rivals)
    both = first.isNotNull() & second.isNotNull()
    return F.when(both & any_term(title, rules.active_direct), first).when(both & any_term(title, rules.historical_dominant), second).otherwise(least)


def timing(detection: Column, event_day: Column, published: Column, reference: Column, folded, rules: RuleSet, future_date: Column | None = None) -> Column:
    """First state that applies: past cases, editorial texts, the event's day, future phrases or invitations, completed phrases.

    A stale future phrase counts only beside an explicit later date (``future_date``).
    """
    from headwater.functions.dates import is_stale

    day, stale = F.to_date(reference), is_stale(published, reference, rules.stale_days)
    explicit = F.lit(False) if future_date is None else F.coalesce(future_date, F.lit(False))
    ordered = lambda leads, actions: _any(folded, lambda c: ordered_context(c, leads, actions)) if leads and actions else F.lit(False)
    future = any_hit(folded, rules.future) | ordered(rules.invitation_leads, rules.invitation_actions)
    passive = _any(folded, lambda c: any_term(c, rules.completed_passive) & any_term(c, rules.completed_quantity) & any_term(c, rules.completed_actors))
    completed = any_hit(folded, rules.completed) | ordered(rules.completed_actors, rules.completed_actions) | passive
    return (
        F.when(detection["trigger_class"] == "historical", "HISTORICAL_REFERENCE")
        .when(any_hit(folded, rules.editorial) & (detection["trigger_class"] != "direct"), "INFORMATIONAL_OR_EDITORIAL")
        .when(event_day > day, "FUTURE_OR_OPEN")
        .when(event_day < day, "COMPLETED_OR_PAST")
        .when(event_day == day, "CURRENT_OR_UNCLEAR")
        .when(future & (~stale | explicit), "FUTURE_OR_OPEN")
        .when(future, "CURRENT_OR_UNCLEAR")
        .when(completed, "COMPLETED_OR_PAST")
        .otherwise("CURRENT_OR_UNCLEAR")
    )


def suggested_action(state: Column, trigger_class: Column, strength: Column, organization: Column, allowed: Column) -> Column:
    """First action of the timing state that the rule allows, else the check of a weak trigger, else the rule's first action."""
    may = lambda name, when: F.when(when & F.array_contains(allowed, name), F.lit(name))
    future, blank = state == "FUTURE_OR_OPEN", ~F.coalesce(has_text(organization), F.lit(False))
    return F.coalesce(
        may("VERIFY_ORGANIZATION", future & blank),
        may("VERIFY_PRODUCT_NEED", future & (trigger_class == "indirect")),
        may("PREPARE_FOR_HUMAN_QUALIFICATION", future),
        may("VERIFY_TIMING", state == "CURRENT_OR_UNCLEAR"),
        may("VERIFY_TRIGGER", state == "CURRENT_OR_UNCLEAR"),
        may("ADD_TO_WATCHLIST", state.isin("COMPLETED_OR_PAST", "HISTORICAL_REFERENCE")),
        may("VERIFY_TIMING", state == "COMPLETED_OR_PAST"),
        may("VERIFY_TRIGGER", state.isin("HISTORICAL_REFERENCE", "INFORMATIONAL_OR_EDITORIAL") | (strength == "WEAK")),
        F.try_element_at(allowed, F.lit(1)),
    )


def allowed_actions(detection: Column, rules: RuleSet) -> Column:
    """The actions of the detected rule."""
    return reduce(lambda a, r: a.when(detection["code"] == r.code, F.array(*map(F.lit, r.actions))), rules.triggers, F.when(F.lit(False), F.array(F.lit(""))))
