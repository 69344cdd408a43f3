"""Term tables of any size: token n-grams meet terms by equality, rules are rows evaluated from the hits.

A term matches where its folded tokens stand side by side in a folded text, that is where one of the text's token
n-grams equals it. So texts give their distinct n-grams, of the lengths that terms have, and join the term table on
equality: broadcast while its measured bytes fit the bound, shuffled beyond. No text meets a term that it does not hold.

A rule's terms are numbered rows with the roles that they play in it, as bits. The bits of a document's hits are joined
by OR for each rule, and the rule is decided by tests of those bits, however many terms or rules there are.

Null and empty texts hold no term; terms that fold to nothing match nothing. Rows that share an id are one document,
found in any of its fields. A term that stands in a third of all rows is a hot key of the shuffled join only, which
Spark splits; hits are aggregated by document, in the task that read it, before they move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headwater.functions.rules import RuleSet
from headwater.functions.text import fold_search, fold_term, let, unique_terms
from headwater.operators.durable import broadcast_if_small, durable

#: Roles of a term within a rule. FREE: a phrase that needs no context.
PHRASE, POSITIVE, REQUIRED, NEEDS_CONTEXT, CONTEXT, EDITORIAL, NEGATIVE, FREE = (1 << i for i in range(8))


def token_grams(folded: Column, lengths: list[int]) -> Column:
    """Distinct runs of so many tokens of a text folded by ``fold_search``."""

    def runs(words: Column, k: int) -> Column:
        if k == 1:
            return words
        run = F.transform(F.sequence(F.lit(1), F.size(words) - (k - 1)), lambda i: F.array_join(F.slice(words, i, F.lit(k)), " "))
        return F.when(F.size(words) >= k, run).otherwise(F.array().cast("array<string>"))

    def of(words: Column) -> Column:
        return F.array_distinct(F.concat(*[runs(words, k) for k in lengths]))

    return let(F.split(F.coalesce(folded, F.lit("")), " "), of) if lengths else F.array().cast("array<string>")


def term_table(terms: DataFrame, term: str = "term", order: str = "no") -> DataFrame:
    """(form, no, term): for each folded form the term that comes first; terms that fold to nothing are left out."""
    t = terms.select(fold_search(F.col(term)).alias("form"), F.struct(F.col(order).alias("no"), F.col(term).alias("term")).alias("t"))
    return t.where("form <> ''").groupBy("form").agg(F.min("t").alias("t")).select("form", "t.no", "t.term")


def _matched(docs: DataFrame, keep: list[str], folded: list[str], table: DataFrame) -> DataFrame:
    """Every (kept columns, columns of the table) where a field holds the table's form."""
    lengths = [r.n for r in table.select(F.size(F.split("form", " ")).alias("n")).distinct().orderBy("n").collect()]
    grams = [token_grams(F.col(c), lengths) for c in folded]
    grams = F.array_distinct(F.concat(*grams)) if len(grams) > 1 else grams[0]
    held = docs.select(*keep, F.explode(grams).alias("form"))
    row_bytes = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in table.columns), F.lit(32))
    return held.join(broadcast_if_small(table, row_bytes), "form")


def term_hits(docs: DataFrame, id_col: str, folded: list[str], terms: DataFrame) -> DataFrame:
    """(id, no, term) of each term of a ``term_table`` that some field holds, once for each row of ``docs``."""
    return _matched(docs, [id_col], folded, durable(terms)).select(id_col, "no", "term")


def matched_lists(docs: DataFrame, id_col: str, folded: list[str], terms: DataFrame) -> DataFrame:
    """(id, terms): the terms that occur, in the table's order; documents without any are not listed."""
    hits = term_hits(docs, id_col, folded, terms).groupBy(id_col).agg(F.sort_array(F.collect_set(F.struct("no", "term"))).alias("t"))
    return hits.select(id_col, F.transform("t", lambda x: x["term"]).alias("terms"))


RULES_SCHEMA = "rule long, code string, trigger_class string, needs int, origins array<string>"
RULE_TERMS_SCHEMA = "rule long, form string, bits int, at int, term string"


def rule_frames(spark: SparkSession, rules: RuleSet) -> tuple[DataFrame, DataFrame]:
    """A rule set as rows: (rules, terms of rules by folded form), as ``detect_by_table`` takes them."""
    made, terms = [], []
    for n, r in enumerate(rules.triggers):
        suppressed = rules.editorial if r.code in rules.suppressed else ()
        made.append((n, r.code, r.trigger_class, REQUIRED if r.required_any else 0, list(r.origins)))
        listed = {fold_term(t): (i, t) for i, t in enumerate(unique_terms((*r.phrases, *r.positive)))}
        free = [t for t in unique_terms(r.phrases) if r.context_required and t not in r.context_required]
        context = r.context if r.context_required else ()
        roles = ((PHRASE, r.phrases), (POSITIVE, r.positive), (REQUIRED, r.required_any), (NEEDS_CONTEXT, r.context_required), (CONTEXT, context), (EDITORIAL, suppressed), (NEGATIVE, r.negative), (FREE, free))
        bits: dict[str, int] = {}
        for bit, names in roles:
            for f in filter(None, map(fold_term, names)):
                bits[f] = bits.get(f, 0) | bit
        terms += [(n, f, b, *listed.get(f, (None, None))) for f, b in bits.items()]
    return spark.createDataFrame(made, RULES_SCHEMA), spark.createDataFrame(terms, RULE_TERMS_SCHEMA)


def detect_by_table(docs: DataFrame, id_col: str, folded: list[str], rules: DataFrame, rule_terms: DataFrame, origin: str | None = None, traceable: str | None = None, dated: str | None = None) -> DataFrame:
    """(id, rule, code, trigger_class, strength, terms), one row for each rule that a document fits.

    ``rules`` are (rule, code, trigger_class, needs, origins), ``needs`` the roles of which some term must occur;
    ``rule_terms`` are (rule, form, bits, at, term), one row for each form of a rule, ``at`` its place in the list of the
    rule's own terms, null for terms of other roles. ``origin``, ``traceable`` and ``dated`` name columns of the documents.
    """
    context = list(dict.fromkeys(c for c in (origin, traceable, dated) if c))
    hits = _matched(docs, [id_col, *context], folded, durable(rule_terms))
    found = hits.groupBy(id_col, *context, "rule").agg(
        F.bit_or("bits").alias("bits"),
        F.count_if(F.col("bits").bitwiseAND(POSITIVE) != 0).alias("n_positive"),
        F.sort_array(F.collect_set(F.when(F.col("at").isNotNull(), F.struct("at", "term")))).alias("terms"),
    )
    width = F.lit(32) + sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in ("code", "trigger_class", "origins")), F.lit(0))
    j = found.join(broadcast_if_small(durable(rules), width), "rule")
    has = lambda mask: F.col("bits").bitwiseAND(mask) != 0
    ok = has(PHRASE | POSITIVE) & ~has(EDITORIAL | NEGATIVE) & (F.col("bits").bitwiseAND(F.col("needs")) == F.col("needs"))
    ok &= ~(has(NEEDS_CONTEXT) & ~has(CONTEXT) & ~has(FREE))
    if origin:
        ok &= (F.size("origins") == 0) | F.array_contains("origins", F.coalesce(F.col(origin), F.lit("")))
    trusted, day = (F.col(c) if c else F.lit(True) for c in (traceable, dated))
    strong = has(PHRASE) & F.col("trigger_class").isin("direct", "historical") & trusted & day
    strength = F.when(strong, "STRONG").when(has(PHRASE), "MODERATE").when((F.col("n_positive") >= 2) & trusted, "MODERATE").otherwise("WEAK")
    return j.where(ok).select(id_col, "rule", "code", "trigger_class", strength.alias("strength"), F.transform("terms", lambda t: t["term"]).alias("terms"))
