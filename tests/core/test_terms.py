"""Term tables and rules as rows against the compiled matching."""

import random

import pytest
from pyspark.sql import functions as F

from headwater.functions import rules, text
from headwater.operators import durable, terms

WORDS = ["Alpha", "beta", "Gämma", "delta", "new", "plant", "opening", "tender"]


def random_texts(rng, n):
    return [" ".join(rng.choice([*WORDS, "x", "new plant"]) + rng.choice(["", ",", "-", "  "]) for _ in range(rng.randint(0, 14))) for _ in range(n)] + ["", None, "   "]


def random_terms(rng, most=3):
    return tuple(" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(0, most)))


@pytest.fixture(params=[None, 0], ids=["broadcast", "shuffled"])
def bound(request, monkeypatch):
    if request.param is not None:
        monkeypatch.setattr(durable, "BROADCAST_BYTES", request.param)


def folded(spark, texts):
    df = spark.createDataFrame([(i, t, "tender_corpus") for i, t in enumerate(texts)], "id long, title string, origin string")
    return text.bind(df, t=text.fold_search(F.col("title")))


def test_term_table_equals_compiled_terms(spark, bound):
    rng = random.Random(3)
    listed = [t for _ in range(40) for t in random_terms(rng)] + ["", "  ", "GAMMA", "gämma!", "a b c d e f g h"]
    docs = folded(spark, random_texts(rng, 120))
    table = terms.term_table(spark.createDataFrame(list(enumerate(listed)), "no long, term string"))
    got = {r.id: r.terms for r in terms.matched_lists(docs, "id", ["t"], table).collect()}
    want = docs.select("id", text.matched_terms(F.col("t"), text.unique_terms(listed)).alias("w")).collect()
    assert {r.id: r.w for r in want if r.w} == got


def test_no_term_and_no_text(spark):
    docs = folded(spark, ["a b"])
    none = terms.term_table(spark.createDataFrame([(0, "--")], "no long, term string"))
    assert terms.matched_lists(docs, "id", ["t"], none).collect() == []
    some = terms.term_table(spark.createDataFrame([(0, "a")], "no long, term string"))
    assert terms.matched_lists(docs.where("id < 0"), "id", ["t"], some).collect() == []


def test_terms_of_many_rows_meet_without_a_nested_loop(spark, bound):
    docs = folded(spark, ["w1 w2", "w4999"])
    table = terms.term_table(spark.range(5000).select(F.col("id").alias("no"), F.concat(F.lit("w"), "id").alias("term")))
    hits = terms.term_hits(docs, "id", ["t"], table)
    assert "NestedLoop" not in hits._jdf.queryExecution().toString() and "Cartesian" not in hits._jdf.queryExecution().toString()
    assert sorted((r.id, r.term) for r in hits.collect()) == [(0, "w1"), (0, "w2"), (1, "w4999")]


def random_rules(rng):
    made = []
    for i in range(12):
        phrases = random_terms(rng)
        made.append(
            rules.Trigger(
                f"R{i}", rng.choice(rules.CLASSES), phrases=phrases, positive=random_terms(rng), required_any=rng.choice([(), random_terms(rng)]), negative=rng.choice([(), (), random_terms(rng, 1)]),
                context_required=rng.choice([(), phrases[:1]]), context=random_terms(rng, 1), origins=rng.choice([(), ("tender_corpus",), ("event_corpus",)]),
            )
        )
    return rules.RuleSet(tuple(made), editorial=random_terms(rng, 2), suppressed=("R1", "R2", "R3"))


@pytest.mark.parametrize("seed", range(5))
def test_rules_as_rows_equal_compiled_rules(spark, seed):
    rng = random.Random(seed)
    ruleset = random_rules(rng)
    docs = folded(spark, random_texts(rng, 80)).withColumns({"traced": F.col("id") % 3 != 0, "dated": F.col("id") % 2 == 0})
    made, rows = terms.rule_frames(spark, ruleset)
    got = terms.detect_by_table(docs, "id", ["t"], made, rows, "origin", "traced", "dated").collect()
    found = rules.detect_all(F.col("t"), ruleset, origin=F.col("origin"), traceable=F.col("traced"), dated=F.col("dated"))
    want = docs.select("id", F.explode(found).alias("f")).select("id", "f.*").collect()
    assert sorted((r.id, r.code, r.trigger_class, r.strength, tuple(r.terms)) for r in got) == sorted((r.id, r.code, r.trigger_class, r.strength, tuple(r.terms)) for r in want)


def test_rules_over_two_fields_equal_compiled_rules(spark):
    rng = random.Random(9)
    ruleset = random_rules(rng)
    docs = folded(spark, random_texts(rng, 60)).withColumn("u", F.reverse(F.split("t", " "))).withColumn("u", F.array_join("u", " "))
    made, rows = terms.rule_frames(spark, ruleset)
    got = terms.detect_by_table(docs, "id", ["t", "u"], made, rows).collect()
    want = docs.select("id", F.explode(rules.detect_all([F.col("t"), F.col("u")], ruleset)).alias("f")).select("id", "f.*").collect()
    assert sorted((r.id, r.code, r.strength, tuple(r.terms)) for r in got) == sorted((r.id, r.code, r.strength, tuple(r.terms)) for r in want)
