"""Queries of large term tables and of rules as rows: terms are the token runs of ``benchmark``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headwater.functions import text
from headwater.operators import terms
from headwater.operators.durable import durable
from headwater.plans.catalogue import _FOLD, _t, query

N_RULES = 500
_GRAMS = f"""g AS (SELECT {_FOLD} AS t FROM documents WHERE false UNION ALL SELECT {_FOLD} FROM benchmark), w AS (SELECT string_split(t, ' ') AS w FROM g),
forms AS (SELECT DISTINCT array_to_string(w[CAST(i AS BIGINT):CAST(i + k - 1 AS BIGINT)], ' ') AS form, k FROM w, range(1, 4) k(k), range(1, 100000) i(i) WHERE i + k - 1 <= len(w)),
d AS (SELECT doc_id, ' ' || {_FOLD} || ' ' AS t FROM documents)"""
_NUMBER = "CAST('0x' || substr(md5(form), 1, 12) AS BIGINT)"


def _forms(spark: SparkSession, sf: str) -> DataFrame:
    folded = text.bind(_t(spark, sf, "benchmark").select("text"), t=text.fold_search(F.col("text")))
    return durable(folded.select(F.explode(terms.token_grams(F.col("t"), [1, 2, 3])).alias("form")).where("form <> ''").distinct())


def _folded(spark: SparkSession, sf: str) -> DataFrame:
    return text.bind(_t(spark, sf, "documents").select("doc_id", "text"), t=text.fold_search(F.col("text"))).select("doc_id", "t")


@query(f"""WITH {_GRAMS}, h AS (SELECT doc_id, form FROM d JOIN forms ON contains(t, ' ' || form || ' ') WHERE form <> '')
SELECT doc_id, count(*) AS n_terms, md5(string_agg(form, '|' ORDER BY form)) AS terms FROM h GROUP BY doc_id""")
def term_table_hits(spark, sf):
    table = terms.term_table(_forms(spark, sf).withColumn("term", F.col("form")), order="form")
    found = terms.matched_lists(_folded(spark, sf), "doc_id", ["t"], table)
    return found.select("doc_id", F.size("terms").cast("long").alias("n_terms"), F.md5(F.array_join("terms", "|")).alias("terms"))


def _number(c: str):
    return F.conv(F.substring(F.md5(c), 1, 12), 16, 10).cast("long")


@query(f"""WITH {_GRAMS}, r AS (SELECT form, {_NUMBER} % {N_RULES} AS rule, CASE WHEN k = 3 THEN 'p' WHEN ({_NUMBER} // {N_RULES}) % 16 = 0 THEN 'n' WHEN ({_NUMBER} // {N_RULES}) % 16 < 4 THEN 'r' ELSE 'q' END AS role FROM forms WHERE form <> ''),
h AS (SELECT doc_id, rule, role, form FROM d JOIN r ON contains(t, ' ' || form || ' ')),
f AS (SELECT doc_id, rule, count(*) FILTER (role = 'p') AS p, count(*) FILTER (role = 'q') AS q, count(*) FILTER (role = 'r') AS r, count(*) FILTER (role = 'n') AS n, coalesce(string_agg(form, '|' ORDER BY form) FILTER (role IN ('p', 'q')), '') AS terms FROM h GROUP BY doc_id, rule)
SELECT doc_id, rule, CASE WHEN p > 0 AND rule % 3 < 2 THEN 'STRONG' WHEN p > 0 OR q > 1 THEN 'MODERATE' ELSE 'WEAK' END AS strength, md5(terms) AS terms FROM f WHERE p + q > 0 AND n = 0 AND (r > 0 OR rule % 4 > 0)""")
def rule_table_detection(spark, sf):
    number, length = _number("form"), F.size(F.split("form", " "))
    role = F.floor(number / N_RULES) % 16
    bits = F.when(length == 3, terms.PHRASE).when(role == 0, terms.NEGATIVE).when(role < 4, terms.REQUIRED).otherwise(terms.POSITIVE)
    rows = _forms(spark, sf).select((number % N_RULES).alias("rule"), "form", bits.alias("bits"))
    # the place of a term in its rule's list is its place in the order of forms, which the form itself gives
    own = F.col("bits").isin(terms.PHRASE, terms.POSITIVE)
    rows = rows.select("rule", "form", "bits", F.when(own, F.col("form")).alias("at"), F.when(own, F.col("form")).alias("term"))
    n = F.col("id")
    kind = F.element_at(F.array(*map(F.lit, ("direct", "historical", "indirect"))), (n % 3 + 1).cast("int"))
    rules = spark.range(N_RULES).select(n.alias("rule"), n.cast("string").alias("code"), kind.alias("trigger_class"), F.when(n % 4 == 0, terms.REQUIRED).otherwise(0).alias("needs"), F.array().cast("array<string>").alias("origins"))
    found = terms.detect_by_table(_folded(spark, sf), "doc_id", ["t"], rules, rows)
    return found.select("doc_id", "rule", "strength", F.md5(F.array_join("terms", "|")).alias("terms"))
