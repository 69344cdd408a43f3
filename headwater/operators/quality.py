"""Quality flags, severity, readiness checks, archives and the drop guard."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headwater.functions.text import has_text


def issue_codes(tests: dict[str, Column]) -> Column:
    """Codes of the tests that hold, in the order given; a null test does not hold."""
    return F.array_compact(F.array(*[F.when(t, F.lit(code)) for code, t in tests.items()]))


def severity(codes: Column, title_missing: str, link_missing: str, source_missing: str, medium: list[str]) -> Column:
    high = F.array_contains(codes, title_missing) | (F.array_contains(codes, link_missing) & F.array_contains(codes, source_missing))
    return F.when(high, "high").when(F.arrays_overlap(codes, F.array(*map(F.lit, medium))), "medium").otherwise("low")


def severity_rank(c: Column) -> Column:
    return F.when(c == "high", 0).when(c == "medium", 1).otherwise(2)


def tri_state(passed: Column, unknown: Column) -> Column:
    return F.when(unknown, "unknown").when(passed, "pass").otherwise("fail")


def readiness(checks: dict[str, Column], blocking: list[str], required: list[str]) -> Column:
    """NOT_READY if a blocking check fails, READY if all required ones pass, else NEEDS_REVIEW."""
    failed = reduce(lambda a, b: a | b, [checks[c] == "fail" for c in blocking])
    passed = reduce(lambda a, b: a & b, [checks[c] == "pass" for c in required])
    return F.when(failed, "NOT_READY").when(passed, "READY").otherwise("NEEDS_REVIEW")


def reason_codes(checks: dict[str, Column], order: list[str]) -> Column:
    """``<check>_FAILED`` or ``<check>_UNKNOWN`` in the fixed order."""
    return F.array_compact(
        F.array(*[F.when(checks[c] == "fail", F.lit(f"{c.upper()}_FAILED")).when(checks[c] == "unknown", F.lit(f"{c.upper()}_UNKNOWN")) for c in order])
    )


def next_action(reasons: Column, first: str, mapping: dict[str, str], fallback: str) -> Column:
    """One reason goes before all; else the first reason that is mapped; else the fallback."""
    known = F.filter(reasons, lambda r: r.isin(*mapping))
    table = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.when(F.array_contains(reasons, first), mapping.get(first, fallback)).otherwise(F.coalesce(F.try_element_at(table, F.try_element_at(known, F.lit(1))), F.lit(fallback)))


def count_by(df: DataFrame, c: Column, key: str = "key") -> DataFrame:
    """Counts of trimmed values; blank ones are left out."""
    return df.select(F.btrim(c).alias(key)).where(has_text(F.col(key))).groupBy(key).agg(F.count("*").alias("n"))


def ordered_counts(counts: DataFrame, key: str = "key", rank: list[str] | None = None) -> DataFrame:
    """Counts in the order of a report: by the configured rank of the keys, those without one last, else the most frequent first; then by key."""
    if rank is None:
        return counts.orderBy(F.desc("n"), key)
    place = F.array_position(F.array(*map(F.lit, rank)), F.col(key))
    return counts.orderBy(F.when(place > 0, place).otherwise(len(rank) + 1), F.desc("n"), key)


def zero_filled(dimension: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    return dimension.join(counts, key, "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))


def summary_sets(df: DataFrame, *dims: str) -> DataFrame:
    """Counts by each of the dimensions alone, from one pass: (dim, value, n)."""
    pairs = F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("value")) for d in dims])
    return df.select(F.explode(pairs).alias("p")).groupBy("p.dim", "p.value").agg(F.count("*").alias("n"))


def drop_guard(counts: DataFrame, least: int = 5, most_drop: float = 0.70) -> DataFrame:
    """Append ``verdict`` to (label, current, previous)."""
    drop = F.try_divide(F.col("previous") - F.col("current"), F.col("previous"))
    verdict = (
        F.when(F.col("current") == 0, "EMPTY")
        .when(F.col("current") < least, "TOO_FEW")
        .when(F.col("previous").isNull() | (F.col("previous") <= 0), "NO_BASELINE")
        .when(drop > most_drop, "DROP")
        .otherwise("OK")
    )
    return counts.withColumn("verdict", verdict)


def violations(df: DataFrame, laws: dict[str, Column]) -> DataFrame:
    """(law, n): how many rows break each law; laws that hold are listed with zero."""
    broken = [F.count_if(~F.coalesce(c, F.lit(False))).alias(n) for n, c in laws.items()]
    row = df.agg(*broken)
    return row.select(F.explode(F.array(*[F.struct(F.lit(n).alias("law"), F.col(n).alias("n")) for n in laws])).alias("x")).select("x.law", "x.n")


def score_fields(schema, path: str = "") -> list[str]:
    """Numeric fields, at any depth, whose name speaks of a score: output must have none."""
    from pyspark.sql import types as T

    out = []
    for f in schema.fields:
        name, kind = f"{path}{f.name}", f.dataType
        while isinstance(kind, T.ArrayType):
            kind = kind.elementType
        if isinstance(kind, T.StructType):
            out += score_fields(kind, name + ".")
        elif isinstance(kind, T.NumericType) and "score" in f.name.lower():
            out.append(name)
    return out
