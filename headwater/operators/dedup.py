"""Deduplication and keyed lookups with a defined survivor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headwater.operators.durable import durable
from headwater.operators.feedback import accept_records


def first_seen(df: DataFrame, key: Column, order: list[Column]) -> DataFrame:
    """The first row of each key in arrival order."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("__n", n).where("__n = 1").drop("__n")


def flag_duplicates(df: DataFrame, key: Column, least: int = 12, out: str = "is_duplicate") -> DataFrame:
    """Mark rows whose key (of enough characters) stands more than once; no row is dropped.

    Counts are aggregated first and joined back, so a key of very many rows is not sorted in one task.
    """
    keyed = df.withColumn("__key", F.when(F.length(key) >= least, key))
    many = keyed.where(F.col("__key").isNotNull()).groupBy("__key").agg(F.count("*").alias("__n")).where("__n > 1")
    return keyed.join(many, "__key", "left").withColumn(out, F.col("__n").isNotNull()).drop("__key", "__n")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def top_distinct(df: DataFrame, value: Column, order: Column, n: int = 20) -> DataFrame:
    """The first n values that differ in more than case, in arrival order."""
    rows = df.select(F.btrim(value).alias("value"), order.alias("pos")).where("value <> ''")
    return rows.groupBy(F.lower("value").alias("key")).agg(F.min_by("value", "pos").alias("value"), F.min("pos").alias("pos")).orderBy("pos").limit(n).select("value", "pos")


def greedy_shared(df: DataFrame, order: str, keys: list[str]) -> DataFrame:
    """Keep a row if none of its keys belongs to a kept row before it; ``dropped_by`` is the first such key of a dropped one.

    A dropped row reserves none of its keys. Every key counts in the whole frame, so a key of narrower scope holds its
    scope. Null and blank keys are none. Rows of equal keys stand for one record; those records are decided by
    ``feedback.accept_records``, and a row's reason is its first key that a kept row before it holds.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    record = F.struct(F.col(order).alias("o"), *names)
    rows = df.withColumns({n: F.coalesce(F.col(k).cast("string"), F.lit("")) for n, k in zip(names, keys, strict=True)}).withColumn("__r", record)
    rows = durable(rows.withColumn("__nth", F.row_number().over(Window.partitionBy("__r").orderBy(order))))
    held = [F.when(F.col(n) != "", F.concat(F.lit(f"{i}:"), F.col(n))) for i, n in enumerate(names)]
    first = rows.groupBy(*names).agg(F.min("__r").alias("__r")).select("__r", F.explode(F.array_compact(F.array(*held))).alias("__e"))
    first = durable(first)
    kept = accept_records(first, "__r", "__e").where("accepted").select("__r")
    owners = durable(first.join(kept, "__r").select("__e", F.col("__r").alias("__by")))
    out, reason = rows, F.lit("")
    for i, (n, k) in reversed(list(enumerate(zip(names, keys, strict=True)))):
        of = owners.where(F.col("__e").startswith(f"{i}:")).select(F.substring("__e", len(f"{i}:") + 1, 1 << 30).alias(n), F.col("__by").alias(f"__by{i}"))
        out = out.join(of, n, "left")
        before = (F.col(f"__by{i}") < F.col("__r")) | ((F.col(f"__by{i}") == F.col("__r")) & (F.col("__nth") > 1))
        reason = F.when(before, k).otherwise(reason)
    return out.select(*df.columns, reason.alias("dropped_by"))


def last_wins(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the last in order: for lookups."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("__r")).select(key, "__r.*")


def match_tiers(left: DataFrame, right: DataFrame, tiers: list[tuple[str, str]], left_id: str, right_rank: str) -> DataFrame:
    """(left_id, tier, right_rank): each left row's first match by the lowest tier, then the right row that comes first."""
    out = None
    for i, (a, b) in enumerate(tiers, 1):
        keyed = right.where(F.col(b).isNotNull()).groupBy(F.col(b).alias("__k")).agg(F.min(right_rank).alias(right_rank))
        hit = left.where(F.col(a).isNotNull()).select(left_id, F.col(a).alias("__k")).join(keyed, "__k").select(left_id, F.lit(i).alias("tier"), right_rank)
        out = hit if out is None else out.unionByName(hit)
    best = F.min(F.struct("tier", right_rank)).alias("m")
    return out.groupBy(left_id).agg(best).select(left_id, "m.*")
