"""Decisions folded day by day: only the buckets that new events touch are written again.

``log`` holds every event once, ``state`` one row for each item; both are partitioned by a bucket of the item's hash.
A fold reads the log's touched buckets, leaves out events whose (item, event id) it has, computes the states of those
buckets and replaces them, and then appends the fresh events. States come from the log and the fresh events, never from
older states, so a fold that died between the two steps is simply run again, and a day that is folded twice changes
nothing. The states equal ``feedback.current_state`` over all events; of events of one item and id the first one folded
stays, and of those of one fold the earliest.

An item may hold a third of all events: its state is an aggregate, no list. Null items are one item.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headwater.operators.durable import durable
from headwater.operators.feedback import current_state

BUCKETS = 64


@dataclass(frozen=True)
class Folded:
    """What a fold did: events that were new, and the buckets that were written again."""

    fresh: int
    buckets: tuple[int, ...]


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return spark.read.parquet(path) if fs.exists(p) and any("=" in s.getPath().getName() for s in fs.listStatus(p)) else None


def read_state(spark: SparkSession, base: str) -> DataFrame | None:
    """The states of all items; None before the first fold."""
    return _read(spark, f"{base}/state")


def fold_events(events: DataFrame, base: str, item: str, ts: str, event_id: str, decision: str, buckets: int = BUCKETS, before_log=None) -> Folded:
    """Fold events into the state at ``base``. ``before_log`` is called between the two writes (for tests of failures)."""
    spark = events.sparkSession
    one = F.min(F.struct(ts, decision)).alias("e")
    new = events.groupBy(item, event_id).agg(one).select(item, event_id, f"e.{ts}", f"e.{decision}")
    new = durable(new.withColumn("bucket", F.pmod(F.xxhash64(item), F.lit(buckets)).cast("int")))
    touched = sorted(r.bucket for r in new.select("bucket").distinct().collect())  # as many as there are buckets at most
    if not touched:
        return Folded(0, ())
    log = _read(spark, f"{base}/log")
    if log is None:
        held, fresh = None, new
    else:
        held = log.where(F.col("bucket").isin(touched)).select(*new.columns)
        known = held.select(F.col("bucket").alias("__b"), F.col(item).alias("__i"), F.col(event_id).alias("__e"))
        same = (F.col("bucket") == F.col("__b")) & F.col(item).eqNullSafe(F.col("__i")) & F.col(event_id).eqNullSafe(F.col("__e"))
        fresh = durable(new.join(known, same, "left_anti"))
    both = fresh if held is None else held.unionByName(fresh)
    # the bucket is a function of the item, so the items of the touched buckets are whole here
    state = current_state(both, item, ts, event_id, decision).withColumn("bucket", F.pmod(F.xxhash64(item), F.lit(buckets)).cast("int"))
    state.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{base}/state")
    if before_log:
        before_log()
    fresh.repartition("bucket").write.mode("append").partitionBy("bucket").parquet(f"{base}/log")
    return Folded(fresh.count(), tuple(touched))
