"""Connected components by alternating star contractions, in rounds of joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwater.llm.common import durable, release


def _arrows(e: DataFrame, *arrows: tuple[str, str]) -> DataFrame:
    """One (u, v) row for each of the named column pairs of a row."""
    return e.select(F.explode(F.array(*[F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in arrows])).alias("x")).select("x.u", "x.v")


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least node of its neighbourhood."""
    both = _arrows(e, ("u", "v"), ("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    return _arrows(both.where(F.col("v") > F.col("u")).join(least, "u"), ("v", "m"))


def _small_star(e: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the least of them."""
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return _arrows(down.join(least, "u"), ("u", "m"), ("v", "m"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges(u, v)``; a component is named by its least node.

    Self-links and repeated links do no harm; nodes that stand in no link are not listed.
    """
    star = durable(edges.where("u != v").select("u", "v").distinct())
    before = None
    while not star.isEmpty():
        star = durable(_arrows(_small_star(_large_star(star)), ("u", "v")).where("u != v").distinct())
        now = star.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        release(star.sparkSession)
        if now == before:
            break
        before = now
    return _arrows(star, ("u", "v"), ("v", "v")).distinct().select(F.col("u").alias("node"), F.col("v").alias("component"))
