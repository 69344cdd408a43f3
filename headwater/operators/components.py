"""Connected components by alternating star contractions, in rounds of joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwater.operators.durable import durable


def _arrows(e: DataFrame, *arrows: tuple[str, str]) -> DataFrame:
    """A row (u, v) for each named pair of columns."""
    return e.select(F.inline(F.array(*[F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in arrows])))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges(u, v)`` that have a link to another node; a component is named by its least node.

    Each round links the larger neighbours of every node, then its smaller ones, to the least of them, until no link
    changes; paths shrink by halves. Nodes may be of any type that can be ordered. Minima are taken in each task before
    rows move; the join of a node with very many links is split by Spark's skew join.
    """
    star, before = durable(edges.where("u <> v").select("u", "v").distinct()), None
    while not star.isEmpty():
        both = _arrows(star, ("u", "v"), ("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        wide = _arrows(both.where("v > u").join(least, "u"), ("v", "m")).where("u <> v").distinct()
        low = wide.groupBy("u").agg(F.min("v").alias("m"))
        star = durable(_arrows(wide.join(low, "u"), ("u", "m"), ("v", "m")).where("u <> v").distinct())
        now = star.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return _arrows(star, ("u", "v"), ("v", "v")).distinct().select(F.col("u").alias("node"), F.col("v").alias("component"))
