"""Crawling rules of a robots text as a Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def robots_allow(text: Column, path: Column, agent: str) -> Column:
    """Whether the rules let the agent fetch the path.

    Every agent line opens a group of its own, so of agents that are stacked only the last one gets the rules. A group
    counts if its agent is ``*`` or part of our name. The longest rule that begins the path decides, an allowing one
    wins ties; without a forbidding rule, a text or a match the path is free.
    """
    bare = F.transform(F.split(F.coalesce(text, F.lit("")), r"\r?\n"), lambda line: F.btrim(F.regexp_replace(line, "#.*$", "")))
    rules = F.transform(
        F.filter(bare, lambda line: F.contains(line, F.lit(":"))),
        lambda line: F.struct(F.lower(F.btrim(F.substring_index(line, ":", 1))).alias("key"), F.btrim(F.regexp_replace(line, "^[^:]*:", "")).alias("value")),
    )
    start = F.struct(F.lit(False).alias("ours"), F.lit(0).alias("allow"), F.lit(0).alias("deny"))

    def step(s: Column, r: Column) -> Column:
        named = F.lower(r["value"])
        hit = F.when(s["ours"] & path.startswith(r["value"]), F.length(r["value"])).otherwise(0)
        return F.struct(
            F.when(r["key"] == "user-agent", (named == "*") | F.contains(F.lit(agent.lower()), named)).otherwise(s["ours"]).alias("ours"),
            F.when(r["key"] == "allow", F.greatest(s["allow"], hit)).otherwise(s["allow"]).alias("allow"),
            F.when(r["key"] == "disallow", F.greatest(s["deny"], hit)).otherwise(s["deny"]).alias("deny"),
        )

    return F.aggregate(rules, start, step, lambda s: (s["deny"] == 0) | (s["allow"] >= s["deny"]))
