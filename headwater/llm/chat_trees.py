"""Chat formatting: reply trees, native DataFrame operations only.

Messages point to the message they answer. Self-joins of doubling reach (parent, grandparent, great-great-
grandparent ...) give each message its depth and the summed score of its path, so a path of length d takes
log2(d) rounds. Leaves are ranked within their tree, the best ``branches`` are expanded back to the messages of
their paths, and each path becomes one formatted conversation with a loss mask.

A turn is written ``<s>role\\ntext</s>``. In roles and texts ``&``, ``<`` and ``[`` become ``&amp;``, ``&lt;`` and
``&#91;``, so no control string (``<s>``, ``</s>``, ``[INST]`` ...) can arise from a text; a line break in a role
becomes ``&#10;``. The loss mask is a list of character spans that cover the assistant texts alone.

Null roles and texts count as empty, null scores as zero; a null conversation id is a conversation of its own. A
message whose parent is missing starts a path; messages on a cycle reach no root and take no part. Ties between
leaves go to the smaller id. Repeated turns stand side by side, ordered by role and text. One conversation is one
output row, so its texts meet in one task; nothing else does.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headwater.llm.common import durable

OPEN, SEP, CLOSE = "<s>", "\n", "</s>"
LOSS_ROLE = "assistant"
#: Escapes, in the order in which they are applied.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))


def escape(c: Column) -> Column:
    for raw, coded in ESCAPES:
        c = F.replace(c, F.lit(raw), F.lit(coded))
    return c


def unescape(c: Column) -> Column:
    for raw, coded in reversed(ESCAPES):
        c = F.replace(c, F.lit(coded), F.lit(raw))
    return c


def link_turns(conversations: DataFrame, span: int = 256) -> DataFrame:
    """(tree, id, parent, role, text, score, conv_id): each turn answers the one before it.

    Turns are numbered within spans of ``span`` turn values and offset by the sizes of the spans before, so a long
    conversation is not sorted in one task.
    """
    c = conversations.select(
        F.coalesce(F.concat(F.lit("v"), F.col("conv_id").cast("string")), F.lit("null")).alias("tree"),
        "conv_id",
        "turn",
        F.coalesce(F.col("turn").cast("long"), F.lit(-(2**62))).alias("at"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("part", F.floor(F.col("at") / span))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = c.groupBy("tree", "part").agg(F.count("*").alias("n")).select("tree", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    local = F.row_number().over(Window.partitionBy("tree", "part").orderBy("at", "role", "text"))
    numbered = c.withColumn("local", local).join(offsets, ["tree", "part"]).withColumn("id", F.col("offset") + F.col("local"))
    return numbered.select("tree", "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"), "conv_id")


def best_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, leaf, rank, id, pos): the messages of each tree's best root-to-leaf paths, ``pos`` from 1 at the root."""
    ids = messages.select("tree", "id", "parent", F.coalesce("score", F.lit(0.0)).alias("gain"))
    known = ids.select("tree", F.col("id").alias("parent"), F.lit(True).alias("there")).distinct()
    state = durable(
        ids.join(known, ["tree", "parent"], "left").select("tree", "id", F.when(F.col("there"), F.col("parent")).alias("jump"), "gain", F.lit(1).cast("long").alias("depth"))
    )
    levels = []
    for _ in range(2 + math.ceil(math.log2(max(2, state.count())))):
        if state.where(F.col("jump").isNotNull()).isEmpty():
            break
        levels.append(state.select("tree", "id", "jump"))
        up = state.select("tree", F.col("id").alias("jump"), F.col("jump").alias("next"), F.col("gain").alias("more"), F.col("depth").alias("deeper"))
        # only messages that have not reached their root look further
        moved = state.where(F.col("jump").isNotNull()).join(up, ["tree", "jump"]).select(
            "tree", "id", F.col("next").alias("jump"), (F.col("gain") + F.col("more")).alias("gain"), (F.col("depth") + F.col("deeper")).alias("depth")
        )
        state = durable(state.where(F.col("jump").isNull()).unionByName(moved))
    answered = ids.select("tree", F.col("parent").alias("id")).where(F.col("id").isNotNull()).distinct()
    order = Window.partitionBy("tree").orderBy(F.desc("gain"), "id")
    leaves = state.where(F.col("jump").isNull()).join(answered, ["tree", "id"], "left_anti").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= branches)
    path = durable(leaves.select("tree", F.col("id").alias("leaf"), "rank", "id", F.col("depth").alias("pos")))
    for k in reversed(range(len(levels))):
        above = path.join(levels[k], ["tree", "id"]).where(F.col("jump").isNotNull())
        path = durable(path.unionByName(above.select("tree", "leaf", "rank", F.col("jump").alias("id"), (F.col("pos") - 2**k).alias("pos"))))
    return path


def format_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, rank, formatted, loss_spans): one row per chosen path; spans are [start, end) characters of loss."""
    path = best_paths(messages, branches)
    turns = path.join(messages.select("tree", "id", "role", "text"), ["tree", "id"]).select(
        "tree",
        "rank",
        "pos",
        (F.col("role") == LOSS_ROLE).alias("loss"),
        F.concat(F.lit(OPEN), F.replace(escape(F.coalesce("role", F.lit(""))), F.lit("\n"), F.lit("&#10;")), F.lit(SEP)).alias("head"),
        escape(F.coalesce("text", F.lit(""))).alias("body"),
    )
    before = Window.partitionBy("tree", "rank").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("head") + F.length("body")
    turns = turns.withColumn("at", F.coalesce(F.sum((size + len(CLOSE)).cast("long")).over(before), F.lit(0).cast("long")) + F.length("head"))
    span = F.when(F.col("loss"), F.struct(F.col("at").alias("start"), (F.col("at") + F.length("body")).alias("end")))
    rows = turns.groupBy("tree", "rank").agg(
        F.array_sort(F.collect_list(F.struct("pos", F.concat("head", "body", F.lit(CLOSE)).alias("turn")))).alias("t"), F.array_sort(F.collect_list(span)).alias("loss_spans")
    )
    return rows.select("tree", "rank", F.array_join(F.transform("t", lambda t: t["turn"]), "").alias("formatted"), "loss_spans")


def read_back(formatted: DataFrame) -> DataFrame:
    """Append ``turns`` (role, text) and ``loss_text``, parsed from the formatted string and its mask."""
    part = F.split("formatted", CLOSE, -1)
    whole = F.slice(part, 1, F.size(part) - 1)
    body = F.transform(whole, lambda p: F.substring(p, len(OPEN) + 1, 2**31 - 1))
    turns = F.transform(
        body,
        lambda b: F.struct(
            unescape(F.replace(F.substring_index(b, SEP, 1), F.lit("&#10;"), F.lit("\n"))).alias("role"),
            unescape(b.substr(F.length(F.substring_index(b, SEP, 1)) + 2, F.lit(2**31 - 1))).alias("text"),
        ),
    )
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(F.col("formatted").substr((s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
    return formatted.withColumn("turns", turns).withColumn("loss_text", loss)


def chat_report(conversations: DataFrame) -> DataFrame:
    """One row per conversation: digests read back from the formatted output."""
    messages = durable(link_turns(conversations))  # read for links, texts and ids: numbered once
    ids = messages.select("tree", "conv_id").distinct()
    out = read_back(format_paths(messages)).join(ids, "tree")
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


CHAT_SQL = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')) + 4 * (length(role) - length(replace(role, chr(10), '')))
    + length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')) + 8 AS n FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(n) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
