"""Sharding by extendible hashing.

A directory is indexed by prefix bits of a key's hash. Buckets start at depth zero; only a bucket above its byte
limit splits on one more bit. Sizes come from one aggregation per 15 bits, never from the rows again: the sizes of
all shallower prefixes are sums of the deepest ones, and a bucket's depth is the least depth at which its prefix
fits. Deeper rounds look only at prefixes that still do not fit.

Rows that share all 60 bits (repeated keys) cannot be split by bits; they go to overflow pages that keep the limit
through prefix sums of bytes, in parts that are numbered side by side. A single row above the limit has a page of
its own. Null keys hash as the empty string; null texts have zero bytes. Empty input gives no shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headwater.llm.common import col, durable

BITS, ROUND = 60, 15


def key_hash(key) -> F.Column:
    """The first 60 bits of the key's MD5."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def _directory(rows: DataFrame, shift: int, base: int, limit: int) -> DataFrame:
    """(entry, depth, shard_bytes): every prefix of ``base + ROUND`` bits with the bucket it falls in, null if none fits."""
    entries = rows.groupBy(F.shiftright("hash", shift).alias("entry")).agg(F.sum("n_bytes").alias("n_bytes"))
    levels = entries.select("entry", "n_bytes", F.explode(F.sequence(F.lit(base), F.lit(base + ROUND))).alias("depth"))
    levels = levels.withColumn("prefix", F.expr(f"shiftright(entry, {base + ROUND} - depth)"))
    sizes = levels.groupBy("depth", "prefix").agg(F.sum("n_bytes").alias("size")).where(F.col("size") <= limit)
    hit = F.min(F.when(F.col("size").isNotNull(), F.struct("depth", "size"))).alias("hit")
    fits = levels.select("entry", "depth", "prefix").join(sizes, ["depth", "prefix"], "left").groupBy("entry").agg(hit)
    return fits.select("entry", F.col("hit.depth").alias("depth"), F.col("hit.size").alias("shard_bytes"))


def _overflow(rows: DataFrame, limit: int) -> DataFrame:
    """Pages for rows of one hash: rows above half the limit alone, the others by prefix sums in steps of half the limit."""
    rows = durable(rows.withColumn("part", F.spark_partition_id()).withColumn("big", F.col("n_bytes") > limit // 2))
    w = Window.partitionBy("hash", "big", "part").orderBy("n_bytes")
    local = rows.withColumn("sum", F.sum("n_bytes").over(w.rowsBetween(Window.unboundedPreceding, -1))).withColumn("nth", F.row_number().over(w))
    totals = rows.groupBy("hash", "big", "part").agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n"))
    before = Window.partitionBy("hash", "big").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("hash", "big", "part", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("b0"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"))
    paged = local.join(totals, ["hash", "big", "part"]).withColumn(
        "page",
        F.when(F.col("big"), F.concat(F.lit("b"), F.col("n0") + F.col("nth"))).otherwise(
            F.concat(F.lit("p"), F.floor((F.col("b0") + F.coalesce("sum", F.lit(0))) / max(1, limit // 2)))
        ),
    )
    size = paged.groupBy("hash", "page").agg(F.sum("n_bytes").alias("shard_bytes"))
    return paged.drop("sum", "nth", "b0", "n0", "part", "big", "depth", "shard_bytes").join(size, ["hash", "page"]).withColumn("depth", F.lit(BITS))


def assign_shards(df: DataFrame, key_col: str = "doc_id", text_col: str = "text", limit: int = 256 << 20, keep: list[str] | None = None) -> DataFrame:
    """(key, n_bytes, shard, depth, shard_bytes, kept columns) for every row; ``shard`` is the bucket's bits, then the page if any.

    Columns are found by their exact names. Those that are kept travel with their row in one struct, so their names meet
    none of the operator's; they may not be named as a result is. Other columns stay behind: join them by key.
    """
    keep = keep or []
    if {k.lower() for k in keep} & {"key", "n_bytes", "shard", "depth", "shard_bytes"}:
        raise ValueError("kept columns may not be named as results are")
    held = [F.struct(*[col(c).alias(f"c{i}") for i, c in enumerate(keep)]).alias("held")] if keep else []
    rows = durable(df.select(col(key_col).alias("key"), F.coalesce(F.octet_length(col(text_col)), F.lit(0)).cast("long").alias("n_bytes"), key_hash(col(key_col)).alias("hash"), *held))
    names = ["key", "n_bytes", "hash", *(["held"] if keep else [])]
    done, rest = [], rows
    for base in range(0, BITS, ROUND):
        shift = BITS - base - ROUND
        found = durable(_directory(rest, shift, base, limit))
        # 2 ** ROUND entries at most in the first round; later ones hold only what still does not fit
        placed = rest.withColumn("entry", F.shiftright("hash", shift)).join(F.broadcast(found) if not base else found, "entry").drop("entry")
        done.append(placed.where(F.col("depth").isNotNull()).withColumn("page", F.lit(None).cast("string")))
        if found.where(F.col("depth").isNull()).isEmpty():
            break
        rest = durable(placed.where(F.col("depth").isNull()).select(*names))
    else:
        done.append(_overflow(rest, limit))
    cols = [*names, "depth", "shard_bytes", "page"]
    out = done[0].select(*cols)
    for d in done[1:]:
        out = out.unionByName(d.select(*cols))
    bits = F.when(F.col("depth") > 0, F.expr(f"lpad(bin(shiftright(hash, {BITS} - depth)), depth, '0')")).otherwise("")
    shard = F.concat(bits, F.coalesce(F.concat(F.lit("/"), F.col("page")), F.lit(""))).alias("shard")
    return out.select("key", "n_bytes", shard, F.col("depth").cast("int").alias("depth"), "shard_bytes", *[F.col(f"held.c{i}").alias(c) for i, c in enumerate(keep)])


def shard_report(docs: DataFrame, limit: int) -> DataFrame:
    return assign_shards(docs, limit=limit).withColumnRenamed("key", "doc_id")


def shard_sql(limit: int, depth: int = 30) -> str:
    """DuckDB: the least depth at which a key's prefix fits (data whose buckets all fit by ``depth`` bits)."""
    return f"""
WITH d AS (SELECT doc_id, CAST(coalesce(octet_length(encode(text)), 0) AS BIGINT) AS n_bytes, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents),
n AS (SELECT k AS depth, h >> (60 - k) AS prefix, CAST(sum(n_bytes) AS BIGINT) AS size FROM d, range(0, {depth + 1}) t(k) GROUP BY ALL),
l AS (SELECT d.doc_id, d.n_bytes, d.h, min(n.depth) AS depth FROM d, n WHERE n.prefix = d.h >> (60 - n.depth) AND n.size <= {limit} GROUP BY ALL)
SELECT l.doc_id, l.n_bytes, CASE WHEN l.depth = 0 THEN '' ELSE lpad(bin(l.h >> (60 - l.depth)), CAST(l.depth AS INTEGER), '0') END AS shard, CAST(l.depth AS INTEGER) AS depth, n.size AS shard_bytes
FROM l JOIN n ON n.depth = l.depth AND n.prefix = l.h >> (60 - l.depth)
"""
