"""Merkle manifest of a dataset: one tree of rows per group, one tree over the groups, and each row's proof.

Rows of a group ascend by an order column; every ``fanout`` consecutive nodes have the digest of their digests as
parent (the last run may be shorter, even one) until one node, the group's subroot, is left. The subroots, ordered by
group (null first, then by bytes), make the upper tree in the same way; its last node is the root.

* Numbers: rows are ranged by group and order into partitions and numbered there; one row for each group and partition
  says how many stand before. No group meets in one task, however large.
* Up: level by level, numbers divided by the fanout name the parents, whose children are collected in order. A level
  has a ``fanout``-th of the rows of the one below, and is durable. The lowest level carries what a row needs later.
* Down: level by level, a parent's proof is joined to its children, who add their siblings. So only the parents' proofs
  move, and every row has its whole proof after as many joins as there are levels, the last over a third of the rows.

Digests travel as 32 bytes and are hashed as lowercase hexadecimal text. A proof is an array from the lowest level up:
the digests left and right of the own place. A level without siblings has two empty values: it is a hash all the same.

Rows of equal order take that of their digests; rows equal in both are interchangeable. Null order values stand first.
A null field is ``-``, so it differs from an empty one. Texts of any length are hashed where they are read and do not
move. An empty table gives no rows. Fields are found by exact names; other columns are ignored unless kept, and kept
columns travel in a struct of their own, so that no name clashes with those of the result as long as ``keep`` avoids
``leaf``, ``subroot``, ``root`` and ``proof``, which is checked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headwater.llm.common import BROADCAST_BYTES, col, durable

FANOUT = 3
RESULT = ("leaf", "subroot", "root", "proof")


def digest(text: Column) -> Column:
    """SHA-256 as 32 bytes."""
    return F.unhex(F.sha2(text, 256))


def hexed(value: Column) -> Column:
    return F.lower(F.hex(value))


def encoded(*values: Column) -> Column:
    """Each value as UTF-8 byte count, ``:`` and value, or ``-`` if null, one after the other."""
    one = lambda v: F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
    return F.concat(*[one(v.cast("string")) for v in values])


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(proof, leaf, lambda d, s: digest(F.concat(hexed(s["left"]), hexed(d), hexed(s["right"]))))


def siblings(proof: Column) -> Column:
    """All digests of a proof as text, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(hexed(s["left"]), hexed(s["right"]))), "")


def _numbered(df: DataFrame, *order: str) -> DataFrame:
    """Add ``nth`` within ``tree`` (from 0) and ``m``, the rows of the tree."""
    keys = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    # equal rows may part: their order does not matter
    ranged = df.repartitionByRange(*keys, F.monotonically_increasing_id()).sortWithinPartitions(*keys)
    ranged = durable(ranged.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()))
    # one row for each tree and partition: the trees and the partitions bound its size, whatever the rows
    pieces = ranged.groupBy("tree", "part").agg(F.min("at").alias("least"), F.count("*").alias("n"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = durable(
        pieces.select("tree", "part", (F.col("least") - F.coalesce(F.sum("n").over(before), F.lit(0))).alias("shift"), F.sum("n").over(Window.partitionBy("tree")).alias("m"))
    )
    size = pieces.agg(F.sum(F.octet_length("tree") + 48)).first()[0] or 0
    return ranged.join(F.broadcast(pieces) if size <= BROADCAST_BYTES else pieces, ["tree", "part"]).withColumn("nth", F.col("at") - F.col("shift")).drop("part", "at", "shift")


def _levels(nodes: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """(levels of parents, (tree, digest) of the roots). ``nodes`` have tree, nth, m, digest and payload."""
    most, levels, tops = nodes.agg(F.max("m")).first()[0] or 0, [], []
    while True:
        tops.append(nodes.where("m = 1").select("tree", "digest"))
        if most <= 1:
            break
        child = F.struct("nth", "digest", *(["payload"] if "payload" in nodes.columns else []))
        kids = nodes.where("m > 1").groupBy("tree", F.floor(F.col("nth") / fanout).alias("nth"), F.ceil(F.col("m") / fanout).alias("m")).agg(F.sort_array(F.collect_list(child)).alias("kids"))
        made = kids.withColumn("digest", digest(F.array_join(F.transform("kids", lambda k: hexed(k["digest"])), "")))
        levels.append(durable(made))
        nodes, most = levels[-1].select("tree", "nth", "m", "digest"), -(-most // fanout)
    roots = tops[0]
    for t in tops[1:]:
        roots = roots.unionByName(t)
    return levels, durable(roots)


def _proofs(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The lowest level's nodes (tree, nth, subroot, proof and the payload, if any), from the proofs and subroots of the trees' last nodes.

    ``tops(tree, subroot, proof)``; trees of one node have no level and are not listed.
    """
    none = F.lit(b"")
    known = None
    for level in reversed(levels):
        last = level.where("m = 1").join(tops, "tree").select("tree", "nth", "kids", "subroot", "proof")
        inner = level.where("m > 1").join(known, ["tree", "nth"]).select("tree", "nth", "kids", "subroot", "proof") if known is not None else None
        both = last if inner is None else last.unionByName(inner)
        kids = both.select("tree", "subroot", "proof", "kids", F.explode("kids").alias("kid"))
        side = lambda keep: F.aggregate(F.filter("kids", keep), none, lambda a, k: F.concat(a, k["digest"]))
        step = F.struct(side(lambda k: k["nth"] < F.col("kid.nth")).alias("left"), side(lambda k: k["nth"] > F.col("kid.nth")).alias("right"))
        held = [F.col("kid.payload").alias("payload"), F.col("kid.digest").alias("digest")] if level is levels[0] else []
        known = kids.select("tree", F.col("kid.nth").alias("nth"), "subroot", F.concat(F.array(step), "proof").alias("proof"), *held)
    return known


def merkle_manifest(df: DataFrame, fields: list[str], tree_col: str, order_col: str, keep: list[str] | dict[str, Column] | None = None, fanout: int = FANOUT) -> DataFrame:
    """The kept columns with ``leaf``, ``subroot``, ``root`` (32 bytes each) and ``proof`` (array of left and right) of every row.

    ``keep`` names columns, or gives names and expressions over ``df``.
    """
    keep = {c: col(c) for c in keep or []} if not isinstance(keep, dict) else keep
    if {k.lower() for k in keep} & set(RESULT):
        raise ValueError(f"kept columns may not be named {', '.join(RESULT)}")
    payload = [F.struct(*[c.alias(f"c{i}") for i, c in enumerate(keep.values())]).alias("payload")] if keep else [F.struct(F.lit(0).alias("c")).alias("payload")]
    # null stands before all values, an empty one included
    tree = F.when(col(tree_col).isNull(), "").otherwise(F.concat(F.lit("s"), col(tree_col).cast("string")))
    rows = _numbered(df.select(tree.alias("tree"), col(order_col).alias("key"), digest(encoded(*map(col, fields))).alias("digest"), *payload), "key", "digest").drop("key")
    levels, subroots = _levels(rows, fanout)
    upper = _numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), "name")
    upper = upper.withColumn("payload", F.struct("name"))
    above, roots = _levels(upper, fanout)
    root = roots.first()
    root = F.lit(bytes(root.digest) if root else b"")
    start = F.array().cast("array<struct<left:binary,right:binary>>")
    # proofs of the subroots within the upper tree, then of the rows within theirs
    top = roots.select("tree", F.lit(b"").alias("subroot"), start.alias("proof"))
    lone = upper.where("m = 1").select(F.col("payload.name").alias("tree"), F.col("digest").alias("subroot"), start.alias("proof"))
    tops = durable(lone.unionByName(_proofs(above, top).select(F.col("payload.name").alias("tree"), F.col("digest").alias("subroot"), "proof")) if above else lone)
    single = rows.where("m = 1").join(tops, "tree").select("payload", "digest", "subroot", "proof")
    out = single.unionByName(_proofs(levels, tops).select("payload", "digest", "subroot", "proof")) if levels else single
    return out.select(*[F.col(f"payload.c{i}").alias(k) for i, k in enumerate(keep)], F.col("digest").alias("leaf"), "subroot", root.alias("root"), "proof")


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def merkle_report(docs: DataFrame) -> DataFrame:
    """Digests of every document with the outcome of a check of rows of which some have lost their line feeds."""
    changed = [F.replace(col(c), F.lit("\n"), F.lit("")) if c == "text" else col(c) for c in FIELDS]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, digest(encoded(*changed)))
    out = merkle_manifest(docs, FIELDS, "source", "doc_id", {"doc_id": F.col("doc_id"), "tampered": tampered})
    out = out.withColumn("folded", fold(F.coalesce("tampered", "leaf"), F.col("proof")))
    digests = [hexed(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")]
    return out.select("doc_id", *digests, F.sha2(siblings(F.col("proof")), 256).alias("proof_sha256"), hexed(F.col("folded")).alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


MERKLE_SQL = """
WITH RECURSIVE crc AS (SELECT doc_id, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda s, b: list_reduce(list_prepend(xor(s, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))) AS s FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
f AS (SELECT d.doc_id, coalesce('s' || d.source, '') AS tree, d.text, coalesce(octet_length(encode(CAST(d.doc_id AS VARCHAR))) || ':' || d.doc_id, '-') || coalesce(octet_length(encode(d.source)) || ':' || d.source, '-')
    || coalesce(octet_length(encode(d.lang)) || ':' || d.lang, '-') || coalesce(octet_length(encode(CAST(d.n_chars AS VARCHAR))) || ':' || d.n_chars, '-') AS head,
    coalesce(xor(c.s, 4294967295) % 2 = 0, false) AS hurt FROM documents d LEFT JOIN crc c ON c.doc_id = d.doc_id),
l AS (SELECT *, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf, sha256(head || coalesce(octet_length(encode(replace(text, chr(10), ''))) || ':' || replace(text, chr(10), ''), '-')) AS worn FROM f),
base AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS nth, count(*) OVER (PARTITION BY tree) AS m FROM l),
low(tree, level, nth, m, digest) AS (SELECT tree, 0, nth, m, leaf FROM base UNION ALL
    (SELECT tree, level + 1, nth // 3, (m + 2) // 3, sha256(string_agg(digest, '' ORDER BY nth)) FROM low WHERE m > 1 GROUP BY tree, level, nth // 3, m)),
subs AS (SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS nth, count(*) OVER () AS m FROM low WHERE m = 1),
high(level, nth, m, digest) AS (SELECT 0, nth, m, digest FROM subs UNION ALL
    (SELECT level + 1, nth // 3, (m + 2) // 3, sha256(string_agg(digest, '' ORDER BY nth)) FROM high WHERE m > 1 GROUP BY level, nth // 3, m)),
steps AS (SELECT 0 AS part, a.tree, a.level, a.nth, coalesce(string_agg(b.digest, '' ORDER BY b.nth) FILTER (b.nth < a.nth), '') AS lft, coalesce(string_agg(b.digest, '' ORDER BY b.nth) FILTER (b.nth > a.nth), '') AS rgt
    FROM low a JOIN low b ON a.tree = b.tree AND a.level = b.level AND a.nth // 3 = b.nth // 3 WHERE a.m > 1 GROUP BY a.tree, a.level, a.nth
  UNION ALL SELECT 1, NULL, a.level, a.nth, coalesce(string_agg(b.digest, '' ORDER BY b.nth) FILTER (b.nth < a.nth), ''), coalesce(string_agg(b.digest, '' ORDER BY b.nth) FILTER (b.nth > a.nth), '')
    FROM high a JOIN high b ON a.level = b.level AND a.nth // 3 = b.nth // 3 WHERE a.m > 1 GROUP BY a.level, a.nth),
path(doc_id, tree, leaf, part, level, nth, sibs, cur) AS (SELECT doc_id, tree, leaf, 0, 0, nth, '', CASE WHEN hurt THEN worn ELSE leaf END FROM base
  UNION ALL SELECT p.doc_id, p.tree, p.leaf, CASE WHEN s.part IS NULL THEN 1 ELSE p.part END, CASE WHEN s.part IS NULL THEN 0 ELSE p.level + 1 END,
    CASE WHEN s.part IS NULL THEN u.nth ELSE p.nth // 3 END, p.sibs || coalesce(s.lft || s.rgt, ''), CASE WHEN s.part IS NULL THEN p.cur ELSE sha256(s.lft || p.cur || s.rgt) END
  FROM path p LEFT JOIN steps s ON s.part = p.part AND s.level = p.level AND s.nth = p.nth AND (p.part = 1 OR s.tree = p.tree) LEFT JOIN subs u ON u.tree = p.tree
  WHERE s.part IS NOT NULL OR p.part = 0),
ends AS (SELECT p.* FROM path p LEFT JOIN steps s ON s.part = 1 AND s.level = p.level AND s.nth = p.nth WHERE p.part = 1 AND s.part IS NULL)
SELECT e.doc_id, e.leaf, u.digest AS subroot, r.digest AS root, sha256(e.sibs) AS proof_sha256, e.cur AS folded_root, e.cur = r.digest AS verified
FROM ends e JOIN subs u ON u.tree = e.tree CROSS JOIN (SELECT digest FROM high WHERE m = 1) r
"""
