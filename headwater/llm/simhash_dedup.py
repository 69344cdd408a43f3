"""SimHash near-duplicates through an inverted index of byte positions with count filtering.

A 64-bit fingerprint is eight positional bytes. Two fingerprints that differ in at most three bits share at least
five of them, so a pair's tally of shared positional bytes has a guaranteed minimum of 8 - 3. Any five positions
hold three positions of one half (four bytes) of the fingerprint, so the index is keyed by the eight byte triples
that lie within a half: each pair that can reach the minimum meets under at least one key, and a posting list is a
2^-24 part of the fingerprints and not a 2^-8 part. Pairs that meet are tallied over all eight positions, those that reach the
minimum are verified by their Hamming distance.

Equal fingerprints are one posting. Short lists are compared pair by pair. Long ones (many near copies) are cut into
blocks; each pair of blocks is searched breadth-first, nodes leaving the unvisited set as soon as they are reached, and
gives a spanning forest and not all its pairs. The components are the same.

Shingles of ``width`` words keep repeats; a shorter text is one shingle; a text without words, a null or an empty
one has fingerprint zero and links like any other. Repeated ids and rows are allowed; null ids take part and their
class is named by the least id that is not null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headwater.llm.common import col, durable, map_text, release, spare
from headwater.llm.components import connected_components
from headwater.llm.words import Sequences, hashed_words, mix

RADIUS = 3
#: Byte triples within the lower and the upper half.
TRIPLES = tuple((h + a, h + b, h + c) for h in (0, 4) for a, b, c in ((0, 1, 2), (0, 1, 3), (0, 2, 3), (1, 2, 3)))
SHORT_LIST, BLOCK = 32, 4096


def fingerprint(text: str, width: int = 3) -> int:
    """The majority bits of the XXH64 (seed 42) of all word shingles, as a signed 64-bit integer."""
    from xxhash import xxh64_intdigest

    # bytes.lower() changes A-Z alone; bytes.split() cuts at the six white-space characters
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    shingles = map(b" ".join, zip(*[words[i:] for i in range(width)])) if len(words) > width else [b" ".join(words)]
    h = np.fromiter((xxh64_intdigest(s, 42) for s in shingles), np.uint64, n)
    ones = np.unpackbits(h.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(df: DataFrame, text_col: str = "text", keep: list[str] | None = None, width: int = 3, out: str = "fp") -> DataFrame:
    return map_text(df, text_col, df.columns if keep is None else keep, [T.StructField(out, T.LongType())], lambda texts: [[fingerprint(t, width) for t in texts]])


def _forest(x: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links within x."""
    bits, open_ = x.view(np.uint64), np.arange(len(x))  # of signed integers NumPy counts the bits of the absolute value
    out = []
    while len(open_):
        frontier, open_ = [open_[0]], open_[1:]
        while frontier and len(open_):
            at = frontier.pop()
            near = np.bitwise_count(bits[open_] ^ bits[at]) <= RADIUS
            reached = open_[near]
            open_ = open_[~near]
            out += [(int(x[at]), int(x[r])) for r in reached]
            frontier += reached.tolist()
    return out


def links(fps: DataFrame) -> DataFrame:
    """(u, v) links between distinct fingerprints ``fp``: those of short lists all, of long lists a spanning forest."""
    byte = [F.shiftright("fp", 8 * i).bitwiseAND(F.lit(255)) for i in range(8)]
    keys = [F.lit(k << 24) + byte[a] * 65536 + byte[b] * 256 + byte[c] for k, (a, b, c) in enumerate(TRIPLES)]
    index = fps.select("fp", F.explode(F.array(*keys)).alias("key"))
    sizes = index.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    posts = durable(index.join(sizes, "key"))
    lists = posts.where(F.col("n") <= SHORT_LIST).groupBy("key").agg(F.collect_list("fp").alias("l"))
    met = F.transform("l", lambda u, i: F.transform(F.slice("l", i + 2, SHORT_LIST), lambda v: F.struct(u.alias("u"), v.alias("v"))))
    pair = lists.select(F.explode(F.flatten(met)).alias("p")).select("p.u", "p.v")
    change = F.col("u").bitwiseXOR(F.col("v"))
    tally = sum((F.shiftright(change, 8 * i).bitwiseAND(F.lit(255)) == 0).cast("int") for i in range(8))
    short = pair.where((tally >= 8 - RADIUS) & (F.bit_count(change) <= RADIUS))

    blocks = F.ceil(F.col("n") / BLOCK)
    long = posts.where(F.col("n") > SHORT_LIST).withColumn("blocks", blocks.cast("int")).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    dealt = long.select(
        "key",
        "fp",
        "own",
        F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("own", o).alias("i"), F.greatest("own", o).alias("j")))).alias("p"),
    )

    def search(group: pa.Table) -> pa.Table:
        got = _forest(np.sort(group.column("fp").to_numpy()))
        return pa.table({"u": pa.array([g[0] for g in got], pa.int64()), "v": pa.array([g[1] for g in got], pa.int64())})

    return short.unionByName(dealt.select("key", "fp", "p.i", "p.j").groupBy("key", "i", "j").applyInArrow(search, "u long, v long"))


def classes(marked: DataFrame, id_col: str = "doc_id", fp_col: str = "fp", out: str = "component_id") -> DataFrame:
    """Append the class of each row: the smallest id that links of at most three differing bits reach."""
    reps = durable(marked.groupBy(col(fp_col).alias("fp")).agg(F.min(col(id_col)).alias("rep")))
    found = connected_components(links(reps.select("fp")))
    named = reps.join(found, reps.fp == found.node, "left").select("fp", "rep", F.coalesce("component", "fp").alias("component"))
    least = named.groupBy("component").agg(F.min("rep").alias("least"))
    key, given = spare(marked, "fp", "least")
    name = durable(named.join(least, "component").select(F.col("fp").alias(key), F.col("least").alias(given)))
    release(marked.sparkSession)
    held = [c for c in marked.columns if c.lower() != out.lower()]
    return marked.join(name, col(fp_col) == F.col(key)).select(*map(col, held), F.col(given).alias(out))


def simhash_report(docs: DataFrame) -> DataFrame:
    """One row per document: fingerprint and class."""
    marked = durable(fingerprints(docs.select("doc_id", "text"), keep=["doc_id"]))
    return classes(marked).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: A signature has POSITIONS bytes, each a byte of one minimum over all shingles; the index is keyed by runs of KEY_BYTES.
POSITIONS, KEY_BYTES = 120, 5
#: Equal bytes that a pair of the sought similarity reaches: its share of them, less five standard deviations.
SPREAD = 5
#: Shingles of one block of a family, and the members that a broadcast may list.
BLOCK_SHINGLES, BROADCAST_MEMBERS = 500_000, 200_000


def _shingles(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all shingles, offsets by text); a shorter text is one shingle, also one without words."""
    words, at = hashed_words(texts, lower=True)
    count = np.diff(at)
    held = np.maximum(1, count - width + 1)
    offsets = np.concatenate([[0], np.cumsum(held)])
    start = np.repeat(at[:-1] - offsets[:-1], held) + np.arange(offsets[-1])
    return Sequences(words).at(np.minimum(start, len(words)), np.repeat(np.minimum(count, width), held)), offsets


def signatures(texts: list[str], width: int = 5) -> tuple[list[bytes], list[int], list[bytes]]:
    """For every text the name of its shingle set (128 bits), the size of the set and its positional bytes."""
    from xxhash import xxh3_128_digest

    h, offsets = _shingles(pa.array(texts, pa.string()), width)
    sets = [np.unique(h[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
    draws = np.random.default_rng(11).integers(0, 1 << 63, (2, POSITIONS), dtype=np.uint64)
    out = np.empty((len(texts), POSITIONS), np.uint8)
    for k, (a, b) in enumerate(draws.T):
        out[:, k] = mix(np.minimum.reduceat(h * (a * np.uint64(2) + np.uint64(1)) + b, offsets[:-1])).astype(np.uint8) if len(texts) else 0
    return [xxh3_128_digest(x.tobytes()) for x in sets], [len(x) for x in sets], [x.tobytes() for x in out]


def _candidates(reps: DataFrame, similarity: float) -> DataFrame:
    """(u, v) pairs of sets that share a run of positional bytes, short lists filtered by the tally of all positions.

    A long list is joined to its least member without a tally: that keeps its members together and loses no pair.
    """
    runs = [F.xxhash64(F.lit(k), F.substring("sig", 1 + k * KEY_BYTES, KEY_BYTES)) for k in range(POSITIONS // KEY_BYTES)]
    index = reps.select("node", F.explode(F.array(*runs)).alias("key")).repartition("key")
    sizes = index.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("least")).where(F.col("n") > 1)
    posts = durable(index.join(sizes, "key"))
    lists = posts.where(F.col("n") <= SHORT_LIST).groupBy("key").agg(F.collect_list("node").alias("l"))
    met = F.transform("l", lambda u, i: F.transform(F.slice("l", i + 2, SHORT_LIST), lambda v: F.struct(F.least(u, v).alias("u"), F.greatest(u, v).alias("v"))))
    pair = lists.select(F.explode(F.flatten(met)).alias("p")).select("p.u", "p.v").distinct()
    side = lambda c: reps.select(F.col("node").alias(c), F.col("sig").alias(f"{c}_sig"), F.col("size").alias(f"{c}_size"))
    both = pair.join(side("u"), "u").join(side("v"), "v")
    least = POSITIONS * similarity - SPREAD * (POSITIONS * similarity * (1 - similarity)) ** 0.5
    tally = F.aggregate(F.sequence(F.lit(1), F.lit(POSITIONS)), F.lit(0), lambda n, k: n + (F.col("u_sig").substr(k, F.lit(1)) == F.col("v_sig").substr(k, F.lit(1))).cast("int"))
    fits = F.least("u_size", "v_size") >= similarity * F.greatest("u_size", "v_size")
    short = both.where(fits & (tally >= least)).select("u", "v")
    return short.unionByName(posts.where((F.col("n") > SHORT_LIST) & (F.col("node") != F.col("least"))).select(F.col("least").alias("u"), F.col("node").alias("v")).distinct())


def _verified(nodes: np.ndarray, texts: pa.Array, width: int, similarity: float) -> list[tuple[bytes, bytes]]:
    """A spanning forest of the pairs whose shingle sets have the Jaccard similarity, compared exactly."""
    h, offsets = _shingles(texts, width)
    codes = np.unique(h, return_inverse=True)[1]
    sets = [np.unique(codes[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
    size = np.array([len(x) for x in sets])
    flat, starts = np.concatenate(sets), np.concatenate([[0], np.cumsum(size)])[:-1]
    mark = np.zeros(len(h), np.int32)
    open_, out = np.ones(len(sets), bool), []
    for root in range(len(sets)):
        frontier = [root] if open_[root] else []
        open_[root] = False
        while frontier and open_.any():
            at = frontier.pop()
            mark[sets[at]] = 1
            shared = np.add.reduceat(mark[flat], starts)
            mark[sets[at]] = 0
            near = np.flatnonzero(open_ & (shared >= similarity * (size + size[at] - shared) - 1e-9))
            open_[near] = False
            out += [(nodes[at], nodes[k]) for k in near]
            frontier += near.tolist()
    return out


def keep_one(docs: DataFrame, width: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each class of texts whose sets of ``width``-word shingles have the Jaccard similarity.

    A 64-bit fingerprint cannot hold that similarity (a median of 10 bits differs at 0.8), so the positional bytes are
    those of minima over the shingles. Equal sets are one posting; pairs that share a run of bytes and reach the
    tally make families; within a family whole texts are compared exactly, block by block. The row of the smallest id
    stays, of a class without ids one row; repeated rows and texts without words are alike. An id that stands on
    different texts, null included, names no text alone: its rows are told apart by their sets.
    """
    name = lambda c: F.coalesce(F.concat(F.lit("="), col(c).cast("string")), F.lit(""))
    key = name(id_col)
    key_, node_ = spare(docs, "key", "node")
    fields = [T.StructField("node", T.BinaryType()), T.StructField("size", T.LongType()), T.StructField("sig", T.BinaryType())]
    plain = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    known = durable(map_text(plain, "text", ["id"], fields, lambda texts: list(signatures(texts, width))))
    marked = durable(known.groupBy("node", "size", "sig").agg(F.min("id").alias("id")))
    doubtful = durable(known.groupBy(name("id").alias(key_)).agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b").select(key_))
    family = connected_components(_candidates(marked, similarity))
    members = durable(family.join(marked.select("node", "size", "id"), "node").select("node", F.col("component").alias("family"), "size", name("id").alias("key")))
    release(docs.sparkSession)
    blocks = members.groupBy("family").agg(F.ceil(F.sum("size") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    dealt = members.join(blocks, "family").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("own", o).alias("i"), F.greatest("own", o).alias("j")))
    few = members.count() <= BROADCAST_MEMBERS
    bounded = F.broadcast if few else lambda df: df
    texts = docs.select(key.alias("key"), col(text_col).alias("text")).join(bounded(members.select("key").distinct()), "key", "left_semi")
    named = map_text(texts, "text", ["text"], [T.StructField("node", T.BinaryType())], lambda t: [signatures(t, width)[0]])
    held = named.join(bounded(dealt.select("node", "family", F.array_distinct(pairs).alias("pairs"))), "node").select("node", "text", "family", F.explode("pairs").alias("p"))

    def search(group: pa.Table) -> pa.Table:
        nodes, text = group.column("node").to_pylist(), group.column("text").combine_chunks()
        first = np.unique(np.array([n.hex() for n in nodes]), return_index=True)[1]  # one text of each set
        got = _verified([nodes[k] for k in first], text.take(pa.array(first)), width, similarity)
        return pa.table({"u": pa.array([g[0] for g in got], pa.binary()), "v": pa.array([g[1] for g in got], pa.binary())})

    links = held.select("node", F.coalesce("text", F.lit("")).alias("text"), "family", "p.i", "p.j").groupBy("family", "i", "j").applyInArrow(search, "u binary, v binary")
    found = connected_components(links)
    release(docs.sparkSession)
    classed = marked.join(found, "node", "left").select("node", "id", F.coalesce("component", "node").alias("component"))
    least = classed.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "node")).alias("c")).select("c.*")
    chosen = durable(least.select(name("id").alias(key_), F.col("node").alias(node_)))
    # one exchange of the texts: the join and the choice among repeated rows share its key
    held, columns = docs.withColumn(key_, key), [col(c) for c in docs.columns]
    kept = held.join(chosen.select(key_).join(doubtful, key_, "left_anti"), key_, "left_semi").dropDuplicates([key_]).select(*columns)
    n_doubtful = doubtful.count()
    if not n_doubtful:
        return kept
    some = held.join(F.broadcast(doubtful) if n_doubtful <= BROADCAST_MEMBERS else doubtful, key_, "left_semi")
    told = map_text(some, text_col, some.columns, [T.StructField(node_, T.BinaryType())], lambda t: [signatures(t, width)[0]])
    return kept.unionByName(told.join(chosen, [key_, node_], "left_semi").dropDuplicates([key_, node_]).select(*columns))
