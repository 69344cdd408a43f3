"""Exact top-k inner-product search with cover trees over queries and data together.

A bounded sample of rows, the pivots, serves as the trees' common top level: queries and data alike belong to their
nearest pivot. Data ordered by pivot fall into blocks of bounded bytes, queries into groups; each block and each group
has a cover tree. The children of a node are found farthest first: centres that are farther from each other than the
level's reach, which is at most half the node's radius where ``FAN`` centres cover that, and what the ``FAN`` farthest
ones cover where not. Every point goes to its nearest centre, so every node with more than a leaf's points is split.

Queries and data meet node by node, one node of queries with all nodes of data that its parent has left. With the data taken relative to the pivots' mean m, q d = q m + q (d - m), and q m is
known for each query, so a pair of nodes is left out if c_q c_d + |c_q| R_d + |c_d| R_q + R_q R_d, which no q (d - m) of its
points exceeds, is below the worst k-th score less q m in the query node. The k-th scores start from the pivots alone
and rise as a block is searched; the balls of whole blocks are tested first, so a group is sent only where it is needed.

The balls of all blocks are a table too: they are dealt in chunks, and each group meets every chunk. A task holds one
chunk or one block and one group at a time: nothing that grows with the tables is collected or broadcast, and the data
are read once however many queries there are.

Components become floor(1024 x) as integers; products are integers and exact, of any size. A pair whose score does not
fit a long has no score and is left out, as is a vector that is null or holds a component that is null, not finite, or
1e150 or more when taken 1024 times (its length could not be told). Missing components of shorter vectors count as zero. Of equal vectors the k + 1 of the smallest ids can
matter and are kept. A candidate is a row of another id; ids are integers, others are refused with a TypeError. Ties go to
the smaller id. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headwater.llm.common import checked_broadcast, col, durable

SCALE = 1024
#: Below every score.
NONE = np.iinfo(np.int64).min
#: Points of a node of data and of queries that is not split, most children of a node, vectors placed or multiplied at a time.
LEAF, QUERY_LEAF, FAN, SLICE = 64, 1, 16, 2048
#: Queries that may be searched together where pruning helps little.
JOINT = 64
PIVOTS = 512
#: Bytes of the pivots, of a block of data, of a group of queries and of a row that carries a part of either.
SAMPLE_BYTES, BLOCK_BYTES, GROUP_BYTES = 4 << 20, 32 << 20, 1 << 19
#: Rows of a block at least, as far as there are partitions.
BLOCK_ROWS = 2048


def spread(x: np.ndarray, fan: int) -> tuple[list[int], np.ndarray]:
    """(centres, each point's nearest centre): farthest first from point 0 on, until half the radius covers all or there are ``fan``."""
    owner, centres = np.zeros(len(x), np.int64), [0]
    dist = np.linalg.norm(x - x[0], axis=1)
    reach = dist.max() / 2
    while dist.max() > reach and len(centres) < fan:
        far = int(dist.argmax())
        d = np.linalg.norm(x - x[far], axis=1)
        closer = d < dist
        owner[closer], dist = len(centres), np.minimum(d, dist)
        centres.append(far)
    return centres, owner


class CoverTree:
    """Nodes hold points ``order[lo:hi]``, a centre (the first of them) and a covering radius."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        self.x, self.order = x, np.arange(len(x))
        self.lo, self.hi, self.children = [], [], []
        centres, radii = [], []
        open_ = [(0, len(x), None)] if len(x) else []
        while open_:
            lo, hi, parent = open_.pop()
            me = len(self.lo)
            if parent is not None:
                self.children[parent].append(me)
            pts = x[self.order[lo:hi]]
            radius = float(np.linalg.norm(pts - pts[0], axis=1).max())
            centres.append(pts[0])
            radii.append(radius)
            self.lo.append(lo)
            self.hi.append(hi)
            self.children.append([])
            if hi - lo > leaf and radius > 0:
                heads, owner = spread(pts, FAN)
                rank = np.ones(hi - lo, np.int64)
                rank[heads] = 0  # a child's first point is its centre
                self.order[lo:hi] = self.order[lo:hi][np.lexsort((rank, owner))]
                ends = lo + np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(heads)))])
                open_ += [(a, b, me) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        self.centre, self.radius = np.array(centres).reshape(len(centres), x.shape[1]), np.array(radii)
        self.norm = np.linalg.norm(self.centre, axis=1)
        self.children = [np.array(c, np.int64) for c in self.children]
        self.inner, self.size = np.array([len(c) > 0 for c in self.children], bool), np.array(self.hi) - np.array(self.lo)

    def below(self, nodes: np.ndarray, split: np.ndarray) -> np.ndarray:
        """The nodes with those marked replaced by their children, if they have any."""
        split = split & self.inner[nodes]
        return np.concatenate([nodes[~split], *[self.children[b] for b in nodes[split].tolist()]])


def most_between(product, a, reach_a, b, reach_b):
    """What no product of two points of balls exceeds, given the centres' product and norms and the radii."""
    more = a * reach_b + b * reach_a + reach_a * reach_b
    return product + more + 1e-9 * (a * b + more) + 1


class Search:
    """A group of queries with its tree and the best scores so far; ``mean`` is what the data are relative to."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int, mean: np.ndarray, least: np.ndarray | None = None):
        self.k, self.mean = k, mean
        self.tree = CoverTree(x, QUERY_LEAF)
        order = self.tree.order
        self.x, self.qid, self.row = x[order], ids[order], order  # in tree order
        self.shift = self.x @ mean
        self.slack = 1 + 1e-9 * np.linalg.norm(self.x, axis=1) * float(np.linalg.norm(mean))
        self.scores = np.full((len(ids), k), NONE)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.held = np.zeros((len(ids), k), bool)
        #: known lower bounds of the k-th scores
        self.kth = np.full(len(ids), NONE) if least is None else least[order]
        #: pairs of nodes looked at and pairs of points multiplied
        self.pairs = self.multiplied = 0

    def bound_by(self, ids: np.ndarray, x: np.ndarray) -> None:
        """Lower bounds from the pivots."""
        if len(ids) > self.k:
            for lo in range(0, len(self.x), 256):
                s, fits = products(self.x[lo : lo + 256], x)
                s = np.where(fits & (self.qid[lo : lo + 256, None] != ids[None, :]), s, NONE)
                self.kth[lo : lo + 256] = np.partition(s, len(ids) - self.k, axis=1)[:, -self.k]

    def low(self, lo: int, hi: int) -> float:
        """What a product with data relative to the mean must reach to matter for some of these queries."""
        kth = self.kth[lo:hi].astype(float)
        return float((kth - 1e-9 * np.abs(kth) - self.shift[lo:hi] - self.slack[lo:hi]).min())

    def kept(self, a: int, d: CoverTree, nodes: np.ndarray, alone: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(the data's nodes that may hold a result of a query of the node ``a``, or of its centre alone, and their bounds)."""
        q = self.tree
        lo, hi, radius = q.lo[a], q.lo[a] + 1 if alone else q.hi[a], 0.0 if alone else q.radius[a]
        tops = most_between(d.centre[nodes] @ q.centre[a], q.norm[a], radius, d.norm[nodes], d.radius[nodes])
        self.pairs += len(nodes)
        near = ~(tops < self.low(lo, hi))
        return nodes[near], tops[near]

    def leaves(self, a: int, d: CoverTree, nodes: np.ndarray, alone: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """As ``kept``, down to the data's leaves."""
        nodes, tops = self.kept(a, d, nodes, alone)
        while (inner := d.inner[nodes]).any():
            more, more_tops = self.kept(a, d, d.below(nodes[inner], np.ones(int(inner.sum()), bool)), alone)
            nodes, tops = np.concatenate([nodes[~inner], more]), np.concatenate([tops[~inner], more_tops])
        return nodes, tops

    def run(self, d: CoverTree, x: np.ndarray, ids: np.ndarray) -> None:
        """Search a block; ``x`` and ``ids`` are in the order of its tree, ``x`` not relative to the mean.

        A node of queries meets the data's nodes that its parent has left, all at once. Of those, the ones of larger
        radius are split before its children meet them; a leaf of queries goes down to the data's leaves, best bounds
        first. A node of few queries is taken for a leaf if its centre alone would have to see all of the block, but for a hundredth.
        """
        if not len(self.qid) or not len(ids):
            return
        q, stack = self.tree, [(0, np.zeros(1, np.int64))]
        while stack:
            a, nodes = stack.pop()
            lo, hi = q.lo[a], q.hi[a]
            nodes, _ = self.kept(a, d, nodes)
            if len(q.children[a]) and (hi - lo > JOINT or d.size[self.leaves(a, d, nodes, alone=True)[0]].sum() <= 0.99 * len(x)):
                nodes = d.below(nodes, d.radius[nodes] > q.radius[a])
                stack += [(int(c), nodes) for c in q.children[a]]
                continue
            nodes, tops = self.leaves(a, d, nodes)
            order, size = np.argsort(-tops), 1
            nodes, tops = nodes[order], tops[order]
            while len(nodes):
                now, nodes, tops, size = nodes[:size], nodes[size:], tops[size:], 2 * size
                at = np.concatenate([np.arange(d.lo[b], d.hi[b]) for b in now.tolist()])
                for first in range(0, len(at), SLICE):
                    self._leaf(lo, hi, x[at[first : first + SLICE]], ids[at[first : first + SLICE]])
                near = tops >= self.low(lo, hi)
                nodes, tops = nodes[near], tops[near]

    def _leaf(self, lo: int, hi: int, x: np.ndarray, ids: np.ndarray) -> None:
        s, fits = products(self.x[lo:hi], x)
        self.multiplied += s.size
        hit = fits & (s >= self.kth[lo:hi, None]) & (self.qid[lo:hi, None] != ids[None, :])
        for r in np.flatnonzero(hit.any(axis=1)).tolist():
            mine = self.held[lo + r]
            score = np.concatenate([self.scores[lo + r][mine], s[r][hit[r]]])
            found = np.concatenate([self.found[lo + r][mine], ids[hit[r]]])
            best = np.lexsort((found, -1 - score))[: self.k]  # -1 - score turns every long around
            n = len(best)
            self.scores[lo + r, :n], self.found[lo + r, :n], self.held[lo + r, :n] = score[best], found[best], True
            if n == self.k:
                self.kth[lo + r] = max(self.kth[lo + r], self.scores[lo + r, -1])

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query's number in the group, candidate's id, score) of what is held."""
        return np.repeat(self.row, self.held.sum(1)), self.found[self.held], self.scores[self.held]


def products(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(exact integer inner products, whether they fit a long): through floats where every sum is below 2**53, through longs below 2**62, else through Python's integers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2**62:
        s = np.rint(a @ b.T).astype(np.int64) if most < 2**53 else a.astype(np.int64) @ b.astype(np.int64).T
        return s, np.ones(s.shape, bool)
    out, fits = np.zeros((len(a), len(b)), np.int64), np.zeros((len(a), len(b)), bool)
    norms, others = (np.abs(v).sum(axis=1) for v in (a, b))
    whole = [[[int(c) for c in row] for row in v] for v in (a, b)]
    for i, x in enumerate(whole[0]):
        for j, y in enumerate(whole[1]):
            if norms[i] and others[j]:
                s = sum(p * q for p, q in zip(x, y))
                if NONE <= s <= -1 - int(NONE):
                    out[i, j], fits[i, j] = s, True
            else:
                fits[i, j] = True
    return out, fits


def matrix(lists, width: int) -> np.ndarray:
    """Vectors of any lengths as rows of ``width`` floats that hold integers."""
    out = np.zeros((len(lists), width))
    for r, v in zip(out, lists, strict=True):
        r[: len(v)] = v
    return out


def as_integers(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): components as whole doubles, which hold floor(1024 x) of any double x."""
    kind = df.select(col(id_col)).schema[0].dataType
    if not isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise TypeError(f"ids must be integers, {id_col} is {kind.simpleString()}")
    x = F.transform(col(vector_col), lambda v: F.lit(float(SCALE)) * v.cast("double"))
    whole = F.transform(x, lambda v: F.when(F.abs(v) < 2.0**52, F.floor(v).cast("double")).otherwise(v) + F.lit(0.0))
    rows = df.select(col(id_col).cast("long").alias("id"), whole.alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    return rows.where(F.forall("v", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < 1e150)))


#: A part of a block (kind 0) or a group of queries (kind 1): ids and least scores as long, vectors as double, packed.
_PART = "block int, kind int, part long, ids binary, v binary, least binary"
_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]


def _batch(block: int, kind: int, part: int, *packed: np.ndarray) -> pa.RecordBatch:
    values = [block, kind, part, *[p.tobytes() for p in packed]]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _TYPES)], names=["block", "kind", "part", "ids", "v", "least"])


def top_k(df: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of ``df`` for each row of ``queries``."""
    spark = df.sparkSession
    ints = as_integers(df, id_col, vector_col)
    # equal vectors score alike, and a query leaves out all rows of its id: the k + 1 smallest ids are enough for any query
    one = Window.partitionBy("v", "id").orderBy("id")
    ints = ints.withColumn("copy", F.row_number().over(one)).where(F.col("copy") <= k).drop("copy")
    twin = F.dense_rank().over(Window.partitionBy("v").orderBy("id"))
    ints = durable(ints.withColumn("nth", twin).where(F.col("nth") <= k + 1).drop("nth"))
    asked = durable(as_integers(queries, id_col, vector_col).distinct())
    n, width = ints.agg(F.count("*"), F.max(F.size("v"))).first()
    width = max(1, width or 0, asked.agg(F.max(F.size("v"))).first()[0] or 0)
    row_bytes = 8 * width
    rows = max(1, GROUP_BYTES // row_bytes)
    spare = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, math.ceil(n * row_bytes / block_bytes), min(spare, n // BLOCK_ROWS))
    top = ints.orderBy(F.xxhash64("id", "v"), "id").limit(max(k + 1, min(PIVOTS, SAMPLE_BYTES // row_bytes))).collect()
    pivots, pivot_ids = matrix([r.v for r in top], width), np.array([r.id for r in top], np.int64)
    mean = np.rint(pivots.mean(axis=0)) if len(pivots) else np.zeros(width)
    shared = checked_broadcast(spark, (pivots, pivot_ids, mean), pivots.nbytes + pivot_ids.nbytes + mean.nbytes)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each vector, padded and packed, with its nearest pivot."""
        p = shared.value[0]
        half = (p * p).sum(1)[None, :] / 2
        for b in batches:
            for lo in range(0, b.num_rows, SLICE):
                part = b.slice(lo, SLICE)
                x = matrix(part.column(1).to_pylist(), width)
                near = (half - x @ p.T).argmin(1) if len(p) else np.zeros(len(x))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(near.astype(np.int32))], names=["id", "v", "pivot"])

    def unpacked(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        return b.column("id").to_numpy(), np.frombuffer(b"".join(b.column("v").to_pylist())).reshape(-1, width)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One partition is one block."""
        held = [unpacked(b) for b in batches if b.num_rows]
        if held:
            ids, x = (np.concatenate(c) for c in zip(*held))
            for lo in range(0, len(ids), rows):
                yield _batch(TaskContext.get().partitionId(), 0, lo, ids[lo : lo + rows].astype(np.int64), x[lo : lo + rows], np.zeros(0))

    placed = "id long, v binary, pivot int"
    data = durable(ints.mapInArrow(place, placed).repartitionByRange(blocks, "pivot", "id").mapInArrow(pack, _PART))

    def ball(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(block, centre and radius) of the parts of a partition, block by block."""
        seen: dict[int, list] = {}
        for b in batches:
            for block, v in zip(b.column("block").to_pylist(), b.column("v").to_pylist(), strict=True):
                x = np.frombuffer(v).reshape(-1, width)
                s = seen.setdefault(block, [x[0].copy(), 0.0])
                s[1] = max(s[1], float(np.linalg.norm(x - s[0], axis=1).max()))
        for block, (centre, radius) in seen.items():
            yield _batch(block, 0, block, np.zeros(0, np.int64), centre, np.array([radius]))

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups of queries with lower bounds of their k-th scores."""
        nth = TaskContext.get().partitionId() << 32
        pivots, pivot_ids, mean = shared.value
        for b in batches:
            ids, x = unpacked(b)
            for lo in range(0, len(ids), rows):
                s = Search(ids[lo : lo + rows], x[lo : lo + rows], k, mean)
                s.bound_by(pivot_ids, pivots)
                yield _batch(0, 1, nth, s.qid.astype(np.int64), s.x, s.kth)
                nth += 1

    balls = durable(data.select("block", "v").mapInArrow(ball, _PART))
    grouped = asked.mapInArrow(place, placed).repartitionByRange(spare, "pivot", "id").sortWithinPartitions("pivot", "id", "v")
    grouped = durable(grouped.mapInArrow(group, _PART))
    # chunks of balls, each in as many copies as keep the tasks busy; a group meets one copy of every chunk
    chunks = max(1, math.ceil(blocks * (row_bytes + 64) / block_bytes))
    copies, each = max(1, spare // chunks), math.ceil(blocks / chunks)
    here, there = F.sequence(F.lit(0), F.lit(copies - 1)), F.sequence(F.lit(0), F.lit(chunks - 1))
    dealt = balls.withColumn("chunk", F.floor(F.col("block") / each).cast("int")).withColumn("copy", F.explode(here))
    dealt = dealt.unionByName(grouped.withColumn("chunk", F.explode(there)).withColumn("copy", F.pmod(F.xxhash64("part"), F.lit(copies)).cast("int")))
    dealt = dealt.withColumn("at", F.col("chunk") * copies + F.col("copy"))

    def need(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The groups, once for each block that they need; the balls of a chunk come first."""
        current, held, known, mean = None, [], None, shared.value[2]
        for b in batches:
            for at, block, kind, part, ids, v, least in zip(*[b.column(i).to_pylist() for i in range(7)]):
                if at != current:
                    current, held, known = at, [], None
                if not kind:
                    held.append((block, np.frombuffer(v) - mean, np.frombuffer(least)[0]))
                    continue
                if not held:
                    continue
                if known is None:
                    known = np.array([h[0] for h in held]), np.array([h[1] for h in held]), np.array([h[2] for h in held])
                numbers, centre, radius = known
                ids, x, kth = np.frombuffer(ids, np.int64), np.frombuffer(v).reshape(-1, width), np.frombuffer(least, np.int64)
                s = Search(ids, x, k, mean, kth)
                c, r = s.tree.centre[0], s.tree.radius[0]
                tops = most_between(centre @ c, s.tree.norm[0], r, np.linalg.norm(centre, axis=1), radius)
                for block in sorted(set(numbers[tops >= s.low(0, len(ids))].tolist())):
                    yield _batch(block, 1, part, ids, x, kth)

    dealt = dealt.repartitionById(chunks * copies, "at").sortWithinPartitions("at", "kind", "part", "block")
    sent = dealt.select("at", "block", "kind", "part", "ids", "v", "least").mapInArrow(need, _PART)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The parts of a block come first, then the groups that are sent there."""
        current, held, tree, mean = None, [], None, shared.value[2]
        for b in batches:
            for block, kind, part, ids, v, least in zip(*[b.column(i).to_pylist() for i in range(6)]):
                if block != current:
                    current, held, tree = block, [], None
                ids, x = np.frombuffer(ids, np.int64), np.frombuffer(v).reshape(-1, width)
                if not kind:
                    held.append((ids, x))
                    continue
                if tree is None:
                    all_ids, all_x = (np.concatenate(c) for c in zip(*held))
                    tree = CoverTree(all_x - mean)
                    all_ids, all_x, held = all_ids[tree.order], all_x[tree.order], []
                s = Search(ids, x, k, mean, np.frombuffer(least, np.int64))
                s.run(tree, all_x, all_ids)
                q, got, score = s.rows()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(q), part)), pa.array(q.astype(np.int64)), pa.array(ids[q]), pa.array(got), pa.array(score)], names=["part", "q", "query_id", "vec_id", "score"]
                )

    met = data.unionByName(sent).repartitionById(blocks, "block").sortWithinPartitions("block", "kind", "part")
    out = met.mapInArrow(find, "part long, q long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("part", "q").orderBy(F.desc("score"), "vec_id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def topk_report(embeddings: DataFrame) -> DataFrame:
    return top_k(embeddings, embeddings.where(F.col("vec_id") % 100 == 0))


TOPK_SQL = """
WITH v AS (SELECT vec_id, CAST(list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.e, d.e) AS BIGINT) AS score FROM v q, v d WHERE q.vec_id % 100 = 0 AND d.vec_id <> q.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
