"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

Texts become vectors of hashed byte trigrams, character-class trigrams and a length-by-variety cell. A truncated
SVD of a bounded labelled sample gives the latent space; the labelled vectors (at most ``2 * per_class``) are
broadcast, every document's cosines with all of them are computed in exact blocks, and the labels of the nearest
ones vote with a weight that grows with similarity.

Only text is an input of a score. Labels are learnt from rows whose crc32(doc_id as text) mod 3 is not 1. Null
texts count as empty. A text whose vector is null (the empty one), or a run whose labels are of one class, scores
the share of label 1 among the labels, 0.5 without labels. Null labels and repeated labels of one document are ignored after
the first by value. Ties at the k-th similarity all vote.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headwater.llm.common import checked_broadcast, map_text

TRIGRAMS = 2048
CLASSES = 11
CELLS = 16
WIDTH = TRIGRAMS + CLASSES**3 + CELLS * CELLS

_CLASS = np.full(256, 9, np.int64)  # other ASCII punctuation
_CLASS[128:] = 0  # part of a non-ASCII letter
_CLASS[97:123] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[32] = 4
_CLASS[[9, 10, 11, 12, 13]] = 5
_CLASS[[44, 46, 59, 58]] = 6
_CLASS[[33, 63]] = 7
_CLASS[[35, 36, 37, 38, 42, 64, 94]] = 8
_CLASS[[60, 62, 123, 124, 125, 91, 93]] = 10
_CODE = _CLASS.astype(np.int64)


def _unit(v: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(v)
    return v / n if n else v


def features(text: str) -> np.ndarray:
    """The raw vector of a whole text; all zero for the empty one."""
    v = np.zeros(WIDTH, np.float32)
    b = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    if not len(b):
        return v
    padded = np.concatenate([[32, 32], b, [32]]).astype(np.int64)
    h = (padded[:-2] * 40503 + padded[1:-1] * 10007 + padded[2:] * 257) & 0xFFFF
    counts = np.bincount(h, minlength=65536)
    variety = np.count_nonzero(counts)
    folded = counts.reshape(-1, TRIGRAMS).sum(0)
    v[:TRIGRAMS] = _unit(np.sqrt(folded))
    c = _CODE[padded]
    v[TRIGRAMS : TRIGRAMS + CLASSES**3] = 1.5 * _unit(np.sqrt(np.bincount((c[:-2] * CLASSES + c[1:-1]) * CLASSES + c[2:], minlength=CLASSES**3)))
    size = min(CELLS - 1, int(np.log2(len(b))))
    spread = min(CELLS - 1, int(4 * np.log2(max(1.0, len(b) / variety))))
    v[TRIGRAMS + CLASSES**3 + size * CELLS + spread] = 1.0
    return v


@dataclass
class Space:
    """A latent space with its labelled vectors."""

    mean: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int
    power: float
    prior: float  # share of label 1 among all labelled rows that may be learnt from

    @property
    def n_bytes(self) -> int:
        return sum(x.nbytes for x in (self.mean, self.axes, self.vectors, self.labels))

    def project(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) @ self.axes
        n = np.linalg.norm(z, axis=1, keepdims=True)
        z = np.divide(z, n, out=np.zeros_like(z), where=n > 0)
        z[~x.any(axis=1)] = 0
        return z

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.prior)
        share = float(self.labels.mean()) if len(self.labels) else 0.0
        if not 0 < share < 1:
            return out
        # the sample is balanced; votes are weighted back to the shares of the classes
        weight = np.where(self.labels == 1, self.prior / share, (1 - self.prior) / (1 - share))
        z = self.project(x)
        k = min(self.neighbours, len(self.labels))
        for lo in range(0, len(z), 256):
            sims = z[lo : lo + 256] @ self.vectors.T
            least = np.partition(sims, sims.shape[1] - k, axis=1)[:, -k, None]
            w = np.where(sims >= least, np.maximum(sims, 0), 0).astype(np.float64) ** self.power
            w *= weight
            total = w.sum(1)
            vote = w @ self.labels
            out[lo : lo + 256] = np.divide(vote, total, out=out[lo : lo + 256].copy(), where=total > 0)
        return np.clip(out, 0.0, 1.0)


def fit_space(x: np.ndarray, y: np.ndarray, prior: float = 0.5, rank: int = 48, neighbours: int = 9, power: float = 4.0) -> Space:
    """Truncated SVD (randomised range finder, fixed seed) of the sample's matrix."""
    if not len(x):
        empty = np.zeros((WIDTH, 1), np.float32)
        return Space(np.zeros(WIDTH, np.float32), empty, np.zeros((0, 1), np.float32), np.zeros(0), neighbours, power, prior)
    mean = x.mean(0)
    a = x - mean
    rank = min(rank, len(x))
    y0 = a @ np.random.default_rng(7).standard_normal((WIDTH, min(rank + 16, len(x))), dtype=np.float32)
    for _ in range(3):
        q, _ = np.linalg.qr(y0)
        y0 = a @ (a.T @ q)
    q, _ = np.linalg.qr(y0)
    axes = np.linalg.svd(q.T @ a, full_matrices=False)[2][:rank].T.astype(np.float32)
    space = Space(mean, axes, np.zeros((0, rank), np.float32), y.astype(np.float64), neighbours, power, prior)
    space.vectors = space.project(x)
    return space


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def usable_labels(labels: DataFrame) -> DataFrame:
    lab = labels.select("doc_id", "quality").where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return lab.groupBy("doc_id").agg(F.min("quality").alias("quality"))


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """At most ``per_class`` labelled rows of each class, picked by a hash of the id; never a held-out row."""
    lab = usable_labels(labels)
    picked = [lab.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for q in (0, 1)]
    chosen = picked[0].unionByName(picked[1])  # 2 * per_class rows at most
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))  # an id may stand on several rows


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1500, **options) -> Space:
    """``per_class`` bounds the sample; the prior counts all usable labels."""
    seen = {r.quality: r.n for r in usable_labels(labels).groupBy("quality").agg(F.count("*").alias("n")).collect()}
    prior = seen.get(1, 0) / sum(seen.values()) if seen else 0.5

    def per_batch(texts):
        return [[features(t).astype(np.float16).tobytes() for t in texts]]

    rows = training_sample(docs, labels, per_class)
    got = sorted(map_text(rows, "text", ["doc_id", "quality"], [T.StructField("vector", T.BinaryType())], per_batch).collect(), key=lambda r: r.doc_id)
    x = np.array([np.frombuffer(r.vector, np.float16) for r in got], np.float32).reshape(-1, WIDTH)
    return fit_space(x, np.array([r.quality for r in got], np.float64), prior=prior, **options)


def score_quality(df: DataFrame, space: Space, text_col: str = "text", keep: list[str] | None = None, out: str = "score") -> DataFrame:
    """Append the score of every whole text to the kept columns."""
    shared = checked_broadcast(df.sparkSession, space, space.n_bytes)

    def per_batch(texts):
        model = shared.value
        found = []
        for lo in range(0, len(texts), 256):
            found += model.score(np.array([features(t) for t in texts[lo : lo + 256]])).tolist()
        return [found]

    return map_text(df, text_col, df.columns if keep is None else keep, [T.StructField(out, T.DoubleType())], per_batch)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_quality(docs, fit(docs, labels), keep=["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
