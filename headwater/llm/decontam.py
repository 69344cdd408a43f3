"""Benchmark decontamination by SimHash fingerprints of item-sized windows.

Each item is compared with every window of its own length in every document. A document that is shorter than the item
is one window, so that a truncated copy of an item is found by its whole text. Windows that hold fewer shingles of items
of that length than a match needs are no match of any; all others get a 64-bit SimHash, and the fingerprint index alone
names the items to compare: no other step tells the items of one length apart. These are verified by the exact weighted similarity: shared shingle weight over joint shingle weight, a
shingle weighing as often as it occurs.

The radius of an item follows from the similarity, so that no match lies beyond it. A window of ``w`` shingles that
matches an item of ``n`` shares at least ``s = (w + n) * least / (1 + least)`` of them; if ``o`` of the item's shingles have a
bit set, between ``o - (n - s)`` and ``o + (w - s)`` of the window's have it. Where both ends have the majority on one side, the
bit is firm: it is the same in all matches. An item's fingerprints are those that differ in the other bits alone. The
fingerprint is cut into blocks of four bits, and every block lists, for each of its values, the items that have it
within their radius; the items of a window are those that all its blocks list. Given a ``radius``, items within that
Hamming distance are compared instead, found by ``radius + 1`` blocks of which one must be equal; that can lose matches.

Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased. Items of fewer than five words take no part; null items and
texts have no words. Items with one text under several ids each match. Items reach the executors in blocks of at most
``BLOCK_BYTES`` (an item larger than that is a block of its own; it is sent only if a document is large enough to match
it); each block is one pass over the documents, which stay where they are: there is no exchange.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwater.llm.common import BROADCAST_BYTES, checked_broadcast, col, map_batches
from headwater.llm.words import Sequences, hashed_words

WIDTH, LEAST = 5, 0.8
#: Bytes of a block of items, some ITEM_BYTES for each and SHINGLE_BYTES for each of its words.
BLOCK_BYTES, ITEM_BYTES, SHINGLE_BYTES = 32 << 20, 800, 64
#: Windows fingerprinted at a time, and shingles unpacked at a time.
WINDOWS, UNPACKED = 8192, 1 << 16


def bit_blocks(radius: int) -> list[tuple[int, int]]:
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    return list(zip(cuts, cuts[1:]))


def bit_counts(shingles: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """How many of the ``n`` shingles from each of the ascending ``starts`` on have each of the 64 bits set."""
    asked, where = np.unique(np.concatenate([starts, starts + n]), return_inverse=True)
    sums = np.zeros((len(asked), 64), np.int32)  # of all shingles before the place asked for
    total, done = np.zeros(64, np.int32), 0
    for lo in range(int(asked[0]), int(asked[-1]), UNPACKED):
        hi = min(lo + UNPACKED, int(asked[-1]))
        bits = np.unpackbits(np.ascontiguousarray(shingles[lo:hi]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sum_ = np.cumsum(bits, axis=0, dtype=np.int32) + total
        end = int(np.searchsorted(asked, hi, side="right"))
        mine = asked[done:end]
        sums[done:end] = np.where((mine > lo)[:, None], sum_[np.maximum(mine - lo - 1, 0)], total)
        total, done = sum_[-1], end
    return sums[where[len(starts) :]] - sums[where[: len(starts)]]


def majority(ones: np.ndarray, n: int) -> np.ndarray:
    return np.packbits(2 * ones > n, axis=1, bitorder="little").view(np.uint64).ravel()


def simhash_rows(shingles: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints of the runs of ``n`` shingles that begin at the ascending ``starts``."""
    return np.concatenate([majority(bit_counts(shingles, starts[k : k + WINDOWS], n), n) for k in range(0, len(starts), WINDOWS)])


def sliding(hits: list[tuple[int, int]], often: dict[int, int], starts: Iterable[int], n: int) -> Iterator[tuple[int, int]]:
    """(first shingle, weight shared with the item) of the windows of ``n`` shingles at ascending ``starts``.

    ``hits`` are the places of the item's shingles in the text; ``often`` has those that the item holds more than once.
    """
    held, shared, left, right = defaultdict(int), 0, 0, 0
    for a in starts:
        while right < len(hits) and hits[right][0] < a + n:
            u = hits[right][1]
            shared += held[u] < often.get(u, 1)
            held[u] += 1
            right += 1
        while left < right and hits[left][0] < a:
            u = hits[left][1]
            held[u] -= 1
            shared -= held[u] < often.get(u, 1)
            left += 1
        yield a, shared


class Items:
    """A block of items with its fingerprint index."""

    def __init__(self, ids: list, shingles: list[np.ndarray], least: float = LEAST, radius: int | None = None):
        self.ids, self.least, self.radius = ids, least, radius
        self.size = np.array([len(s) for s in shingles], np.int64)
        flat = np.concatenate([np.zeros(0, np.uint64), *shingles])
        self.known, code = np.unique(flat, return_inverse=True)
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(self.known & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        owner, every = np.repeat(np.arange(len(self.size)), self.size), np.arange(len(self.known) + 1)
        # for every known shingle the lengths of the items that hold it
        pair = np.unique(np.stack([code, self.size[owner]], axis=1), axis=0)
        self.lengths, self.length_from = pair[:, 1], np.searchsorted(pair[:, 0], every)
        ends = np.cumsum(self.size)
        self.codes = [code[b - n : b].astype(np.int32) for n, b in zip(self.size, ends, strict=True)]
        self.ones = np.concatenate([np.zeros((0, 64), np.int32), *[bit_counts(flat, np.array([b - n]), int(n)) for n, b in zip(self.size, ends, strict=True)]])
        self.fps = majority(self.ones, self.size[:, None])
        self.of_size = {int(n): np.flatnonzero(self.size == n) for n in np.unique(self.size)}
        self.nth = np.zeros(len(self.size), np.int64)  # an item's place among those of its length
        for mine in self.of_size.values():
            self.nth[mine] = np.arange(len(mine))
        self._index: dict = {}
        self.compared = 0  # pairs of a fingerprint of windows and an item that were verified

    @property
    def n_bytes(self) -> int:
        held = (self.known, self.sieve, self.lengths, self.length_from, self.ones, self.fps, *self.codes)
        return sum(x.nbytes for x in held) + 200 * len(self.ids)

    def need(self, n: int, w: int) -> int:
        """The least weight that a match of an item of ``n`` and a window of ``w`` shingles shares."""
        return math.ceil((n + w) * self.least / (1 + self.least) - 1e-9)

    def _blocks(self, n: int, w: int) -> list[list[int]]:
        """For each block of four bits and each value the items of ``n`` shingles that list it, as a set of bits."""
        if len(self._index) > 1024:
            self._index.clear()
        if (n, w) not in self._index:
            mine, spare = self.of_size[n], self.need(n, w)
            ones = self.ones[mine]
            may = np.stack([2 * (ones - (n - spare)) <= w, 2 * (ones + (w - spare)) > w])  # the bit can be 0, can be 1
            table = [[0] * 16 for _ in range(16)]
            for b in range(16):
                for value in range(16):
                    fits = np.logical_and.reduce([may[value >> k & 1, :, 4 * b + k] for k in range(4)])
                    table[b][value] = int.from_bytes(np.packbits(fits, bitorder="little").tobytes(), "little")
            self._index[n, w] = table
        return self._index[n, w]

    def near(self, fp: int, n: int) -> set[int]:
        """Items of n shingles whose fingerprint is within the given radius."""
        if None not in self._index:
            index = defaultdict(set)
            for i, f in enumerate(self.fps.tolist()):
                for b, (lo, hi) in enumerate(bit_blocks(self.radius)):
                    index[b, f >> lo & (1 << hi - lo) - 1, int(self.size[i])].add(i)
            self._index[None] = index
        index = self._index[None]
        met = set().union(*(index.get((b, fp >> lo & (1 << hi - lo) - 1, n), ()) for b, (lo, hi) in enumerate(bit_blocks(self.radius))))
        return {i for i in met if (int(self.fps[i]) ^ fp).bit_count() <= self.radius}

    def candidates(self, fp: int, n: int, w: int) -> int:
        """The items of ``n`` shingles that a window of ``w`` with this fingerprint can match, as a set of bits."""
        if self.radius is not None:
            return sum(1 << int(self.nth[i]) for i in self.near(fp, n))
        met = -1
        for b, row in enumerate(self._blocks(n, w)):
            met &= row[fp >> 4 * b & 15]
            if not met:
                break
        return met

    def matches(self, texts: pa.Array) -> list[tuple[int, int, float, int, int]]:
        """(text's number, item's number, similarity, first word, windows) of every item that a text holds; best window."""
        words, offsets = hashed_words(texts, lower=True)
        if len(words) < WIDTH or not len(self.known):
            return []
        shingles = Sequences(words).at(np.arange(len(words) - WIDTH + 1), WIDTH)
        seen = np.flatnonzero(self.sieve[(shingles & np.uint64((1 << 20) - 1)).astype(np.int64)])
        code = np.searchsorted(self.known, shingles[seen])
        code[code == len(self.known)] = 0
        real = self.known[code] == shingles[seen]
        seen, code = seen[real], code[real]
        text = np.searchsorted(offsets, seen, side="right") - 1
        inside = seen + WIDTH <= offsets[text + 1]
        seen, code, text = seen[inside], code[inside], text[inside]
        # one row for each length of the items that hold a shingle
        many = self.length_from[code + 1] - self.length_from[code]
        at = np.repeat(np.arange(len(seen)), many)
        size = self.lengths[np.repeat(self.length_from[code] - (np.cumsum(many) - many), many) + np.arange(len(at))]
        order = np.lexsort((seen[at], size, text[at]))
        at, size = at[order], size[order]
        key = text[at]
        cuts = np.concatenate([[0], np.flatnonzero((np.diff(key) != 0) | (np.diff(size) != 0)) + 1, [len(at)]]) if len(at) else np.zeros(1, np.int64)
        found = []
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            t, n = int(key[lo]), int(size[lo])
            first, held = int(offsets[t]), int(offsets[t + 1] - offsets[t]) - WIDTH + 1
            w = min(n, held)
            if hi - lo >= self.need(n, w):
                group = at[lo:hi]
                found += [(t, *m) for m in self._compare(shingles, seen[group], code[group], n, w, first, first + held - w)]
        return sorted(found)

    def _compare(self, shingles: np.ndarray, seen: np.ndarray, code: np.ndarray, n: int, w: int, first: int, last: int) -> list[tuple[int, float, int, int]]:
        """Matches of the items of ``n`` shingles with the windows of ``w`` that begin from ``first`` to ``last``."""
        starts = np.fromiter(self._starts(seen.tolist(), self.need(n, w), w, first, last), np.int64)
        if not len(starts):
            return []
        fps, which = np.unique(simhash_rows(shingles, starts, w), return_inverse=True)
        windows = defaultdict(list)
        for k, fp in enumerate(fps.tolist()):
            met = self.candidates(fp, n, w)
            self.compared += met.bit_count()
            while met:
                windows[int(self.of_size[n][(met & -met).bit_length() - 1])].append(k)
                met &= met - 1
        out = []
        for i, ks in windows.items():
            mine = np.isin(code, self.codes[i])
            if mine.sum() < self.need(n, w):
                continue
            codes, often = np.unique(self.codes[i], return_counts=True)
            often = dict(zip(codes[often > 1].tolist(), often[often > 1].tolist(), strict=True))
            best, where, count = 0.0, 0, 0
            for a, shared in sliding(list(zip(seen[mine].tolist(), code[mine].tolist(), strict=True)), often, starts[np.isin(which, ks)].tolist(), w):
                sim = shared / (w + n - shared)
                if sim >= self.least:
                    count += 1
                    if sim > best:
                        best, where = sim, a - first
            if count:
                out.append((i, best, where, count))
        return out

    @staticmethod
    def _starts(hits: list[int], need: int, n: int, first: int, last: int) -> Iterator[int]:
        """The windows from ``first`` to ``last`` with ``need`` hits at least, in order."""
        done = first - 1
        for a, b in zip(hits, hits[need - 1 :]):
            if b - a < n:
                end = min(a, last)
                yield from range(max(done + 1, b - n + 1), end + 1)
                done = max(done, end)


def item_blocks(benchmark: DataFrame, least: float = LEAST, radius: int | None = None, block_bytes: int = BLOCK_BYTES) -> Iterator[Items]:
    """The items in blocks of at most ``block_bytes``, one at a time on the driver."""
    rows = benchmark.select(col("item_id").alias("i"), F.coalesce(col("text"), F.lit("")).alias("t")).where("i IS NOT NULL").distinct().orderBy("i", "t")

    def block(held: list) -> Items:
        return Items([i for i, _ in held], [s for _, s in held], least, radius)

    held, n_bytes, stream = [], 0, rows.toLocalIterator()
    while some := list(islice(stream, 256)):
        words, at = hashed_words(pa.array([r.t for r in some], pa.string()), lower=True)
        seq = Sequences(words)
        for r, a, b in zip(some, at[:-1].tolist(), at[1:].tolist(), strict=True):
            more = ITEM_BYTES + SHINGLE_BYTES * (b - a)
            if b - a < WIDTH:
                continue
            if held and n_bytes + more > block_bytes:
                yield block(held)
                held, n_bytes = [], 0
            held.append((r.i, seq.at(np.arange(a, b - WIDTH + 1), WIDTH)))
            n_bytes += more
    yield block(held)


def _broadcasts(docs: DataFrame, benchmark: DataFrame, text_col: str, **options) -> Iterator:
    """The blocks of items on the executors, one after the other.

    A block above the bound is one long item. A match has ``least`` times its shingles, each of which begins with a word
    and a space of its own; if no document is that large, the item is left out, as it can match none. Else the item is
    bounded by a multiple of the largest document, which a task holds as well.
    """
    spark, largest = docs.sparkSession, None
    for items in item_blocks(benchmark, **options):
        if items.n_bytes <= BROADCAST_BYTES or len(items.ids) > 1:
            yield checked_broadcast(spark, items, items.n_bytes)
            continue
        if largest is None:
            largest = docs.agg(F.max(F.octet_length(col(text_col).cast("string")))).first()[0] or 0
        if 2 * items.least * int(items.size.max(initial=0)) <= largest:
            yield spark.sparkContext.broadcast(items)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, item_id, similarity, first_word, n_windows): one row for each item that a document holds."""
    src = docs.select(col(id_col).alias("id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    kinds = [docs.schema[id_col].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()]
    schema = f"id {kinds[0]}, item_id {kinds[1]}, similarity double, first_word long, n_windows long"
    out = None
    for shared in _broadcasts(docs, benchmark, text_col, **options):

        def run(batches, shared=shared):
            for b in batches:
                for lo in range(0, b.num_rows, 512):
                    part = b.slice(lo, 512)
                    got = shared.value.matches(part.column(1))
                    if got:
                        t, i, s, a, n = zip(*got)
                        ids = [shared.value.ids[k] for k in i]
                        yield pa.RecordBatch.from_arrays(
                            [part.column(0).take(pa.array(t)), pa.array(ids), pa.array(s, pa.float64()), pa.array(a, pa.int64()), pa.array(n, pa.int64())],
                            names=["id", "item_id", "similarity", "first_word", "n_windows"],
                        )

        found = src.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows that hold no item, with all their columns."""
    names, at = docs.columns, docs.columns.index(text_col)
    out = docs
    for shared in _broadcasts(docs, benchmark, text_col, **options):

        def run(batches, shared=shared):
            for b in batches:
                for lo in range(0, b.num_rows, 512):
                    part = b.slice(lo, 512)
                    keep = np.ones(part.num_rows, bool)
                    keep[[t for t, *_ in shared.value.matches(part.column(at).cast(pa.string()).fill_null(""))]] = False
                    yield pa.RecordBatch.from_arrays(part.filter(pa.array(keep)).columns, names=names)

        out = map_batches(out, run, docs.schema)
    return out


def leak_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return find_leaks(docs, benchmark).withColumnRenamed("id", "doc_id")
