"""Runs of periodic words, found by naming windows of power-of-two length.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and a length of at least
``least`` words and ``power`` periods, that no neighbouring word extends keeping the period. Texts of a batch are
searched together:

* Naming: windows of 2**k words get numbers, from the numbers of their halves; equal windows of one text have equal
  numbers. A window that stands once in its text can equal no other: it has number 0, and no longer window that begins
  with it is named. Naming ends when no window is left.
* Grid: a run of period q holds a multiple i of q with the words from i equal to those from i + q for at least
  (power - 2) q words. So for every q the multiples of q are compared by the numbers of the largest window that short;
  neighbouring multiples that agree belong to one run, of which the first is followed. There are n / q for each q.
* Extension: both ways, from the longest windows to the shortest, one comparison of numbers each.
* A run of period q is one of a divisor of q too, with the same ends: the smallest period of equal ends stays.

Numbers are exact: no hash takes part and no suffixes are sorted. Work is n log n a text, however periodic it is.

Words are ``[^\\x20\\x09-\\x0D]+``. Null texts have no words; empty texts and texts without runs give an empty list and
their words joined by one space. Every row gives one row, repeated rows and null ids included; no row meets another.
Texts are whole; a batch holds ``BATCH_BYTES`` of text or one text. A caller's column with the name of a result gives
way to the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headwater.llm.common import col, map_text, spare

#: Bytes of text that are searched together, and grid places that are compared together.
BATCH_BYTES, GRID = 2 << 20, 1 << 20

RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])


def split_words(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """(words of all texts, offsets by text)."""
    lists = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
    flat = lists.flatten()
    offsets = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
    real = pc.not_equal(pc.binary_length(flat), 0)  # a text that begins or ends with white space has an empty part there
    total = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))]).astype(np.int64)
    return flat.filter(real), total[offsets]


def _numbered(keys: np.ndarray) -> np.ndarray:
    """1, 2, ... for equal keys, 0 for keys that stand once."""
    _, at, n = np.unique(keys, return_inverse=True, return_counts=True)
    many = n > 1
    return np.where(many, np.cumsum(many), 0)[at]


def window_names(codes: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """names[k][i]: number of the 2**k words from i on among those of its text, 0 if they stand once or pass its end."""
    n = len(codes)
    sizes = np.diff(offsets)
    text, end = np.repeat(np.arange(len(sizes)), sizes), np.repeat(offsets[1:], sizes)
    names, half = [_numbered(text * (int(codes.max(initial=0)) + 1) + codes).astype(np.int64)], 1
    while True:
        last = names[-1]
        at = np.flatnonzero(last)
        at = at[at + 2 * half <= end[at]]
        at = at[last[at + half] > 0]
        got = _numbered(last[at] * (int(last.max(initial=0)) + 1) + last[at + half])
        if not got.any():
            return names
        out = np.zeros(n, np.int64)
        out[at] = got
        names.append(out)
        half *= 2


def _extend(names: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many words before i equal those before j, and how many from i on those from j on (i < j)."""
    n = len(names[0])
    a, b, left = i.copy(), j.copy(), i.copy()
    for k in range(len(names) - 1, -1, -1):
        step, name = 1 << k, names[k]
        # beyond the ends is number 0
        x, y = np.minimum(a, n - 1), np.minimum(b, n - 1)
        same = (name[x] > 0) & (name[x] == name[y]) & (b < n)
        a, b = a + same * step, b + same * step
        x, y = left - step, left - step + (j - i)
        same = x >= 0
        x = np.maximum(x, 0)
        y = np.maximum(y, 0)
        same &= (name[x] > 0) & (name[x] == name[y])
        left = left - same * step
    return i - left, a - i


def find_runs(codes: np.ndarray, offsets: np.ndarray, least: int = 6, power: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs by start, then period; starts count over all texts. ``power`` is 4 or more."""
    if power < 4:
        raise ValueError("the grid needs four periods or more")
    if not len(codes):
        return (np.zeros(0, np.int64),) * 3
    names, sizes, first = window_names(codes, offsets), np.diff(offsets), offsets[:-1]
    found = []
    for k in range(1, len(names)):
        # periods whose two-fold holds windows of 2**k words and none of 2**(k + 1)
        name, low, high = names[k], 1 << (k - 1), 1 << k
        held = np.add.reduceat(np.append(name > 0, False), np.minimum(offsets[:-1], len(codes))) * (sizes > 0)
        texts = np.flatnonzero((held > 1) & (sizes >= power * low))
        if not len(texts):
            continue
        periods = np.minimum(sizes[texts] // power, high - 1) - low + 1
        t = np.repeat(texts, periods)
        q = low + np.arange(len(t)) - np.repeat(np.cumsum(periods) - periods, periods)
        places = sizes[t] // q - 2
        cut = np.searchsorted(np.cumsum(places), np.arange(0, int(places.sum()), GRID)).tolist()
        for lo, hi in zip(cut, [*cut[1:], len(t)]):
            m = places[lo:hi]
            pair = np.repeat(np.arange(lo, hi), m)
            nth = np.arange(len(pair)) - np.repeat(np.cumsum(m) - m, m)
            i = first[t[pair]] + nth * q[pair]
            hit = (name[i] > 0) & (name[i] == name[i + q[pair]])
            fresh = hit.copy()
            fresh[1:] &= ~(hit[:-1] & (pair[1:] == pair[:-1]))
            i, period = i[fresh], q[pair[fresh]]
            left, right = _extend(names, i, i + period)
            start, length = i - left, left + right + period
            ok = length >= np.maximum(least, power * period)
            found.append((start[ok], length[ok], period[ok]))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, length, period = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    one = np.ones(len(start), bool)
    one[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[one], length[one], period[one]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _search(texts: list[str], least: int, power: int) -> tuple[list[list[dict]], list[str]]:
    words, offsets = split_words(texts)
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    start, length, period = find_runs(codes, offsets, least, power)
    more = np.bincount(start + period, minlength=len(codes) + 1)
    less = np.bincount(start + length, minlength=len(codes) + 1)
    kept = np.cumsum(more - less)[: len(codes)] == 0
    ends = np.concatenate([[0], np.cumsum(kept)])[offsets]
    joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), words.filter(pa.array(kept))), pa.scalar(" ", pa.large_string()))
    cut = np.searchsorted(start, offsets)
    runs = [
        [{"start": s - o, "length": n, "period": q} for s, n, q in zip(start[a:b].tolist(), length[a:b].tolist(), period[a:b].tolist())]
        for a, b, o in zip(cut[:-1].tolist(), cut[1:].tolist(), offsets[:-1].tolist())
    ]
    return runs, joined.to_pylist()


def periodic_runs(df: DataFrame, text_col: str = "text", keep: list[str] | None = None, least: int = 6, power: int = 4, runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """The ``keep`` columns (all but the text) with ``runs``, by start, then period, and ``collapsed``: the words that no run holds after its first period."""
    keep = [c for c in df.columns if c != text_col] if keep is None else keep

    def per_batch(texts: list[str]) -> list[list]:
        out, lo, size = ([], []), 0, 0
        for hi, t in enumerate(texts, 1):
            size += len(t)
            if size >= BATCH_BYTES or hi == len(texts):
                for o, got in zip(out, _search(texts[lo:hi], least, power)):
                    o += got
                lo, size = hi, 0
        return list(out)

    return map_text(df, text_col, keep, [T.StructField(runs, T.ArrayType(RUN)), T.StructField(collapsed, T.StringType())], per_batch)


def looped(text: Column, doc_id: Column) -> Column:
    """The text, with its words from a place on repeated with a period, both told by the id's CRC, where 10 divides that."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def change(words: Column) -> Column:
        n = F.size(words)

        def at(place: Column) -> Column:
            a = place["a"].cast("int")
            return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % place["p"].cast("int")))), " ")

        a = g % n
        places = F.array(F.struct(a.alias("a"), (1 + F.floor((n - a) / (3 + g % 8))).alias("p")))
        return F.when(n > 0, F.get(F.transform(places, at), F.lit(0))).otherwise("")

    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.when(h % 10 == 0, F.get(F.transform(F.array(words), change), F.lit(0))).otherwise(text)


def runs_report(docs: DataFrame) -> DataFrame:
    """One row per document: count of runs, the longest run, digests of all runs and of the collapsed text."""
    text = spare(docs, "text")[0]
    found = periodic_runs(docs.select("doc_id", looped(col("text"), col("doc_id")).alias(text)), text, ["doc_id"])
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("q"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    found = found.withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.n").alias("length"),
        (-F.col("best.q")).alias("period"),
        F.floor(F.col("best.n") * 1000 / -F.col("best.q")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
