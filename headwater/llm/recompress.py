"""Substring dedup by recompression.

Each round first names runs of equal symbols (by symbol and length) and then pairs: symbols fall into a left and a right
class by their name, and a left one followed by a right one becomes one symbol. A name is a hash of the names it stands
for, so equal runs and pairs have equal names in every document without an exchange. What a symbol becomes depends on
its neighbours, so a window of words fixes all symbols of its interior: from either end a round can lose the run that
the end cuts, and then a symbol that could pair with one outside. Those ends are followed through the rounds for
every window; what lies between them is the same wherever the window's words stand.

The key of a window is the least name of ``GRAM`` neighbouring interior symbols of the last round, of all of them where
there are fewer, and of its words where no interior is left (a run longer
than the window; equal neighbours of that kind repeat one another). Neighbouring windows of one
key and place make an occurrence; its words are those of all its windows. Keys that occur once rule their windows out.
Occurrences of one key whose words are all equal, by a second hash, are repeated as a whole; of those one, and each
occurrence that is equal to no other, sends its windows if its key has occurrences of different words, and a 128-bit
hash of all words verifies each. Rows of equal hashes are combined within a batch before the exchange, so a passage of
which a third of all rows have a copy costs one row a batch, and are read in order, so no key is held as a whole.

Windows of fewer than ``window`` words do not exist: shorter texts, null and empty ones lose nothing. Repeated rows
and ids of any type are allowed, null ones too: a text is named by 96 bits of its words and id. Windows are judged on
the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwater.llm.common import col, durable, release
from headwater.llm.words import Sequences, hashed_words, mix

WINDOW = 35
#: Symbols of a key.
GRAM = 5
#: Documents hashed at a time, and bytes of them beyond one.
BATCH, BATCH_BYTES = 1024, 4 << 20


def rounds_for(window: int) -> int:
    """The most rounds that leave two thirds of the window: round r loses some 1.5 symbols of (4/3)**r words at either end."""
    r, left = 0, float(window)
    while (left := left - 3 * (4 / 3) ** r) >= 2 * window / 3:
        r += 1
    return r


def recompress(name: np.ndarray, text: np.ndarray, lo: np.ndarray, hi: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names of the last round, first and end of each window's interior), from words, their texts and each window's ends."""
    for r in range(rounds):
        # runs of equal symbols; the runs that the ends cut are lost
        first = np.ones(len(name), bool)
        first[1:] = (name[1:] != name[:-1]) | (text[1:] != text[:-1])
        at = np.flatnonzero(first)
        run = np.cumsum(first) - 1
        size = np.diff(np.concatenate([at, [len(name)]])).astype(np.uint64)
        lo, hi = run[np.minimum(lo, len(name) - 1)] + 1, run[np.maximum(hi, 1) - 1]
        name, text = name[at], text[at]
        name = np.where(size > 1, mix(name + size * np.uint64(0xA0761D6478BD642F)), name)
        # pairs; an end loses a symbol that could pair with one outside
        left = (mix(name + np.uint64(0x1000193 * (r + 1))) >> np.uint64(63)).astype(bool)
        pair = np.zeros(len(name), bool)
        pair[:-1] = left[:-1] & ~left[1:] & (text[:-1] == text[1:])
        lo = lo + ~left[np.minimum(lo, len(name) - 1)]
        hi = hi - left[np.maximum(hi, 1) - 1]
        head = np.flatnonzero(pair)
        name[head] = mix(name[head] * np.uint64(0x9E3779B97F4A7C15) + mix(name[head + 1]) + np.uint64(r))
        stays = np.ones(len(name), bool)
        stays[head + 1] = False
        place = np.cumsum(stays) - 1
        some = lo < hi
        lo, hi = np.where(some, place[np.minimum(lo, len(name) - 1)], 0), np.where(some, place[np.maximum(hi, 1) - 1] + 1, 0)
        name, text = name[stays], text[stays]
    return name, lo, hi


def least_in(value: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The place of the least value, the first of equals, in each range from ``lo`` to ``hi``, both included."""
    levels = [np.arange(len(value))]
    longest = int((hi - lo).max()) + 1 if len(lo) else 1
    while 2 ** len(levels) <= longest:
        half, last = 2 ** (len(levels) - 1), levels[-1]
        a, b = last[:-half], last[half:]
        levels.append(np.where(value[b] < value[a], b, a))
    level = np.log2(hi - lo + 1 + 1e-9).astype(np.int64)
    out = np.empty(len(lo), np.int64)
    for k, places in enumerate(levels):
        mine = np.flatnonzero(level == k)
        if len(mine):
            a, b = places[lo[mine]], places[hi[mine] - 2**k + 1]
            out[mine] = np.where(value[b] < value[a], b, a)
    return out


class Batch:
    """The texts of a batch as words, with their windows and occurrences of keys."""

    def __init__(self, texts: pa.Array, window: int):
        self.window = window
        self.words, self.offsets = hashed_words(texts)
        size = len(self.words)
        start = np.arange(max(0, size - window + 1))
        owner = np.searchsorted(self.offsets, start, side="right") - 1
        start = start[start + window <= self.offsets[owner + 1]] if len(start) else start
        self.start, self.sequences = start, Sequences(self.words)
        if not len(start):
            self.occurrence = self.first = self.text = start
            self.key = self.run = start.astype(np.uint64)
            self.alike = start > 0
            return
        text = np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))
        name, lo, hi = recompress(self.words.copy(), text, start, start + window, rounds_for(window))
        symbols = Sequences(name)
        many = hi - lo
        # the place of a key is a symbol's number; neighbours without interior are together as long as they are equal
        key, place = np.empty(len(start), np.uint64), np.empty(len(start), np.int64)
        full, none = many >= GRAM, many == 0
        some = ~full & ~none
        grams = symbols.at(np.arange(max(0, len(name) - GRAM + 1)), GRAM)
        place[full] = least_in(grams, lo[full], hi[full] - GRAM)
        key[full] = grams[place[full]]
        key[some], place[some] = symbols.at(lo[some], many[some]), lo[some]
        key[none], place[none] = ~self.sequences.at(start[none], window), len(name)
        new = np.ones(len(start), bool)
        new[1:] = (key[1:] != key[:-1]) | (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)
        self.occurrence = np.cumsum(new) - 1
        at = np.flatnonzero(new)
        last = np.concatenate([at[1:], [len(start)]]) - 1
        self.first, self.key = start[at], key[at]
        #: occurrences of several windows without interior, which repeat one another
        self.alike = none[at] & (last > at)
        self.run = Sequences(self.words, True).at(self.first, start[last] - start[at] + window)
        self.text = np.searchsorted(self.offsets, self.first, side="right") - 1

    def places(self, lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(the listed values, the first words of the texts that list them); a null list is an empty one."""
        n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.repeat(self.offsets[:-1], n)

    def marks(self, lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(which occurrences are repeated as a whole, which send their windows)."""
        value, base = self.places(lists)
        at = np.searchsorted(self.first, base + (value >> 2))
        out = np.zeros((2, len(self.first)), bool)
        out[0, at[value & 2 > 0]] = True
        out[1, at[value & 1 > 0]] = True
        return out[0], out[1]


def _slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Parts of batches with so many texts and bytes of them, each with one text at least."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < b.num_rows:
            hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + BATCH_BYTES, side="right"))
            hi = min(max(hi, lo + 1), lo + BATCH)
            yield b.slice(lo, hi - lo)
            lo = hi


def _groups(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(which rows differ from the one before, the group of each row) of sorted keys."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new, np.cumsum(new) - 1


def _deal(keys: list[np.ndarray], sure: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(the first row of each key, whether the key recurs or has a sure row, the rows that are not the first)."""
    order = np.lexsort(keys[::-1])
    if not len(order):
        return order, sure, order
    new, group = _groups([k[order] for k in keys])
    recurs = np.bincount(group, weights=1 + sure[order].astype(float)) > 1
    return order[new], recurs, order[~new]


def _i64(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(did, part, text, id): rows of one text under one id share did and part."""
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    name = [col(id_col), text]
    return docs.select(F.xxhash64(*name).alias("did"), F.shiftright(F.xxhash64(F.lit(9), *name), 32).cast("int").alias("part"), text.alias("text"), col(id_col).alias("id"))


def _in_order(asked: DataFrame, key: list[str]) -> DataFrame:
    return asked.repartition(int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions")), key[0]).sortWithinPartitions(*key)


def _columns(b: pa.RecordBatch, held: list[np.ndarray] | None) -> list[np.ndarray]:
    got = [c.to_numpy(zero_copy_only=False) for c in b.columns]
    return got if held is None else [np.concatenate(p) for p in zip(held, got)]


def _occurrences(asked: DataFrame) -> DataFrame:
    """(did, part, mark) of the occurrences whose key recurs; a mark is 4 * place + 2 if it is repeated as a whole + 1 if it sends its windows."""

    def out(did, part, pos, whole, sends) -> pa.RecordBatch:
        pick = whole | sends
        mark = pos[pick] * 4 + whole[pick] * 2 + sends[pick]
        return pa.RecordBatch.from_arrays([_i64(did[pick]), pa.array(part[pick], pa.int32()), _i64(mark)], names=["did", "part", "mark"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, earlier = None, False  # the first row of the last run of words, and whether its key had another run before
        for b in batches:
            if not b.num_rows:
                continue
            key, words, did, part, pos, many = rows = _columns(b, held)
            new_key, of_key = _groups([key])
            new, group = _groups([key, words])
            recurs = np.bincount(group, weights=1 + many.astype(float)) > 1
            runs = np.bincount(of_key[new])
            runs[0] += earlier
            several = runs[of_key[new]] > 1
            whole = np.where(new, recurs[group], True)
            sends = new & several[group]
            last = int(np.flatnonzero(new)[-1])  # waits: its run and its key may go on
            keep = np.arange(len(key)) != last
            yield out(*(c[keep] for c in (did, part, pos, whole, sends)))
            held, earlier = [c[last : last + 1] for c in rows[:5]] + [np.array([recurs[-1]])], bool(several[-1])
        if held is not None:
            yield out(held[2], held[3], held[4], held[5].astype(bool), np.array([earlier]))

    return _in_order(asked, ["key", "run"]).mapInArrow(run, "did long, part int, mark long")


def _lone(asked: DataFrame) -> DataFrame:
    """(did, part, pos) of the windows that no other row repeats."""

    def out(rows: list[np.ndarray], pick: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([_i64(rows[2][pick]), pa.array(rows[3][pick], pa.int32()), _i64(rows[4][pick])], names=["did", "part", "pos"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            rows = _columns(b, held)
            new, group = _groups(rows[:2])
            recurs = np.bincount(group, weights=1 + rows[5].astype(float)) > 1
            last = int(np.flatnonzero(new)[-1])
            yield out(rows, np.flatnonzero(~recurs[group][:last]))
            held = [c[last : last + 1] for c in rows[:5]] + [np.array([recurs[-1]])]
        if held is not None:
            yield out(held, np.flatnonzero(~held[5]))

    return _in_order(asked, ["one", "two"]).mapInArrow(run, "did long, part int, pos long")


def _listed(rows: DataFrame, value: str, name: str) -> DataFrame:
    return rows.groupBy("did", "part").agg(F.collect_set(value).alias(name))


def mark_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, text, marked, lone): for each row its occurrences of recurring keys and those of their windows that stand alone."""
    keyed = _keyed(docs, id_col, text_col)

    def ask_keys(batches):
        for b in _slices(batches, 2):
            x = Batch(b.column(2), window)
            head, recurs, rest = _deal([x.key, x.run], x.alike)
            rows = np.concatenate([head, rest])
            did, part, pos = b.column(0).to_numpy()[x.text[rows]], b.column(1).to_numpy()[x.text[rows]], (x.first - x.offsets[x.text])[rows]
            # repeats within the batch are whole by themselves; keys of their own keep them from one task
            own = mix(did[len(head) :].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + pos[len(head) :].astype(np.uint64))
            key, run = np.concatenate([x.key[head], own]), np.concatenate([x.run[head], np.zeros(len(rest), np.uint64)])
            yield pa.RecordBatch.from_arrays(
                [_i64(key), _i64(run), _i64(did), pa.array(part, pa.int32()), _i64(pos), pa.array(np.concatenate([recurs, np.ones(len(rest), bool)]))],
                names=["key", "run", "did", "part", "pos", "many"],
            )

    asked = keyed.drop("id").mapInArrow(ask_keys, "key long, run long, did long, part int, pos long, many boolean")
    marked = durable(_listed(_occurrences(asked), "mark", "marked"))
    release(docs.sparkSession)

    def ask_windows(batches):
        for b in _slices(batches, 2):
            x = Batch(b.column(2), window)
            whole, sends = x.marks(b.column(3))
            mine = sends[x.occurrence]
            start, sure = x.start[mine], whole[x.occurrence[mine]]
            one, two = x.sequences.at(start, window), Sequences(x.words, True).at(start, window)
            text = np.searchsorted(x.offsets, start, side="right") - 1
            head, recurs, _ = _deal([one, two], sure)
            did, part = b.column(0).to_numpy()[text[head]], b.column(1).to_numpy()[text[head]]
            yield pa.RecordBatch.from_arrays(
                [_i64(one[head]), _i64(two[head]), _i64(did), pa.array(part, pa.int32()), _i64((start - x.offsets[text])[head]), pa.array(recurs)],
                names=["one", "two", "did", "part", "pos", "many"],
            )

    # one exchange of the texts serves both joins
    base = keyed.join(marked, ["did", "part"], "left")
    some = base.where(F.exists("marked", lambda m: m.bitwiseAND(F.lit(1)) == 1)).select("did", "part", "text", "marked", "id")
    asked = some.mapInArrow(ask_windows, "one long, two long, did long, part int, pos long, many boolean")
    return base.join(_listed(_lone(asked), "pos", "lone"), ["did", "part"], "left").select("id", "text", "marked", "lone")


def covered(x: Batch, marked: pa.Array, lone: pa.Array) -> np.ndarray:
    """Which words of the batch a repeated window covers."""
    whole, sends = x.marks(marked)
    pos, base = x.places(lone)
    start = x.start[(whole | sends)[x.occurrence] & ~np.isin(x.start, base + pos)]
    size = len(x.words) + 1
    edge = np.bincount(start, minlength=size) - np.bincount(start + x.window, minlength=size)
    return np.cumsum(edge)[:-1] > 0


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_sha256 and, if asked for, the kept words as ``kept``."""
    found = mark_repeats(docs, id_col, text_col, window)

    def run(batches):
        for b in _slices(batches, 1):
            has = b.column(2).is_valid().to_numpy(zero_copy_only=False)
            gone = None
            if has.any():
                some = b.filter(pa.array(has))
                x = Batch(some.column(1), window)
                gone, ends = covered(x, some.column(2), some.column(3)), x.offsets
            rows: list[list] = [[], [], [], []]
            k = 0
            for i, text in enumerate(b.column(1).to_pylist()):
                words = text.encode("utf-8", "replace").split()
                kept = words
                if has[i]:
                    out = gone[ends[k] : ends[k + 1]]
                    k += 1
                    if out.any():
                        kept = [w for w, g in zip(words, out.tolist(), strict=True) if not g]
                whole = b" ".join(kept)
                for column, v in zip(rows, (len(words), len(words) - len(kept), hashlib.sha256(whole).hexdigest(), whole.decode("utf-8") if with_text else None), strict=True):
                    column.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.string()), *([pa.array(rows[3], pa.string())] if with_text else [])],
                names=["id", "n_words", "n_removed", "kept_sha256", *(["kept"] if with_text else [])],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return found.mapInArrow(run, f"id {kind}, n_words long, n_removed long, kept_sha256 string" + (", kept string" if with_text else ""))


def substring_report(docs: DataFrame) -> DataFrame:
    return dedup_substrings(docs.select("doc_id", "text"), with_text=False).withColumnRenamed("id", "doc_id")


#: Every window is compared as a string: plain, and far too wide for large tables.
SUBSTRING_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS i FROM d),
w AS (SELECT r, i, ws[i] AS word, CASE WHEN i + 34 <= len(ws) THEN array_to_string(ws[i:i + 34], ' ') END AS s FROM p),
f AS (SELECT r, i, word, s IS NOT NULL AND count(*) OVER (PARTITION BY s) > 1 AS again FROM w),
c AS (SELECT r, i, word, bool_or(again) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM f),
g AS (SELECT r, count_if(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM c GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN g USING (r)
"""
