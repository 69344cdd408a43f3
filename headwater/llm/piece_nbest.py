"""SentencePiece encoding and decoding: N-best segmentation over the piece lattice.

A forward Viterbi pass gives each lattice position the best score from the start. Those scores are exact heuristics
for a backward A* search from the end, so complete paths leave the queue in order of total score. No piece crosses
from a word into the following space or over a line break (a model with such pieces is refused), so a text's lattice is
a chain of word lattices: the distinct words of a batch are passed together and kept by the worker, with the loss of their second segmentation, and the N best of a text are the best
combinations of word segmentations. Only the N - 1 words of the smallest losses can differ in them; those are searched.

Scores are those of the model's pieces. A character without a piece becomes its UTF-8 byte pieces, as one edge of
score (least piece score - 10); this includes the model's space mark itself, so decoding is exact. Encoding puts one
space before the text, as the model does. Null texts stand for empty ones, which have no pieces and one path of
score zero. Texts of any length, without spaces as well, are handled whole.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator
from itertools import count

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headwater.llm.common import checked_broadcast, col, map_batches, map_text

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_UNITS = re.compile(r" *[^ \n]+| +|\n")
#: Words kept by a worker (some 300 bytes each); beyond that the store starts anew.
KEPT_WORDS = 400_000
#: Longest word that is passed together with others, characters of words that are passed together (some 230 bytes each), characters of texts.
TOGETHER, PASSED, CHARS = 96, 1 << 17, 1 << 20


class Trie:
    """The pieces as exact transitions (node, code point) -> node, sorted for searches of many at a time."""

    def __init__(self, pieces: list[tuple[str, int, float]]):
        children: dict[tuple[int, str], int] = {}
        ends: dict[int, tuple[int, float]] = {}
        for text, i, score in pieces:
            at = 0
            for c in text:
                at = children.setdefault((at, c), len(children) + 1)
            ends[at] = (i, score)
        keys = np.array([n << 21 | ord(c) for n, c in children], np.int64)
        order = np.argsort(keys)
        self.keys, self.child = keys[order], np.array(list(children.values()), np.int64)[order]
        self.piece = np.full(len(children) + 1, -1, np.int32)
        self.score = np.zeros(len(children) + 1)
        for n, (i, score) in ends.items():
            self.piece[n], self.score[n] = i, score
        self.sieve = np.zeros(1 << 22, bool)
        self.sieve[self._slot(self.keys)] = True

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(42)).astype(np.int64)

    def edges(self, chars: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first character, length, node) of all pieces that stand in the characters; ``left`` counts those up to the word's end."""
        at, node, size, out = np.arange(len(chars)), np.zeros(len(chars), np.int64), 0, []
        while len(at):
            key = node << 21 | chars[at + size]
            some = np.flatnonzero(self.sieve[self._slot(key)])
            place = np.minimum(np.searchsorted(self.keys, key[some]), len(self.keys) - 1)
            real = self.keys[place] == key[some]
            at, node, size = at[some[real]], self.child[place[real]], size + 1
            whole = self.piece[node] >= 0
            out.append((at[whole], np.full(whole.sum(), size), node[whole]))
            more = left[at] > size
            at, node = at[more], node[more]
        return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


class Lattice:
    """N-best segmentation of units and texts under a SentencePiece model."""

    def __init__(self, model: bytes, n: int = 3, kept_words: int = KEPT_WORDS):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.n = n
        self.bytes_of: list[bytes] = []
        self.byte_ids = [0] * 256
        self.vocab: dict[str, tuple[int, float] | None] = {}
        pieces = []
        for i in range(sp.get_piece_size()):
            text = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(text[3:5], 16)] = i
                self.bytes_of.append(bytes([int(text[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.bytes_of.append(b"")
            else:
                text = text.replace("▁", " ")
                self.bytes_of.append(text.encode())
                pieces.append((text, i, sp.get_score(i)))
        for text, i, score in pieces:
            for end in range(1, len(text)):
                self.vocab.setdefault(text[:end], None)
            self.vocab[text] = (i, score)
        # a piece goes no further than a unit: spaces lead a word or stand alone, a line break stands alone
        if crossing := [t for t, _, _ in pieces if _UNITS.fullmatch(t) is None]:
            raise ValueError(f"words cannot be searched one by one under a model with pieces such as {crossing[0]!r}")
        self.least = min(s for _, _, s in pieces) - 10
        self.trie = Trie(pieces)
        self.words: dict[str, tuple] = {}
        self.kept_words = kept_words
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.size = np.array([len(b) for b in self.bytes_of], np.int64)
        self.first = np.cumsum(self.size) - self.size

    def search(self, unit: str) -> list[tuple[float, list[int]]]:
        """The n best segmentations of a unit, best first."""
        size, vocab = len(unit), self.vocab
        best = [float("-inf")] * (size + 1)
        best[0] = 0.0
        ends: list[list] = [[] for _ in range(size + 1)]
        for i in range(size):
            here, single = best[i], False
            for j in range(i + 1, size + 1):
                piece = unit[i:j]
                if piece not in vocab:
                    break
                hit = vocab[piece]
                if hit is not None:
                    single = single or j == i + 1
                    ends[j].append((i, hit[0], hit[1]))
                    if here + hit[1] > best[j]:
                        best[j] = here + hit[1]
            if not single:
                ends[i + 1].append((i, -1, self.least))
                if here + self.least > best[i + 1]:
                    best[i + 1] = here + self.least
        found: list[tuple[float, list[int]]] = []
        order = count()
        queue = [(-best[size], 0, 0, size, 0.0, None)]
        while queue and len(found) < self.n:
            _, _, _, at, gain, path = heapq.heappop(queue)
            if not at:
                ids: list[int] = []
                place = 0
                while path is not None:
                    piece, place_end, path = path
                    ids += [piece] if piece >= 0 else [self.byte_ids[b] for b in unit[place:place_end].encode()]
                    place = place_end
                found.append((gain, ids))
                continue
            for start, piece, score in ends[at]:
                # among equals the one nearer to the start comes first, so ties cannot flood the queue
                heapq.heappush(queue, (-(best[start] + gain + score), start, -next(order), start, gain + score, (piece, at, path)))
        return found

    def word(self, unit: str) -> tuple:
        """(packed ids of the best segmentation, its score, loss of the second) by one forward pass that keeps two scores."""
        size, vocab, none = len(unit), self.vocab, float("-inf")
        best, second, back = [none] * (size + 1), [none] * (size + 1), [None] * (size + 1)
        best[0] = 0.0
        for i in range(size):
            one, two, single = best[i], second[i], False
            for j in range(i + 1, size + 1):
                hit = vocab.get(unit[i:j], 0)
                if hit is None:
                    continue
                if hit == 0:
                    break
                single = single or j == i + 1
                v = one + hit[1]
                if v > best[j]:
                    second[j], best[j], back[j] = best[j], v, (i, hit[0])
                elif v > second[j]:
                    second[j] = v
                if two + hit[1] > second[j]:
                    second[j] = two + hit[1]
            if not single:
                v = one + self.least
                if v > best[i + 1]:
                    second[i + 1], best[i + 1], back[i + 1] = best[i + 1], v, (i, -1)
                elif v > second[i + 1]:
                    second[i + 1] = v
                second[i + 1] = max(second[i + 1], two + self.least)
        ids, at = [], size
        while at:
            start, piece = back[at]
            ids += [piece] if piece >= 0 else [self.byte_ids[b] for b in reversed(unit[start:at].encode())]
            at = start
        return array("i", ids[::-1]).tobytes(), best[size], best[size] - second[size]

    def words_of(self, units: list[str]) -> list[tuple]:
        """``word`` of each unit, all passed together: forward by the place where a piece ends, back from all ends at once."""
        size = np.array([len(u) for u in units], np.int64)
        chars = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        first = np.cumsum(size) - size
        owner = np.repeat(np.arange(len(units)), size)
        offset = np.arange(len(chars)) - first[owner]
        at, length, node = self.trie.edges(chars, size[owner] - offset)
        bare = np.ones(len(chars), bool)
        bare[at[length == 1]] = False
        bare = np.flatnonzero(bare)  # characters without a piece of their own
        at = np.concatenate([at, bare])
        length = np.concatenate([length, np.ones(len(bare), np.int64)])
        piece = np.concatenate([self.trie.piece[node], np.full(len(bare), -1, np.int32)])
        score = np.concatenate([self.trie.score[node], np.full(len(bare), self.least)])
        # a word of n characters has n + 1 places
        start = at + owner[at]
        end = start + length
        order = np.lexsort((start, end, offset[at] + length))
        start, end, piece, score = start[order], end[order], piece[order], score[order]
        cuts = np.searchsorted((offset[at] + length)[order], np.arange(1, int(size.max()) + 2))
        places = len(chars) + len(units)
        best, second, back = np.full(places, -np.inf), np.full(places, -np.inf), np.full(places, -1, np.int64)
        best[first + np.arange(len(units))] = 0.0
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if lo == hi:
                continue
            one, two, to = best[start[lo:hi]] + score[lo:hi], second[start[lo:hi]] + score[lo:hi], end[lo:hi]
            new = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
            top = np.maximum.reduceat(one, new)
            group = np.repeat(np.arange(len(new)), np.diff(np.concatenate([new, [hi - lo]])))
            tops = np.flatnonzero(one == top[group])
            chosen = tops[np.unique(group[tops], return_index=True)[1]]  # among equals the longest piece
            one[chosen] = -np.inf
            best[to[new]], second[to[new]], back[to[new]] = top, np.maximum.reduceat(np.maximum(one, two), new), lo + chosen
        last = first + np.arange(len(units)) + size
        here, who, steps = last.copy(), np.arange(len(units)), []
        while len(who):
            e = back[here]
            steps.append((who, piece[e]))
            here = start[e]
            more = here > first[who] + who
            here, who = here[more], who[more]
        who, ids = (np.concatenate(c[::-1]) for c in zip(*steps))
        order = np.argsort(who, kind="stable")
        who, packed = who[order], ids[order].astype(np.int32).tobytes()
        ends = 4 * np.searchsorted(who, np.arange(len(units) + 1))
        bytes_ = np.zeros(len(units), bool)
        bytes_[who[ids[order] < 0]] = True
        loss = (best[last] - second[last]).tolist()
        out = [(packed[a:b], s, d) for a, b, s, d in zip(ends[:-1].tolist(), ends[1:].tolist(), best[last].tolist(), loss)]
        for k in np.flatnonzero(bytes_).tolist():  # byte pieces are written out one by one
            out[k] = self.word(units[k])
        return out

    def learn(self, units: set[str]) -> None:
        """Pass the units that are not kept yet."""
        new = {u for u in units if u not in self.words}
        if len(self.words) + len(new) > self.kept_words:
            self.words.clear()
            new = units
        short = sorted((u for u in new if len(u) <= TOGETHER), key=len)
        lo = 0
        while lo < len(short):
            hi, size = lo, 0
            while hi < len(short) and (hi == lo or size + len(short[hi]) <= PASSED):
                size += len(short[hi])
                hi += 1
            some = short[lo:hi]
            self.words.update(zip(some, self.words_of(some)))
            lo = hi
        for u in new:
            if len(u) > TOGETHER:
                self.words[u] = self.word(u)

    def encode_all(self, texts: list[str]) -> Iterator[tuple[array, list[tuple[float, list]]]]:
        """``encode`` of every text, some ``CHARS`` characters at a time."""
        lo = 0
        while lo < len(texts):
            hi, size = lo, 0
            while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= CHARS):
                size += len(texts[hi])
                hi += 1
            units = [_UNITS.findall(" " + t) if t else [] for t in texts[lo:hi]]
            self.learn(set().union(*units))
            yield from map(self._join, units)
            lo = hi

    def encode(self, text: str) -> tuple[array, list[tuple[float, list]]]:
        """The best ids and the n best paths as (score, changes); a change is (unit's number, its ids)."""
        return next(self.encode_all([text]))

    def _join(self, units: list[str]) -> tuple[array, list[tuple[float, list]]]:
        if not units:
            return array("i"), [(0.0, [])]
        packed, scores, losses = zip(*map(self.words.__getitem__, units))
        ids = array("i")
        ids.frombytes(b"".join(packed))
        total = sum(scores)
        # the words that lose least: only they can differ in one of the n best paths, and only they are searched
        paths: list[tuple[float, list]] = [(0.0, [])]
        for _, i in heapq.nsmallest(self.n - 1, zip(losses, range(len(losses)))):
            segments = self.search(units[i])
            paths = sorted(((a + scores[i] - s, c + [(i, p)] if k else c) for a, c in paths for k, (s, p) in enumerate(segments)), key=lambda x: x[0])[: self.n]
        return ids, [(total - a, c) for a, c in paths]

    def decode(self, ids) -> str:
        ids = np.asarray(ids, np.int64)
        size = self.size[ids]
        at = np.repeat(self.first[ids] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return self.flat[at].tobytes().decode("utf-8", "replace")[1:]


_loaded: dict[tuple, Lattice] = {}

PATH = T.StructType(
    [
        T.StructField("score", T.DoubleType()),
        T.StructField("changes", T.ArrayType(T.StructType([T.StructField("unit", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))]))),
    ]
)


def encode_nbest(df: DataFrame, text_col: str = "text", keep: list[str] | None = None, model: str = MODEL, n: int = 3, with_ids: bool = True, kept_words: int = KEPT_WORDS) -> DataFrame:
    """Append ``n_pieces``, ``ids`` (unless left out), ``ids_sha256`` (little-endian int32), ``paths`` and ``decoded_equal``."""
    with open(model, "rb") as f:
        proto = f.read()
    shared = checked_broadcast(df.sparkSession, proto, len(proto))

    def start():
        if (model, n, kept_words) not in _loaded:
            _loaded[(model, n, kept_words)] = Lattice(shared.value, n, kept_words)
        return _loaded[(model, n, kept_words)]

    def per_batch(texts, lattice):
        out: list[list] = [[] for _ in range(4 + with_ids)]
        for t, (ids, paths) in zip(texts, lattice.encode_all(texts)):
            row = [len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), [{"score": s, "changes": [{"unit": u, "ids": p} for u, p in c]} for s, c in paths], lattice.decode(ids) == t]
            for column, value in zip(out, row + ([np.array(ids, np.int32)] if with_ids else []), strict=True):
                column.append(value)
        return out

    fields = [
        T.StructField("n_pieces", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("paths", T.ArrayType(PATH)),
        T.StructField("decoded_equal", T.BooleanType()),
    ]
    return map_text(df, text_col, df.columns if keep is None else keep, fields + ([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []), per_batch, start)


def decode_ids(df: DataFrame, ids_col: str = "ids", out: str = "text", model: str = MODEL) -> DataFrame:
    """Append the text that piece ids stand for; null ids give null."""
    import pyarrow as pa

    with open(model, "rb") as f:
        proto = f.read()
    shared = checked_broadcast(df.sparkSession, proto, len(proto))
    keep = [c for c in df.columns if c.lower() not in (out.lower(), ids_col.lower())]

    def run(batches):
        if (model, 1, 1) not in _loaded:
            _loaded[(model, 1, 1)] = Lattice(shared.value, 1, 1)
        lattice = _loaded[(model, 1, 1)]
        for b in batches:
            ids = b.column(len(keep)).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(len(keep) + 1)] + [pa.array([None if x is None else lattice.decode(x) for x in ids], type=pa.string())], names=[*keep, ids_col, out]
            )

    src = df.select(*map(col, [*keep, ids_col]))
    return map_batches(src, run, T.StructType(src.schema.fields + [T.StructField(out, T.StringType())]))


def piece_report(docs: DataFrame, model: str = MODEL, n: int = 3) -> DataFrame:
    """One row per document: pieces of the best path, its digest, the n best scores and whether decoding gave the text."""
    out = encode_nbest(docs, keep=["doc_id"], model=model, n=n, with_ids=False)
    scores = F.transform("paths", lambda p: p["score"])
    return out.select("doc_id", "n_pieces", "ids_sha256", F.array_max(scores).alias("best_score"), scores.alias("scores"), "decoded_equal")
