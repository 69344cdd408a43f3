"""License scans: bounded-error search for short notices.

A notice of length n allows k = n // 10 edits, none where it has fewer than ten letters (``cc by nc``). By the pigeonhole principle a place with at most k edits holds at
least one of the k + 1 pieces of the notice unchanged, so exact searches for the pieces find every candidate
place; the ``regex`` library's bounded-error matching then verifies the place and counts its edits. Words that
tell one licence from another (``mit``, ``2``) must stand unchanged.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z are lower-cased. Null and empty texts have no words and
no spans. Repeated rows give repeated results. Texts of any length are scanned whole.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headwater.llm.common import map_text


@dataclass(frozen=True)
class Notice:
    label: str
    phrase: str
    fixed: tuple[str, ...] = ()
    base: bool = False


#: The notices searched for by default.
NOTICES = (
    Notice("mit", "under the mit license", ("mit",), True),
    Notice("apache-2", "apache license version 2", ("2",), True),
    Notice("cc-by-nc", "cc by nc", ("cc", "by", "nc"), True),
    Notice("bsd", "redistribution and use in source and binary forms"),
    Notice("gpl", "gnu general public license", ("gnu", "general")),
    Notice("mit", "permission is hereby granted free of charge"),
    Notice("mpl-2", "mozilla public license version 2", ("mozilla", "2")),
)

SPAN = T.StructType(
    [
        T.StructField("label", T.StringType()),
        T.StructField("word", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("edits", T.IntegerType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("base", T.BooleanType()),
    ]
)

_SPACES = bytes(32 if b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F else b for b in range(256))
_START = re.compile(r"(?<![^ ])[^ ]")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def folded_words(text: str) -> list[bytes]:
    """The words as UTF-8. Only A-Z change case, so character positions stay those of the text."""
    return text.encode("utf-8", "replace").lower().translate(_SPACES).split()


def pieces(phrase: str, k: int) -> list[tuple[int, str]]:
    """Cut a phrase into k + 1 pieces of nearly equal length, each with its offset."""
    cuts = [len(phrase) * i // (k + 1) for i in range(k + 2)]
    return [(a, phrase[a:b]) for a, b in zip(cuts, cuts[1:])]


def byte_places(text: str) -> Sequence[int]:
    """For every place in a text, its end included, the UTF-8 bytes before it."""
    if text.isascii():
        return range(len(text) + 1)
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.concatenate([[0], np.cumsum(1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000))]).tolist()


class Scanner:
    """Finds the notices in one text at a time."""

    def __init__(self, notices=NOTICES, letters_per_edit: int = 10):
        import regex

        self.notices = []
        for n in notices:
            k = len(n.phrase) // letters_per_edit
            parts = [f"{' '.join(g)}" for g in self._groups(n)]
            fuzzy = " ".join(regex.escape(p) if p in n.fixed else f"(?:{regex.escape(p)}){{e<={k}}}" for p in parts)
            pattern = regex.compile(f"(?b)(?<![^ ])(?:{fuzzy})(?![^ ])")
            self.notices.append((n, k, f" {n.phrase} ".encode(), [(o, p.encode()) for o, p in pieces(n.phrase, k)], pattern))

    @staticmethod
    def _groups(n: Notice) -> list[list[str]]:
        """The phrase's words, neighbours that may change put together, fixed ones alone."""
        out: list[list[str]] = []
        open_ = False
        for w in n.phrase.split():
            if w in n.fixed:
                out.append([w])
                open_ = False
            elif open_:
                out[-1].append(w)
            else:
                out.append([w])
                open_ = True
        return out

    def spans(self, text: str) -> tuple[int, list[dict]]:
        words = folded_words(text)
        joined = b" " + b" ".join(words) + b" "
        spaces: list[int] = []

        def word_at(at: int) -> int:
            """The number of the word that stands before this place or begins there."""
            if not spaces:
                spaces.extend(np.flatnonzero(np.frombuffer(joined, np.uint8) == 32).tolist())
            return bisect_left(spaces, at) - 1

        found: dict[tuple, tuple] = {}
        for n, k, exact, seeds, pattern in self.notices:
            at = joined.find(exact)
            taken: list[int] = []
            while at >= 0:
                taken.append(at + 1)
                found[(word_at(at + 1), n.label, n.phrase)] = (at + 1, at + len(exact) - 1, 0, n)
                at = joined.find(exact, at + 1)
            if k:
                reach = k + max(map(len, n.phrase.split()))
                for lo, hi in self._candidates(joined, seeds, len(n.phrase), k):
                    part = joined[lo:hi].decode("utf-8", "replace")
                    byte = byte_places(part)
                    for edits, start, end in self._places(part, pattern, k):
                        a = lo + byte[start]
                        near = bisect_left(taken, a - reach)
                        if edits and not (near < len(taken) and taken[near] <= a + reach):
                            key = (word_at(a), n.label, n.phrase)
                            if key not in found or found[key][2] > edits:
                                found[key] = (a, lo + byte[end], edits, n)
        if not found:
            return len(words), []
        places = [(m.start(), m.end()) for m in _WORD.finditer(text)]
        out = []
        for (word, label, _), (a, b, edits, n) in sorted(found.items(), key=lambda x: x[0]):
            last = word_at(b)
            out.append(
                {"label": label, "word": word, "start": places[word][0], "end": places[last][1], "edits": edits, "score": 1 - edits / len(n.phrase), "base": n.base and not edits}
            )
        return len(words), out

    @staticmethod
    def _places(part: str, pattern, k: int) -> list[tuple[int, int, int]]:
        """(edits, start, end) of the places in a window; of places that overlap the one with fewest edits, then the first.

        Every word is tried as a start: a search for the best match would pass over all places before it.
        """
        tried = [m for w in _START.finditer(part) if (m := pattern.match(part, w.start()))]
        out: list[tuple[int, int, int]] = []
        held = bytearray(len(part))  # characters of places that are taken
        for edits, a, b in sorted((sum(m.fuzzy_counts), m.start(), m.end()) for m in tried):
            if edits <= k and held.find(1, a, b) < 0:
                out.append((edits, a, b))
                held[a:b] = b"\x01" * (b - a)
        return out

    @staticmethod
    def _candidates(joined: bytes, seeds, length: int, k: int) -> list[tuple[int, int]]:
        """Windows, widened to whole words and merged, that hold every place with at most k edits."""
        windows = []
        for offset, seed in seeds:
            at = joined.find(seed)
            while at >= 0:
                # an edit can be a character of up to four bytes
                lo, hi = max(0, at - offset - 4 * k), min(len(joined), at - offset + length + 4 * k)
                windows.append((max(0, joined.rfind(b" ", 0, lo + 1)), e if (e := joined.find(b" ", hi - 1)) >= 0 else len(joined)))
                at = joined.find(seed, at + 1)
        merged: list[tuple[int, int]] = []
        for lo, hi in sorted(windows):
            if merged and lo <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
            else:
                merged.append((lo, hi))
        return merged


def scan_licenses(df: DataFrame, text_col: str = "text", keep: list[str] | None = None, notices=NOTICES) -> DataFrame:
    """Append ``n_words`` and ``spans`` (label, first word, character span, edits, score, base) to the kept columns."""
    fields = [T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(SPAN))]

    def per_batch(texts, scanner):
        return [list(x) for x in zip(*map(scanner.spans, texts))] or [[], []]

    return map_text(df, text_col, df.columns if keep is None else keep, fields, per_batch, lambda: Scanner(notices))


def labels_of(spans) -> F.Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")


def license_report(df: DataFrame) -> DataFrame:
    """One row per document: counts, places, labels and the best score, derived from the spans."""
    base = F.filter("spans", lambda s: s["base"])
    at = F.transform(base, lambda s: s["word"])
    return scan_licenses(df, keep=["doc_id"]).select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(at).alias("first_word"),
        F.array_max(at).alias("last_word"),
        labels_of(base).alias("base_labels"),
        labels_of(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("score"),
        F.size("spans").cast("long").alias("n_spans"),
    )
