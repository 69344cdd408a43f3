"""Secret scans: pattern rules plus a token-efficiency test.

A string that a byte-pair vocabulary has never seen breaks into many short tokens. Long runs of base64 or hex
characters are encoded with a tiktoken vocabulary; those with few characters per
token count as random. Known digests (hex of 32, 40, 56, 64, 96 or 128 digits) and UUIDs are left out first. Runs in the
form of identifiers (dashed, dotted or underscored parts of one case up to 24 letters, CamelCase of three letters or more
a word, either with up to four digits behind, or short numbers) are judged by their parts without the signs between them:
words have many characters a token, so what has few is random for all its form. Runs of fewer than 20 characters are not
tested. Pattern rules are never suppressed by that test.

Null texts count as empty. Positions are code points, ends exclusive. Texts of any length are read whole.
"""

from __future__ import annotations

import base64
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headwater.llm.common import checked_broadcast, map_batches, map_text

#: The pattern rules, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
KINDS = ("assign", "access", "hex", "random")
#: The split pattern of the public vocabulary file.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

_RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")
_DIGEST_SIZES = {32, 40, 56, 64, 96, 128}
_UUID = re.compile(r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\Z")
_PARTS = re.compile(r"[-_/=+]+")
_NAME_PART = re.compile(r"(?:(?:[a-z]{0,24}|[A-Z]{0,24}|[A-Z]?[a-z]{2,24}(?:[A-Z][a-z]{2,24})*)[0-9]{0,4}|[0-9]{1,8}|v[0-9]+)\Z")
_KEYWORDS = ("password", "passwd", "secret", "token", "api")

SPAN = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("ratio", T.DoubleType())]
)


#: Characters per token up to which a run is random, and up to which one in the form of an identifier is.
MAX_RATIO, NAME_RATIO = 2.2, 2.05


def is_known(run: str) -> bool:
    """A digest of a usual length or a UUID."""
    return bool(_DIGEST.match(run) and len(run) in _DIGEST_SIZES or _UUID.match(run))


def looks_named(run: str) -> bool:
    """Whether all parts of a run have the form of plain words and short numbers."""
    return all(_NAME_PART.match(p) for p in _PARTS.split(run))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    out = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    # runs are maximal, so a run of enough digits is what the unbounded pattern finds too
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


class Efficiency:
    """Characters per token under a rank file."""

    def __init__(self, ranks: bytes):
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding("public", pat_str=SPLIT, mergeable_ranks=table, special_tokens={})

    def ratio(self, run: str) -> float:
        return len(run) / len(self.encoding.encode_ordinary(run))

    def part_ratio(self, run: str) -> float:
        """Characters per token of the parts with letters, each as it stands at the beginning of a text or within one."""
        parts = [p for p in _PARTS.split(run) if p and not p.isdigit()]
        tokens = (min(len(self.encoding.encode_ordinary(p)), len(self.encoding.encode_ordinary(f" {p}"))) for p in parts)
        return sum(map(len, parts)) / max(1, sum(tokens))

    def random_ratio(self, run: str, max_ratio: float = MAX_RATIO, name_ratio: float = NAME_RATIO) -> float | None:
        """Characters per token of a run that counts as random; None if it does not."""
        if not any(c.isalpha() for c in run) or is_known(run):
            return None
        named = looks_named(run)
        r = self.part_ratio(run) if named else self.ratio(run)
        return r if r <= (name_ratio if named else max_ratio) else None


def all_spans(text: str, eff: Efficiency, max_ratio: float = MAX_RATIO) -> list[tuple[int, int, int, float | None]]:
    """(start, kind's number, end, characters per token) of a text's base spans and random runs, by position."""
    found = [(a, k, b, None) for a, k, b in base_spans(text)]
    for m in _RUN.finditer(text):
        r = eff.random_ratio(m[0], max_ratio)
        if r is not None:
            found.append((m.start(), 3, m.end(), r))
    return sorted(found, key=lambda x: x[:3])


def _ranks(df: DataFrame, vocabulary: str):
    with open(vocabulary, "rb") as f:
        ranks = f.read()
    return checked_broadcast(df.sparkSession, ranks, len(ranks))


def scan_secrets(df: DataFrame, text_col: str = "text", keep: list[str] | None = None, vocabulary: str = VOCABULARY, max_ratio: float = MAX_RATIO, out: str = "spans") -> DataFrame:
    """Append ``out`` (kind, start, end, characters per token; the last null for pattern rules) by position."""
    shared = _ranks(df, vocabulary)

    def start():
        return Efficiency(shared.value)  # for one task, so that a worker does not hold it afterwards

    def spans(text: str, eff: Efficiency) -> list[dict]:
        return [{"kind": KINDS[k], "start": a, "end": b, "ratio": r} for a, k, b, r in all_spans(text, eff, max_ratio)]

    def per_batch(texts, eff):
        return [[spans(t, eff) for t in texts]]

    return map_text(df, text_col, df.columns if keep is None else keep, [T.StructField(out, T.ArrayType(SPAN))], per_batch, start)


def joined(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(df: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per document: counts by kind, the digest of the pattern rules' spans, and all spans."""
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return scan_secrets(df, keep=["doc_id"], vocabulary=vocabulary).select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(F.filter("spans", lambda s: s["kind"] != "random")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def redact(df: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY, mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns with every found span replaced by ``mark``; null texts stay null.

    Texts are scanned and cut in one pass: with two, a task would hold two Python workers, which outlive it.
    """
    cols, shared = df.columns, _ranks(df, vocabulary)
    at = cols.index(text_col)

    def cut(text: str | None, eff: Efficiency) -> str | None:
        spans = text and all_spans(text, eff)
        if not spans:
            return text
        parts, done = [], 0
        for start, _, end, _ in spans:
            if start >= done:
                parts += [text[done:start], mark]
            done = max(done, end)
        return "".join([*parts, text[done:]])

    def run(batches):
        eff = Efficiency(shared.value)  # for one task, so that a worker does not hold it afterwards
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                arrays = part.columns
                arrays[at] = pa.array([cut(t, eff) for t in arrays[at].to_pylist()], type=pa.string())
                yield pa.RecordBatch.from_arrays(arrays, names=cols)

    return map_batches(df, run, df.schema)
