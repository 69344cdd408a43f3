"""Words of many texts as arrays of 64-bit hashes, and hashes of word sequences."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_B1, _B2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xCA5A826395121157)
    return x ^ (x >> np.uint64(32))


def hashed_words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, offsets by text). Words are ``[^\\x20\\x09-\\x0D]+``; ``lower`` folds A-Z first."""
    from xxhash import xxh64_intdigest

    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten().dictionary_encode()
    names = flat.dictionary.cast(pa.binary()).to_pylist()
    codes = flat.indices.to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    hashes = np.fromiter((xxh64_intdigest(n, 7) for n in names), np.uint64, len(names))
    if b"" in names:  # text that begins or ends with white space
        real = codes != names.index(b"")
        total = np.concatenate([[0], np.cumsum(real)])
        offsets, codes = total[offsets], codes[real]
    return hashes[codes] if len(codes) else np.zeros(0, np.uint64), offsets


class Sequences:
    """Hashes of runs of ``k`` words, from prefix sums of w[i] * B**i modulo 2**64 (B odd)."""

    def __init__(self, words: np.ndarray, second: bool = False):
        base = _B2 if second else _B1
        w = mix(words ^ np.uint64(0x5851F42D4C957F2D)) if second else words
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        n = len(w)
        up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(0, n - 1), base)]), dtype=np.uint64)[:n]
        self.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, inverse)]), dtype=np.uint64)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(w * up, dtype=np.uint64)])

    def at(self, start: np.ndarray, k) -> np.ndarray:
        return mix((self.sums[start + k] - self.sums[start]) * self.down[start] + np.uint64(0x632BE59BD9B4E019) * np.asarray(k, np.uint64))
