"""Word and shingle hashes of whole Arrow text columns, computed on their UTF-8 bytes.

A word is a run of ASCII letters, digits and all non-ASCII characters; A-Z
count as a-z. A text of fewer words than a shingle, but some, has one shingle
of all of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (multiply and xor-shift)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


def _byte_values() -> np.ndarray:
    """A random 64-bit value for each byte of a word, 0 for separators; a capital has its small letter's."""
    values = mix(np.arange(1, 257, dtype="uint64") * np.uint64(_BASE))
    for b in range(128):
        if not chr(b).isalnum():
            values[b] = 0
    values[65:91] = values[97:123]
    return values


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype="uint64")
    steps[0] = 1
    return np.multiply.accumulate(steps)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every word of a text column, in order; null has no words."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    empty = np.empty(0, dtype="uint64"), np.empty(0, dtype="int64")
    if not len(texts):
        return empty
    offsets = np.frombuffer(texts.buffers()[1], dtype="int64")[texts.offset:texts.offset + len(texts) + 1]
    first, last = int(offsets[0]), int(offsets[-1])
    if first == last:
        return empty
    data = np.frombuffer(texts.buffers()[2], dtype="uint8")[first:last]
    offsets = offsets - first
    values = _byte_values()[data]
    inside = values != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[heads] = inside[heads]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return empty
    sums = np.add.reduceat(values * _powers(_BASE, len(values)), starts)
    hashes = mix(sums * _powers(_INVERSE, len(values))[starts])
    return hashes, np.searchsorted(offsets, starts, side="right") - 1


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles of one text's words."""
    if not len(hashes):
        return hashes
    n = max(1, len(hashes) - k + 1)
    total = np.zeros(n, dtype="uint64")
    for j in range(min(k, len(hashes))):
        total = (total + hashes[j:j + n]) * np.uint64(0x2545F4914F6CDD1D)
        total ^= total >> np.uint64(27)
    return mix(total + np.uint64(min(k, len(hashes))))


def texts_words(texts: pa.Array, start: int, end: int) -> list[np.ndarray]:
    """Word hashes of each text of rows [start, end)."""
    hashes, rows = word_hashes(texts.slice(start, end - start))
    return np.split(hashes, np.searchsorted(rows, np.arange(1, end - start)))
