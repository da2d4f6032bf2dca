"""Words of whole texts as flat numpy arrays: positions, 64-bit hashes, windows of hashes.

A batch of texts is one byte array with document offsets; nothing here loops over words or
documents in Python. Two words with the same folded bytes always hash alike; two different
words agree with a chance of about 2^-64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_SEED = np.random.default_rng(20240229)
_R = _SEED.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 2**64)
_SLICE = 1 << 18
_powers: dict[str, np.ndarray] = {}

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
#: Word bytes of benchmark decontamination: digits, letters, and every byte of a non-ASCII character.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
#: Word bytes of language modelling: all but space, tab, line feed, vertical tab, form feed, carriage return.
UNSPACED = np.ones(256, bool)
UNSPACED[[0x20, 9, 10, 11, 12, 13]] = False


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n+1 offsets; null counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2] if len(column) else None
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int, documents: int = 1 << 30) -> list[tuple[int, int]]:
    """Ranges of at most `documents` documents, of at most `most` bytes together; a longer document stands alone."""
    out, i, n = [], 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, min(i + documents, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1))
        out.append((i, j))
        i = j
    return out


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of the words, and for each document the index of its first word (n+1 entries)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    m = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty_like(m)
    before[0], before[1:] = False, m[:-1]
    starts = np.flatnonzero(m & (~before | edge[:-1]))
    after = np.empty_like(m)
    after[-1], after[:-1] = False, m[1:]
    ends = np.flatnonzero(m & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(32)
    return x


def _power(name: str, n: int) -> np.ndarray:
    if name not in _powers or len(_powers[name]) < n:
        step = np.full(max(n, _SLICE + 1), _BASE if name == "up" else _INV, np.uint64)
        step[0] = 1
        _powers[name] = np.multiply.accumulate(step)
    return _powers[name][:n]


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = FOLD) -> np.ndarray:
    """A 64-bit hash of each word's folded bytes, wherever it stands."""
    out, table, i = np.empty(len(starts), np.uint64), _R[fold], 0
    while i < len(starts):
        lo = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, lo + _SLICE, "right")))
        hi = int(ends[j - 1])
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(table[data[lo:hi]] * _power("up", hi - lo), out=sums[1:])
        s = starts[i:j] - lo
        out[i:j] = (sums[ends[i:j] - lo] - sums[s]) * _power("down", hi - lo + 1)[s]
        out[i:j] += (ends[i:j] - starts[i:j]).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        i = j
    return mix(out)


_STEP = 0xA0761D6478BD642F


def windows(h: np.ndarray, size: int) -> np.ndarray:
    """The hash of every `size` consecutive words: one shorter than h by size - 1, or empty."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n].copy()
    for k in range(1, size):
        out *= np.uint64(_STEP)
        out += h[k : k + n]
    return mix(out + np.uint64(size))


def within(first: np.ndarray, size: int) -> np.ndarray:
    """Which windows of `size` words lie in one document, given each document's first word."""
    n = int(first[-1]) - size + 1
    if n <= 0:
        return np.zeros(0, bool)
    ok = np.ones(n, bool)
    for k in range(1, size):  # a window starting k words before a boundary crosses it
        at = first[1:-1] - k
        at = at[(at >= 0) & (at < n)]
        ok[at] = False
    return ok


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated index ranges [start, start + length)."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    out = np.ones(total, np.int64)
    keep = lengths > 0
    s, n = starts[keep], lengths[keep]
    at = np.cumsum(n) - n
    out[at[0]] = s[0]
    out[at[1:]] = s[1:] - s[:-1] - n[:-1] + 1
    return np.cumsum(out)
