"""Vectorised text work on Arrow string buffers: words, word hashes, shingles.

Words are maximal runs of bytes other than space, tab, LF, VT, FF, CR.  Hashes are 64-bit and
the same in every process: a polynomial over a per-byte table, then a bit mixer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18  #: text handled at once inside a task, with some 8-byte numbers a byte; one longer text is handled alone

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_U = np.uint64
_MULTIPLIER = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """The public splitmix64 finaliser."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIER)
_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    table = _powers.get(str(base))
    if table is None or len(table) < n:
        full = np.full(max(n, CHUNK_BYTES), base, dtype=np.uint64)
        full[0] = 1
        table = _powers[str(base)] = np.multiply.accumulate(full)
    return table[:n]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with about ``limit`` bytes; null = empty."""
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        end = min(end, len(column))
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; other bytes stay."""
    return _LOWER[data]


def word_spans(data: np.ndarray, offsets: np.ndarray,
               between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the row pointer into them; ``between[byte]``: not in a word."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    space = between[data]
    before = np.empty(len(data), dtype=bool)
    before[0], before[1:] = True, space[:-1]
    after = np.empty(len(data), dtype=bool)
    after[-1], after[:-1] = True, space[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner] = True
    after[inner - 1] = True
    starts = np.flatnonzero(before & ~space)
    ends = np.flatnonzero(after & ~space) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of data[start:end] for every span."""
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * _power(_MULTIPLIER, len(data)), out=total[1:])
    at = _power(_INVERSE, len(data) + 1)[starts] if len(starts) else np.zeros(0, np.uint64)
    return mix((total[ends] - total[starts]) * at + (ends - starts).astype(np.uint64))


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words, over row boundaries too (callers mask those)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        total += words[j:j + n] * _power(_U(0xD1342543DE82EF95), 64)[j + 1]
    return mix(total + _U(k))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """For each row the sorted distinct hashes of its k-word shingles.

    Fewer words than k: the whole sequence as one; no word: empty.
    """
    text = lower(data)
    starts, ends, ptr = word_spans(text, offsets)
    words = span_hashes(text, starts, ends)
    windows = window_hashes(words, k)
    for i in range(len(offsets) - 1):
        a, b = ptr[i], ptr[i + 1]
        if b - a >= k:
            yield np.unique(windows[a:b - k + 1])
        elif b > a:
            yield window_hashes(words[a:b], int(b - a))
        else:
            yield np.zeros(0, np.uint64)


def set_digest(hashes: np.ndarray) -> np.uint64:
    """Order-free 64-bit digest of a set of hashes."""
    return mix(np.array([mix(hashes ^ _MULTIPLIER).sum(dtype=np.uint64) + _U(len(hashes))], np.uint64))[0]
