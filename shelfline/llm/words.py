"""Whole texts as flat byte arrays inside a task: words, their hashes, and runs of words.

Arrow hands a batch of texts as one buffer with offsets. Work on that buffer is cut into slices of
about a megabyte at text boundaries, so memory is bounded by the slice or by the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: words that end at white space
SPACED = np.ones(256, dtype=bool)
SPACED[[32, 9, 10, 11, 12, 13]] = False
#: words of digits, small letters and everything beyond ASCII
WORDY = np.zeros(256, dtype=bool)
WORDY[48:58] = WORDY[97:123] = WORDY[128:] = True

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) <= n:
        for i, base in enumerate((BASE, INVERSE)):
            steps = np.full(max(n + 1, SLICE + 1), base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit generator: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which the polynomial hash of any span follows by one difference."""
    power, _ = _power(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], dtype=np.uint64, out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, inverse = _power(len(sums) - 1)
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def slices(texts: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes, offsets of the rows in them); a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        last = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        last = min(max(last, row + 1), len(texts))
        yield row, last, data[offsets[row]:offsets[last]], offsets[row:last + 1].astype(np.int64) - int(offsets[row])
        row = last


def words(data: np.ndarray, offsets: np.ndarray, wordy: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and for each text the number of words before it."""
    inside = wordy[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before = np.empty(len(data), bool)
    before[:1], before[1:] = False, inside[:-1]
    after = np.empty(len(data), bool)
    after[-1:], after[:-1] = False, inside[1:]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashed_words(data: np.ndarray, offsets: np.ndarray, wordy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word after lower-casing A-Z, and for each text the number of words before it."""
    data = LOWER[data]
    starts, ends, bounds = words(data, offsets, wordy)
    return span_hash(prefix_sums(data), starts, ends), bounds


def run_hash(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of so many consecutive words."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(length):
        out = out * BASE + hashes[i:i + n]
    return mix(out)
