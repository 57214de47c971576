"""Vectorised text helpers shared by the Arrow-batch operators.

All work on the raw UTF-8 bytes of an Arrow string column: words are found and hashed
for a whole slice of rows with NumPy, so no Python object is made per word. Working
memory follows the slice (``SLICE_BYTES``) or the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
WORD_BASE = _U(0xD1342543DE82EF95)

# word separators of the corpus contracts: space and U+0009..U+000D
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER_AZ = np.arange(256, dtype=np.uint8)
LOWER_AZ[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (two xor-shift-multiply rounds)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x2545F4914F6CDD1D))
_powers = np.ones(1, dtype=np.uint64)
_inverse_powers = np.ones(1, dtype=np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse_powers
    if len(_powers) < n:
        size = max(n, SLICE_BYTES + 4096)
        inverse = _U(pow(int(_BASE), -1, 1 << 64))
        steps = np.full(size, _BASE, dtype=np.uint64)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
        steps[1:] = inverse
        _inverse_powers = np.multiply.accumulate(steps)
    return _powers, _inverse_powers


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span ``data[starts[i]:ends[i]]`` (spans in order, disjoint)."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        lo = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, lo + SLICE_BYTES, "right")))
        hi = int(ends[j - 1])
        up, down = _power_tables(hi - lo + 1)
        sums = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUES[data[lo:hi]] * up[:hi - lo], out=sums[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * _U(0xA24BAED4963EE407))
        i = j
    return out


class Words:
    """Words of a slice of rows: ``row`` (index in the slice), byte ``start``/``end`` and
    ``hash`` per word; ``first[r]:first[r + 1]`` are the words of row ``r``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SEPARATOR,
                 fold: np.ndarray | None = None):
        self.data, self.offsets = data, offsets
        inside = ~separators[data]
        edges = np.zeros(len(data) + 1, dtype=bool)  # a row border always cuts a word
        edges[offsets] = True
        begins, stops = inside.copy(), inside.copy()
        if len(data):
            begins[1:] &= ~inside[:-1] | edges[1:-1]
            stops[:-1] &= ~inside[1:] | edges[1:-1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self.hash = span_hashes(data if fold is None else fold[data], self.start, self.end)

    def text(self, i: int) -> str:
        return self.data[self.start[i]:self.end[i]].tobytes().decode()


def joined_hashes(left: np.ndarray, right: np.ndarray, right_words: int) -> np.ndarray:
    """Hash of the concatenation of two neighbouring windows (``right`` spans
    ``right_words`` words): ``left * base**right_words + right`` modulo 2**64."""
    power = _U(pow(int(WORD_BASE), right_words, 1 << 64))
    return left * power + right


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all ``n``-word windows of one word-hash sequence, by repeated doubling
    (not mixed, so windows can be joined further). Length ``max(0, len - n + 1)``."""
    if len(words) < n:
        return np.empty(0, dtype=np.uint64)
    if n == 1:
        return words.copy()
    half = n // 2
    w = window_hashes(words, half)
    count = len(words) - 2 * half + 1
    w = joined_hashes(w[:count], w[half:half + count], half)
    return joined_hashes(w[:len(words) - n + 1], words[n - 1:], 1) if n % 2 else w


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut Arrow batches into row slices of about ``SLICE_BYTES`` of ``column`` and yield
    (rows, bytes, offsets); a longer single text is a slice of its own."""
    for batch in batches:
        data, offs = string_buffers(batch.column(column))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + SLICE_BYTES, "right")) - 1)
            yield batch.slice(lo, hi - lo), data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
            lo = hi


def signed(x: np.ndarray) -> pa.Array:
    """uint64 values as the bit-equal Arrow int64 column."""
    return pa.array(x.view(np.int64))
