"""Words of a column of texts and their 64-bit hashes, by whole-array steps over UTF-8 bytes.

A word is a run of bytes other than space and 0x09-0x0D. Hashes are polynomials over the bytes modulo
2^64, taken from one running sum per block of texts and then mixed; they depend on the word alone,
never on where it stands. Blocks hold about `BLOCK` bytes, so memory is bounded by the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 18
#: Odd base of the polynomial, and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes between alphanumeric terms: ASCII other than letters and digits.
PUNCTUATION = np.ones(256, bool)
PUNCTUATION[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (the usual two-multiply finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, INVERSE)):
            steps = np.full(max(n, 2 * BLOCK), base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


@dataclass
class Words:
    """Words of texts `first` to `first + n` of a batch, in order."""

    first: int
    n: int
    data: np.ndarray  # bytes of the block
    bounds: np.ndarray  # n + 1 byte positions of the texts
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    text: np.ndarray  # text of each word, counted from `first`
    gap: np.ndarray  # whether each byte is a separator
    sums: np.ndarray  # running sums of the polynomial

    def segment(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of any stretches of bytes."""
        return mix((self.sums[end] - self.sums[start]) * _power_tables(len(self.data) + 1)[1][start])

    def per_text(self) -> np.ndarray:
        """Number of words of each text."""
        return np.bincount(self.text, minlength=self.n)

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of runs of `size` words inside one text, and the position of their first words."""
        count = len(self.hash) - size + 1
        if count <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        at = np.flatnonzero(self.text[:count] == self.text[size - 1:])
        h = np.full(len(at), size, np.uint64)
        for k in range(size):
            h = mix(h * np.uint64(BASE) + self.hash[at + k])
        return h, at


def blocks(column: pa.Array, lower: bool = False, separator: np.ndarray = _SEPARATOR) -> Iterator[Words]:
    """Cut a string column into blocks of words; null is an empty text. `separator` says of each byte
    whether it stands between words."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    body = column.buffers()[2]
    everything = np.frombuffer(body, np.uint8) if body is not None and body.size else np.empty(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + BLOCK, "right")) - 1)
        last = min(last, n)
        bounds = offsets[first:last + 1] - offsets[first]
        data = everything[offsets[first]:offsets[last]]
        yield _cut(first, _LOWER[data] if lower else data, bounds, separator)
        first = last


def _cut(first: int, data: np.ndarray, bounds: np.ndarray, separator: np.ndarray) -> Words:
    n, size = len(bounds) - 1, len(data)
    if size == 0:
        none = np.empty(0, np.int64)
        return Words(first, n, data, bounds, none, none, np.empty(0, np.uint64), none, np.empty(0, bool), np.zeros(1, np.uint64))
    gap = separator[data]
    before = np.empty(size, bool)
    before[0], before[1:] = True, gap[:-1]
    after = np.empty(size, bool)
    after[-1], after[:-1] = True, gap[1:]
    full = bounds[1:] > bounds[:-1]
    before[bounds[:-1][full]] = True
    after[bounds[1:][full] - 1] = True
    word = ~gap
    start = np.flatnonzero(word & before)
    end = np.flatnonzero(word & after) + 1
    power, inverse = _power_tables(size + 1)
    total = np.zeros(size + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:size], out=total[1:])
    h = mix((total[end] - total[start]) * inverse[start])
    text = np.searchsorted(bounds, start, "right") - 1
    return Words(first, n, data, bounds, start, end, h, text, gap, total)


def distinct(text: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, key) pairs in order, with how often each occurs; `text` must be sorted."""
    order = np.lexsort((key, text))
    t, k = text[order], key[order]
    new = np.ones(len(t), bool)
    new[1:] = (t[1:] != t[:-1]) | (k[1:] != k[:-1])
    at = np.flatnonzero(new)
    return t[at], k[at], np.diff(np.append(at, len(t)))


def empty_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches that have rows; Spark may send an empty one."""
    return (b for b in batches if b.num_rows)
