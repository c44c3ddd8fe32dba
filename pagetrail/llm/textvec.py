"""Words and word hashes of whole Arrow batches as numpy arrays.

A text column arrives as one byte buffer plus offsets. Words are found by a byte
table and hashed from prefix sums of ``G[byte] * P**position``: the sum over a
byte range times ``P**-start`` depends only on the bytes in it, so any range is
hashed in constant time and no Python string is made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

#: Bytes that separate words of ``[^\x20\x09-\x0D]+``.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: ASCII bytes other than letters, digits and the apostrophe separate word-like tokens.
NON_WORD = np.zeros(256, bool)
NON_WORD[:128] = True
NON_WORD[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
#: A-Z to a-z, every other byte as it is.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class _Powers:
    """Powers of the base and of its inverse, grown on demand and never pickled."""

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, np.uint64)

    def __reduce__(self):
        return _Powers, ()

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, BLOCK_BYTES + 1)
            self.up, self.down = (np.multiply.accumulate(np.r_[np.uint64(1), np.full(size - 1, np.uint64(base))]) for base in (_P, _P_INV))
        return self.up, self.down


_powers = _Powers()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``limit`` bytes; a longer document is a block of its own."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


class Words:
    """Words of the documents ``a`` to ``b`` of a batch: byte ranges, hashes, first word of each document."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, a: int, b: int, separators: np.ndarray = SPACE, fold: bool = True):
        self.data = data[offsets[a] : offsets[b]]
        if fold:
            self.data = FOLD[self.data]
        bounds = offsets[a : b + 1] - offsets[a]
        n = len(self.data)
        inside = ~separators[self.data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        cut = bounds[:-1][bounds[:-1] < n]
        begins[cut] = inside[cut]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        cut = bounds[1:][bounds[1:] > 0] - 1
        ends[cut] = inside[cut]
        self.starts, self.stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.starts, bounds)  # words of document i: first[i] to first[i + 1]
        up, self._down = _powers(n + 1)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[self.data] * up[:n], out=self._sums[1:])

    def hash(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return mix((self._sums[stops] - self._sums[starts]) * self._down[starts])

    def hashes(self) -> np.ndarray:
        return self.hash(self.starts, self.stops)


_ROLL = mix(np.arange(101, 117, dtype=np.uint64)) | np.uint64(1)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` (16 at most) consecutive word hashes, across documents too."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out += hashes[j : j + n] * _ROLL[j]
    return mix(out)


def whole(hashes: np.ndarray) -> np.uint64:
    """Hash of a whole (short) word sequence, distinct from any gram's."""
    out = np.uint64(len(hashes) + 0x51ED270B)
    for h in hashes:
        out = mix(np.array([out ^ h], np.uint64))[0]
    return out


def signed(x: np.ndarray) -> pa.Array:
    """Unsigned 64-bit hashes as the bigint Spark stores."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))
