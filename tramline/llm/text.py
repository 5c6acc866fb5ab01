"""Words and hashes of whole Arrow columns of text, by numpy."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_SEED = 0x9E3779B97F4A7C15
_BASE = 0xD6E8FEB86659FD93  # odd, so that it has an inverse modulo 2**64
OTHER_BASE = 0xA0761D6478BD642F  # of a second hash, where 64 bits are not enough
_CHUNK = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x = x * U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _constants(n: int, salt: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=U) * U(_SEED) + U(salt))


_BYTE = _constants(256, 1)
OTHER_BYTE = _constants(256, 2)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """An odd base to the powers 0 to n - 1, and their inverses."""
    if len(_POWERS.get(base, ((),))[0]) < n:
        size, both = max(n, _CHUNK + 1), []
        for b in (base, pow(base, -1, 1 << 64)):
            a = np.full(size, b, dtype=U)
            a[0] = 1
            both.append(np.cumprod(a, dtype=U))
        _POWERS[base] = (both[0], both[1])
    up, down = _POWERS[base]
    return up[:n], down[:n]


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of text, and where each row starts (one more for the end); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return (whole[at[0] : at[-1]], at - at[0]) if len(at) else (whole[:0], np.zeros(1, np.int64))


def chunks(column: pa.Array, size: int = _CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about `size` bytes: first row, row after the last, their bytes, their starts and end."""
    data, at = raw(column)
    n, i = len(at) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + size, side="right")) - 1)
        yield i, j, data[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j
    if n:
        _give_back()


def _give_back() -> None:
    """Returns free memory to the system, which else stays with the Python worker for as long as it is reused."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def byte_table(inside, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """For each byte, whether it belongs to a word, and the hash value it has (A-Z as a-z)."""
    value = _BYTE.copy()
    if lower:
        value[65:91] = value[97:123]
    return np.array([bool(inside(b)) for b in range(256)]), value


#: Words between ASCII white space; words of letters, digits and non-ASCII characters.
SPACED = byte_table(lambda b: b != 32 and not 9 <= b <= 13)
LETTERS = byte_table(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)


class Words:
    """The words of a chunk: `first` and `last` (bytes), `row` (of the chunk), `hashes`, `counts` (by row)."""

    def __init__(self, data: np.ndarray, at: np.ndarray, table: tuple[np.ndarray, np.ndarray]):
        inside, value = table
        m = inside[data]
        start, n = m.copy(), len(at) - 1
        start[1:] &= ~m[:-1]
        edges = at[:-1][at[:-1] < len(data)]
        start[edges] = m[edges]
        end = np.zeros(len(data), dtype=bool)
        end[:-1] = m[:-1] & ~m[1:]
        ends = at[1:][at[1:] > 0] - 1
        end[ends] = m[ends]
        self.first, self.last = np.flatnonzero(start), np.flatnonzero(end) + 1
        self.row = np.searchsorted(at, self.first, side="right") - 1
        self.counts = np.bincount(self.row, minlength=n).astype(np.int64)
        up, self._down = powers(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, dtype=U)
        np.cumsum(value[data] * up[:-1], out=self._sums[1:])
        self.hashes = self.spans(self.first, self.last)

    def spans(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hashes of byte ranges of the chunk."""
        return mix((self._sums[last] - self._sums[first]) * self._down[first] + (last - first).astype(U) * U(_SEED))


_STEP = _constants(64, 7) | U(1)


def grams(hashes: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words within a row, and the row of each. A row of 1 to n - 1 words has one run."""
    rows = np.repeat(np.arange(len(counts)), counts)
    before = np.cumsum(counts) - counts
    short = (counts > 0) & (counts < n)
    total = np.zeros(max(0, len(hashes) - n + 1), dtype=U)
    for k in range(n):
        total += hashes[k : k + len(total)] * _STEP[k]
    whole = rows[: len(total)] == rows[n - 1 :][: len(total)] if len(total) else np.zeros(0, bool)
    out, of = mix(total[whole] + U(n)), rows[: len(total)][whole]
    if short.any():
        extra = np.zeros(int(short.sum()), dtype=U)
        for i, r in enumerate(np.flatnonzero(short)):
            c = int(counts[r])
            extra[i] = (hashes[before[r] : before[r] + c] * _STEP[:c]).sum(dtype=U) + U(c)
        out, of = np.concatenate([out, mix(extra)]), np.concatenate([of, np.flatnonzero(short)])
        order = np.argsort(of, kind="stable")
        out, of = out[order], of[order]
    return out, of
