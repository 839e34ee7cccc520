"""Words and rolling hashes of whole Arrow batches of texts, in numpy.

Words are the maximal runs of bytes other than space and \\x09-\\x0D, which for UTF-8 text
are exactly the matches of ``[^\\x20\\x09-\\x0D]+``.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are handled in slices of about this many bytes, so that numpy work arrays stay
# small; one longer text makes a slice of its own.
SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BYTE = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of uint64 values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse modulo 2**64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 1)
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            up = np.cumprod(a)
            if size > 4 * SLICE_BYTES:  # an odd long text: don't keep its tables
                if key == "up":
                    first = up
                else:
                    return first, up
            else:
                _powers[key] = up
    return _powers["up"], _powers["down"]


class Texts:
    """Bytes of consecutive texts: ``buf`` with text i at ``off[i]:off[i + 1]``."""

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        self.buf, self.off = buf, off

    def __len__(self) -> int:
        return len(self.off) - 1

    def prefix(self, lower: bool) -> np.ndarray:
        """S with S[j] - S[i] = sum of byte values times base powers over buf[i:j]."""
        up, _ = powers(len(self.buf) + 1)
        s = np.empty(len(self.buf) + 1, np.uint64)
        s[0] = 0
        terms = (_BYTE_LOWER if lower else _BYTE)[self.buf]
        terms *= up[: len(self.buf)]
        np.cumsum(terms, out=s[1:])
        return s

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each word, and the index of its first word for each text
        (one more at the end)."""
        n = len(self.buf)
        word = ~IS_SPACE[self.buf]
        edge = np.zeros(n + 1, bool)
        edge[self.off] = True
        before = np.concatenate(([False], word))
        start = np.flatnonzero(word & (~before[:-1] | edge[:-1]))
        after = np.concatenate((word[1:], [False])) if n else word
        end = np.flatnonzero(word & (~after | edge[1:])) + 1
        return start, end, np.searchsorted(start, self.off)

    def word_hashes(self, start: np.ndarray, end: np.ndarray, lower: bool = True) -> np.ndarray:
        """A 64-bit hash of each word, the same for the same bytes anywhere."""
        s = self.prefix(lower)
        _, down = powers(len(self.buf) + 1)
        length = (end - start).astype(np.uint64)
        return mix((s[end] - s[start]) * down[start] + length)


def texts_of(column: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """Slices (first row, row after the last, texts) of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    col = pc.fill_null(column, "").cast(pa.large_string())
    n = len(col)
    if n == 0:
        return
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + n + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + slice_bytes, "right")) - 1)
        yield lo, hi, Texts(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
        lo = hi


def shingles(t: Texts, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word windows of lower-cased words, text after text, and where each
    text's begin. A text of 1 to k-1 words has one hash, of all its words."""
    start, end, first = t.words()
    w = t.word_hashes(start, end)
    count = np.diff(first)
    n_out = np.where(count >= k, count - k + 1, (count > 0).astype(count.dtype))
    begin = np.concatenate(([0], np.cumsum(n_out)))
    up, _ = powers(k + 1)
    out = np.empty(int(begin[-1]), np.uint64)
    if len(w) >= k:
        roll = np.zeros(len(w) - k + 1, np.uint64)
        for j in range(k):
            roll += w[j : len(w) - k + 1 + j] * up[j + 1]
        roll = mix(roll + np.uint64(k))
    long = count >= k
    # Position in `roll` of every window: the text's first word plus the place in the text.
    at = np.repeat(first[:-1][long] - begin[:-1][long], n_out[long])
    rows = np.flatnonzero(np.repeat(long, n_out))
    if len(rows):
        out[rows] = roll[rows + at]
    for i in np.flatnonzero((count > 0) & ~long):
        ws = w[first[i] : first[i + 1]]
        out[begin[i]] = mix(np.array([(ws * up[1 : len(ws) + 1]).sum() + np.uint64(len(ws))], np.uint64))[0]
    return out, begin


def give_back() -> None:
    """Give the memory that a worker has freed back to the system, at the end of a task: workers live
    on, and the allocators keep it for them beside what the executor holds."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim:
        trim(0)


def giving_back(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches; after the last, ``give_back``."""
    yield from it
    del it
    give_back()
