"""Words and word-window hashes of whole Arrow text batches, by numpy over the text's bytes.

A word is a run of bytes other than the white space ``\\x20 \\x09-\\x0D`` (UTF-8 never uses these bytes
inside another character).  Word hashes are 64-bit polynomials over the bytes, mixed with the length;
window hashes are polynomials over word hashes, mixed again.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes handled at once (a longer text is handled alone, and whole).
SLICE_BYTES = 1 << 20

U = np.uint64
_B1, _B2 = U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POW_STEP = 1 << 16
_POW: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def tidy(run):
    """The batch function, giving its memory back to the system when it ends, the power tables too: Python workers outlive
    their tasks, and what one stage took would stand beside what the next one takes."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            _POW.clear()
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):       # glibc alone has it
                ctypes.CDLL(None).malloc_trim(0)
    return wrapped


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (kept, grown on demand)."""
    have = _POW.get(int(base))
    if have is None or len(have[0]) < n:
        size = -(-n // _POW_STEP) * _POW_STEP
        inv = U(pow(int(base), -1, 1 << 64))
        up, down = np.full(size, base, np.uint64), np.full(size, inv, np.uint64)
        up[0] = down[0] = U(1)
        have = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if size <= 2 * SLICE_BYTES:
            _POW[int(base)] = have
    return have


def window_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64 = _B2) -> np.ndarray:
    """Polynomial over values[start:end], the same wherever the run stands."""
    n = len(values)
    up, down = _powers(base, n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values.astype(np.uint64, copy=False) * up[:n], out=total[1:])
    return (total[ends] - total[starts]) * down[starts]


def slices(batch: pa.RecordBatch, text: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of at most ``size`` bytes of text (a longer text alone)."""
    col = batch.column(text)
    sizes = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + size, side="right")))
        yield batch.slice(at, to - at)
        at = to


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and each row's bounds in them (null: empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.type != pa.large_string():
        col = col.cast(pa.large_string())
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if col.null_count:
        col = pc.fill_null(col, "")
    offsets = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
    lo, hi = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(col.buffers()[2], np.uint8, hi - lo, lo) if hi > lo else np.zeros(0, np.uint8)
    return data, offsets - lo


class Words:
    """The words of a column of texts: byte bounds, 64-bit hashes, and each row's word bounds."""

    def __init__(self, col: pa.Array, lower: bool = False, is_gap: np.ndarray = _SPACE):
        data, bounds = text_bytes(col)
        if lower:
            data = _LOWER[data]
        self.data = data
        gap = np.ones(len(data) + 2, bool)
        gap[1:-1] = is_gap[data]
        first = ~gap[1:-1] & gap[:-2]
        last = ~gap[1:-1] & gap[2:]
        inner = bounds[1:-1]                       # a word also ends where its text ends
        inner = np.unique(inner[(inner > 0) & (inner < len(data))])
        solid = inner[~gap[inner + 1]]
        first[solid] = True
        solid = inner[~gap[inner]]
        last[solid - 1] = True
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.row = np.searchsorted(self.start, bounds)     # words row[i] to row[i + 1] are text i's
        sums = window_sums(data.astype(np.uint64) + U(1), self.start, self.end, _B1)
        self.hash = mix(sums ^ ((self.end - self.start).astype(np.uint64) * _B2))

    def __len__(self) -> int:
        return len(self.start)

    def n_words(self) -> np.ndarray:
        return np.diff(self.row)

    def doc(self) -> np.ndarray:
        """For each word the index of its text."""
        return np.repeat(np.arange(len(self.row) - 1), self.n_words())

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all windows of k words inside one text, and the windows' hashes."""
        n = len(self)
        if n < k:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        room = np.repeat(self.row[1:], self.n_words()) - np.arange(n)
        at = np.flatnonzero(room >= k)
        return at, mix(window_sums(self.hash, at, at + k))
