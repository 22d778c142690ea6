"""Words of whole texts as NumPy arrays, straight from Arrow string buffers.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, which for UTF-8
is ``[^\\x20\\x09-\\x0D]+`` on code points.  A null text has no words.  Hashes are
64 bits wide, depend on the bytes alone and so agree between all tasks.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes worked on at once inside a task.
SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Byte classes; 0 is blank, and a word ends where the class changes.
INK = (~_SPACE).astype(np.uint8)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits with good diffusion (changes a copy)."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """``raw`` text bytes, word bounds in it, and per text the first word and bytes."""

    raw: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray      # len(texts) + 1: first word of each text
    bytes_at: np.ndarray   # len(texts) + 1: first byte of each text

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """64 bits for each word, eight bytes of it at a time."""
        raw = np.concatenate([self.raw, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(self.raw) + 1,), "<u8", raw.data, 0, (1,))
        left = self.ends - self.starts
        h = mix(left.astype(np.uint64) * _STEP ^ (eight[self.starts] & _KEEP[np.minimum(left, 8)]))
        at, more = 8, np.flatnonzero(left > 8)
        while len(more):
            rest = left[more] - at
            h[more] = mix(h[more] * _STEP ^ (eight[self.starts[more] + at]
                                             & _KEEP[np.minimum(rest, 8)]))
            more = more[rest > 8]
            at += 8
        return h

    def windows(self, h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        return windows(h, self.first, width)


def windows(h: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``width`` words inside a text and the word each starts at."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    g = h[:n].copy()
    for k in range(1, width):
        g *= _STEP
        g += h[k:k + n]
    last = np.repeat(first[1:], np.diff(first))[:n]
    at = np.flatnonzero(np.arange(n) + width <= last)
    return mix(g[at]), at


def words(texts: pa.Array, classes: np.ndarray = INK) -> Words:
    """Words of an Arrow string array; nulls count as empty.

    ``classes`` maps bytes to classes: with more than two of them, a word is a run
    of one class that is not 0.
    """
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    lo, hi = (int(offsets[0]), int(offsets[-1])) if len(offsets) else (0, 0)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8, hi - lo, lo) if data is not None and hi > lo \
        else np.zeros(0, np.uint8)
    at = offsets - lo if len(offsets) else np.zeros(1, np.int64)
    kind = classes[raw]
    ink = kind != 0
    turn = kind[1:] != kind[:-1]
    begin, end = ink.copy(), ink.copy()
    begin[1:] &= turn
    end[:-1] &= turn
    inner = at[(at > 0) & (at < len(raw))]
    begin[inner] = ink[inner]
    end[inner - 1] = ink[inner - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return Words(raw, starts, ends, np.searchsorted(starts, at), at)


def slices(batches: Iterator[pa.RecordBatch], column: str,
           most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``most`` bytes of ``column``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        piece = np.cumsum(np.asarray(size, np.int64)) // most
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)
    give_back()


def give_back() -> None:
    """Return what the allocators of this worker hold free; a worker outlives its task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def per_text(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``marks`` between consecutive ``bounds``."""
    total = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which of the keys occur at least twice."""
    s = np.sort(keys)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    k = np.searchsorted(twice, keys)
    k[k == len(twice)] = 0
    return twice[k] == keys
