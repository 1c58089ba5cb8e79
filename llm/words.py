"""Words of whole texts as numpy arrays: one vectorised pass over the bytes of an Arrow batch.

A word is a maximal run of bytes outside 0x20 and 0x09-0x0D; A-Z count as a-z. Every word gets a
64-bit hash. UTF-8 never uses those bytes inside a character, so byte runs are exactly the runs of
the pattern ``[^\\x20\\x09-\\x0D]+`` over code points.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SPACES = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
_CHUNK = 1 << 20
_U = np.uint64

#: Separators of contract words, and of plain words (runs of ASCII letters and digits and all other characters).
WHITE = np.zeros(256, bool)
WHITE[list(SPACES)] = True
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_fold = np.arange(256)
_fold[65:91] += 32
#: A random odd 64-bit value for every byte; both cases of A-Z share one.
_byte_values = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)[_fold] | _U(1)
_BASE = 0x9E3779B97F4A7C1B
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    up = down = np.zeros(0, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = _powers(_BASE, n), _powers(_INVERSE, n)
        return cls.up, cls.down


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that nearby inputs share no bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, and n+1 offsets; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end bytes of every word; no word crosses two texts."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~separators[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cut = offsets[(offsets > 0) & (offsets < len(data))]
    begins[cut] = inside[cut]
    ends[cut - 1] = inside[cut - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span (sorted, not overlapping), A-Z folded."""
    out = np.zeros(len(starts), np.uint64)
    k = 0
    while k < len(starts):
        low = starts[k]
        stop = max(k + 1, int(np.searchsorted(ends, low + _CHUNK, "right")))
        high = ends[stop - 1]
        up, down = _Powers.of(int(high - low) + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_byte_values[data[low:high]] * up[: high - low], out=sums[1:])
        s, e = starts[k:stop] - low, ends[k:stop] - low
        out[k:stop] = (sums[e] - sums[s]) * down[s]
        k = stop
    return mix(out ^ (ends - starts).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


class Words:
    """The words of a batch: data, spans, hashes, and at[i]:at[i+1] for those of text i."""

    def __init__(self, column: pa.Array | pa.ChunkedArray, separators: np.ndarray = WHITE, hashes: bool = True):
        self.data, self.offsets = text_bytes(column)
        self.starts, self.ends = word_spans(self.data, self.offsets, separators)
        self.at = np.searchsorted(self.starts, self.offsets)
        self.hashes = span_hashes(self.data, self.starts, self.ends) if hashes else None

    def __len__(self) -> int:
        return len(self.offsets) - 1


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of runs of ``size`` words; fewer words make one run, none makes none."""
    if not len(words):
        return words
    size = min(size, len(words))
    run = words[: len(words) - size + 1].copy()
    for k in range(1, size):
        run *= _U(0x9FB21C651E98DF25)
        run += words[k : len(words) - size + 1 + k]
    return np.unique(mix(run + _U(size)))
