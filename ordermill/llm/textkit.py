"""Vectorised views of an Arrow text column: words, lines and their hashes.

The helpers work on the bytes of many texts at once. A text column is taken
in slices of about a megabyte, so the working memory follows the longest text
of a slice and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_RNG = np.random.default_rng(20240229)
#: One odd multiplier for positions and one random value per byte.
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
#: Multipliers of the positions in a window of words.
_SLOT = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values (in wrapping arithmetic)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    if n > 1:
        out[1:] = np.uint64(base)
        np.cumprod(out, out=out)
    return out


_POW = _powers(int(_STEP), SLICE_BYTES)
_INV = _powers(pow(int(_STEP), -1, 1 << 64), SLICE_BYTES)


class Slice:
    """Some consecutive texts: rows ``lo`` to ``hi`` of the column.

    ``data`` are their bytes, ``offsets[i]`` is where text i begins.
    """

    def __init__(self, lo: int, hi: int, data: np.ndarray, offsets: np.ndarray):
        self.lo, self.hi, self.data, self.offsets = lo, hi, data, offsets

    def __len__(self) -> int:
        return self.hi - self.lo


def slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a text column (null counts as the empty text) into slices of about ``limit`` bytes."""
    for arr in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        pass_lo = 0
        arr = arr.cast(pa.large_string()).fill_null("")
        n = len(arr)
        if n == 0:
            continue
        bufs = arr.buffers()
        off = np.frombuffer(bufs[1], np.int64)[arr.offset:arr.offset + n + 1]
        raw = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
        while pass_lo < n:
            hi = int(np.searchsorted(off, off[pass_lo] + limit, side="right")) - 1
            hi = min(max(hi, pass_lo + 1), n)
            yield Slice(pass_lo, hi, raw[off[pass_lo]:off[hi]], off[pass_lo:hi + 1] - off[pass_lo])
            pass_lo = hi


def owner(offsets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which text each byte position lies in."""
    return np.searchsorted(offsets, at, side="right") - 1


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of True that stays within one text."""
    n = len(inside)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = offsets[(offsets > 0) & (offsets < n)]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[cut] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[cut - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each byte span; spans are sorted and do not overlap."""
    values = _BYTE[_LOWER] if lower else _BYTE
    return value_hash(lambda a, b: values[data[a:b]], start, end)


def value_hash(value_of, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """As ``span_hash``; ``value_of(a, b)`` gives the 64-bit values of the items from a to b."""
    out = np.zeros(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(int(np.searchsorted(end, start[i] + SLICE_BYTES, side="right")), i + 1)
        a, b = int(start[i]), int(end[j - 1])
        n = b - a
        power, inverse = (_POW, _INV) if n <= SLICE_BYTES else (_powers(int(_STEP), n), _powers(pow(int(_STEP), -1, 1 << 64), n))
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(value_of(a, b) * power[:n], out=total[1:])
        s, e = start[i:j] - a, end[i:j] - a
        out[i:j] = (total[e] - total[s]) * inverse[np.minimum(s, n - 1)] + (e - s).astype(np.uint64)
        i = j
    return mix(out)


def words(s: Slice, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a slice: text index, start, end, hash.

    ``lower`` folds A-Z before hashing.
    """
    start, end = spans(~_SPACE[s.data], s.offsets)
    return owner(s.offsets, start), start, end, span_hash(s.data, start, end, lower)


def window_hash(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive values; entry i covers i to i+size-1."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64(size))
    for j in range(size):
        out += h[j:j + n] * _SLOT[j]
    return mix(out)


def whole_hash(h: np.ndarray) -> np.uint64:
    """Hash of a whole short sequence, as ``window_hash`` of its own length."""
    return window_hash(h, len(h))[0]


def lines(s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The \\n-split lines of a slice: text index, number in the text, start, end.

    Every text has one line more than it has \\n; the empty text has one empty line.
    """
    n = len(s)
    breaks = np.flatnonzero(s.data == 0x0A)
    of = owner(s.offsets, breaks)
    text = np.concatenate([np.arange(n), of])
    start = np.concatenate([s.offsets[:-1], breaks + 1])
    order = np.lexsort((start, text))
    text, start = text[order], start[order]
    first = np.searchsorted(text, np.arange(n))
    number = np.arange(len(text)) - first[text]
    end = np.empty_like(start)
    end[:-1] = start[1:] - 1
    last = np.append(first[1:], len(text)) - 1
    end[last] = s.offsets[1:]
    return text, number, start, end
