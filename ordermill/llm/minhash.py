"""MinHash signatures of ragged sets, and sets of word shingles."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from ordermill.llm import textkit

#: Words in a shingle.
SHINGLE = 5
#: Values that are worked on at a time (they stay in a core's cache).
CACHE_VALUES = 1 << 15

_RNG = np.random.default_rng(77)
_MULTIPLY = _RNG.integers(1, 1 << 32, 512, dtype=np.uint32) | np.uint32(1)
_ADD = _RNG.integers(0, 1 << 32, 512, dtype=np.uint32)


def signatures(values: np.ndarray, length: np.ndarray, k: int) -> np.ndarray:
    """``k`` minima of each set (uint32, one row per set).

    ``values`` (uint64, well mixed) holds the sets one after another, ``length`` their sizes; none is empty.
    """
    low = (values >> np.uint64(32)).astype(np.uint32)
    n = len(length)
    start = np.cumsum(length) - length
    out = np.full((n, k), np.uint32(0xFFFFFFFF))
    order = np.argsort(length, kind="stable")
    sizes = length[order]
    i = 0
    while i < n:
        # Sets of similar size make a block; the short ones repeat their last value.
        width = int(sizes[i])
        width += width // 8
        j = int(np.searchsorted(sizes, width, side="right"))
        j = max(min(j, i + max(1, CACHE_VALUES // max(width, 1))), i + 1)
        rows = order[i:j]
        width = int(length[rows[-1]])
        for a in range(0, width, CACHE_VALUES):  # a long set in pieces
            col = np.arange(a, min(width, a + CACHE_VALUES))
            block = low[start[rows][:, None] + np.minimum(col, length[rows][:, None] - 1)]
            value, least = np.empty_like(block), np.empty((k, len(rows)), np.uint32)
            for c in range(k):
                np.multiply(block, _MULTIPLY[c], out=value)
                np.add(value, _ADD[c], out=value)
                np.minimum.reduce(value, axis=1, out=least[c])
            out[rows] = np.minimum(out[rows], least.T)
        i = j
    return out


def shingle_sets(s: textkit.Slice) -> Iterator[tuple[int, np.ndarray]]:
    """Text index and the sorted distinct shingles of each text with words; A-Z are folded."""
    text, _, _, h = textkit.words(s, lower=True)
    n = np.bincount(text, minlength=len(s))
    end = np.cumsum(n)
    win = textkit.window_hash(h, SHINGLE)
    for i in np.flatnonzero(n).tolist():
        a, b = int(end[i] - n[i]), int(end[i])
        yield i, np.unique(win[a:b - SHINGLE + 1]) if b - a >= SHINGLE else np.array([textkit.whole_hash(h[a:b])])


def shingle_signatures(s: textkit.Slice, k: int) -> tuple[np.ndarray, list[bytes | None], np.ndarray]:
    """For every text: size of its set, a digest of the whole set (None if empty), and the signature."""
    size = np.zeros(len(s), np.int64)
    key: list[bytes | None] = [None] * len(s)
    sig = np.zeros((len(s), k), np.uint32)
    at, sets = [], []
    for i, u in shingle_sets(s):
        size[i], key[i] = len(u), hashlib.blake2b(u.tobytes(), digest_size=16).digest()
        at.append(i)
        sets.append(u)
    if at:
        sig[at] = signatures(np.concatenate(sets), size[at], k)
    return size, key, sig


def rows_of(x: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column of the rows of a matrix."""
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel(), kind))
