"""Words of Arrow text columns as Arrow strings: exact, lower-cased (A-Z only), without a Python object per word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from ordermill.llm import textkit

#: Bytes of words: ASCII letters and every byte of a character beyond ASCII; the same and digits.
LETTERS = np.zeros(256, bool)
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = True
LETTERS_DIGITS = LETTERS.copy()
LETTERS_DIGITS[48:58] = True


def words(s: textkit.Slice, inside: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Which text each word of a slice belongs to, and the words (runs of ``inside`` bytes) in order."""
    kept = inside[s.data]
    start, end = textkit.spans(kept, s.offsets)
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=offsets[1:])
    data = textkit._LOWER[s.data[kept]]
    word = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return textkit.owner(s.offsets, start), word
