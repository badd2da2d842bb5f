"""Quality rules with compression bands.

A document passes if it has enough words, little text in repeated word
windows, and compresses neither too well (repetitive) nor too badly
(incompressible) for its length, as a whole and in fixed chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm import textkit

MIN_WORDS = 20
#: Largest share of words (in percent) inside repeated windows of WINDOW words.
MAX_REPEAT_PERCENT = 30
WINDOW = 8
LEVEL = 3
CHUNK_BYTES = 4096
#: Fixed values. Bytes from which a band holds, smallest and largest allowed
#: compressed size over raw size of a whole document. Under the first band's
#: length a ratio says nothing.
BANDS = ((200, 0.30, 1.00), (1000, 0.25, 0.75), (4000, 0.22, 0.72), (16000, 0.20, 0.70))
#: The same for a chunk, and the largest share of chunks outside of it.
CHUNK_BAND = (0.20, 0.75)
MAX_BAD_CHUNKS = 0.34

COLUMNS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "ratio double, n_chunks long, n_bad_chunks long")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


def _per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _by_text(key: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Keys that differ between texts."""
    return textkit.mix(key ^ (text.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def base_counts(s: textkit.Slice) -> dict[str, np.ndarray]:
    """The counts of the base rules for every text of a slice."""
    n = len(s)
    text, _, _, h = textkit.words(s)
    visible = ~textkit._SPACE[s.data]
    # Lines with a word that equal an earlier line of the text.
    of, _, a, b = textkit.lines(s)
    seen = np.zeros(len(s.data) + 1, np.int64)
    np.cumsum(visible, out=seen[1:])
    full = seen[b] > seen[a]
    of, a, b = of[full], a[full], b[full]
    key = _by_text(textkit.span_hash(s.data, a, b), of)
    _, first = np.unique(key, return_index=True)
    dup_lines = np.bincount(of, minlength=n) - np.bincount(of[first], minlength=n)
    # Words in windows that the text holds twice or more.
    repeat = np.zeros(n, np.int64)
    if len(h) >= WINDOW:
        at = np.flatnonzero(text[:len(h) - WINDOW + 1] == text[WINDOW - 1:])
        key = _by_text(textkit.window_hash(h, WINDOW)[at], text[at])
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        edge = np.zeros(len(h) + 1, np.int64)
        edge[at[twice]] += 1
        np.subtract.at(edge, at[twice] + WINDOW, 1)
        repeat = np.bincount(text[np.cumsum(edge)[:-1] > 0], minlength=n)
    return {
        "n_words": np.bincount(text, minlength=n),
        "word_chars": _per_text(visible & ((s.data & 0xC0) != 0x80), s.offsets),
        "n_symbols": _per_text(_SYMBOL[s.data], s.offsets),
        "n_dup_lines": dup_lines,
        "n_repeat_words": repeat,
    }


def compression(s: textkit.Slice) -> dict[str, np.ndarray]:
    """Compressed over raw size of each text, and how many of its chunks lie outside the chunk band.

    Chunks have CHUNK_BYTES; the last one of a text that is no multiple of it ends with the text and overlaps the one
    before, so all bytes of a text of a chunk or more are covered by chunks of full size.
    """
    press = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False).compress
    raw = s.data.tobytes()
    n = len(s)
    ratio, chunks, bad = np.ones(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
    low, high = CHUNK_BAND
    for i in range(n):
        a, b = int(s.offsets[i]), int(s.offsets[i + 1])
        if b == a:
            continue
        ratio[i] = len(press(raw[a:b])) / (b - a)
        for c in range(a, b, CHUNK_BYTES) if b - a >= CHUNK_BYTES else ():
            c = min(c, b - CHUNK_BYTES)
            chunks[i] += 1
            bad[i] += not low <= len(press(raw[c:c + CHUNK_BYTES])) / CHUNK_BYTES <= high
    return {"ratio": ratio, "n_chunks": chunks, "n_bad_chunks": bad}


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for s in textkit.slices(batch.column("text")):
            cols = base_counts(s) | compression(s) | {"n_bytes": np.diff(s.offsets)}
            own = batch.column("doc_id").slice(s.lo, len(s))
            yield pa.RecordBatch.from_arrays([own, *map(pa.array, cols.values())], ["doc_id", *cols])


def in_band(n_bytes, ratio, n_chunks, n_bad_chunks):
    """The method's verdict as a column: the ratios lie inside the limits of the text's length."""
    ok = F.lit(True)
    for least, low, high in BANDS:
        ok = F.when(n_bytes >= least, ratio.between(low, high)).otherwise(ok)
    return ok & (n_bad_chunks <= MAX_BAD_CHUNKS * n_chunks)


def quality_rules(docs: DataFrame) -> DataFrame:
    """Counts, compression figures and verdict of every document.

    Reads ``doc_id`` and ``text`` of ``docs``; other columns are ignored, so
    clashing names cannot occur. A null text counts as empty and an empty
    text has no words, ratio 1 and fails the base rules; rows that repeat a
    document are measured each; a null ``doc_id`` is passed on. An empty table
    gives an empty result. A text is measured whole at any length.
    """
    key = docs.schema["doc_id"].dataType.simpleString()
    got = docs.select("doc_id", "text").mapInArrow(_measure, f"doc_id {key}, {COLUMNS}, n_bytes long")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    verdict = in_band(F.col("n_bytes"), F.col("ratio"), F.col("n_chunks"), F.col("n_bad_chunks"))
    return got.withColumn("base_failed", failed).withColumn("kept", ~failed & verdict)
