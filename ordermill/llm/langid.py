"""Language identification by string kernels.

A text is the set of its byte n-grams of 1 to LENGTH folded letters (the blended
spectrum, presence only); two texts' kernel is the share of common n-grams,
|x and y| / sqrt(|x| |y|), where only n-grams that occur in a landmark count.
Landmarks are texts of every language; the Nystroem map takes a text to its kernels
with them, whitened. One ridge regression per language against the rest is
fitted from partition-summed normal equations. As the map and the regression are linear in
the presence row, a batch of texts is scored by one matrix product.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm import textkit
from ordermill.llm.store import beside, written

LENGTH = 3
#: Texts that serve as landmarks, in equal parts from the languages (one of each at least).
LANDMARKS = 192
#: Texts that the fit uses at most, in equal parts from the languages (a hash of the text picks them); every text is scored whole.
MAX_TRAIN = 6000
RIDGE = 1e-3
#: Eigenvalues of the landmarks' kernel below this share of the largest are left out.
CUT = 1e-5
UNKNOWN = "und"
#: Fixed value: what a letter is.
LETTER = r"\p{L}"
#: Presence rows that are made at once.
BATCH_ROWS = 256
TRAIN_TASKS = 16

# Symbols of a folded text: 0 for a run of anything but letters, 1 to 26 for letters, then the bytes beyond ASCII.
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[65:91] = _SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[128:] = np.arange(27, 155)
SYMBOLS = 155


def grams(s: textkit.Slice, length: int = LENGTH) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length from 1: the text and the code of every n-gram of the folded texts; every text begins with a 0."""
    symbol = _SYMBOL[s.data]
    text = np.repeat(np.arange(len(s)), np.diff(s.offsets))
    first = np.zeros(len(symbol) + 1, bool)
    first[s.offsets[:-1]] = True
    first = first[:-1]
    before = np.empty_like(symbol)
    before[:1] = 0
    before[1:] = symbol[:-1]
    kept = (symbol > 0) | (before > 0) & ~first  # one 0 for each run of others
    lead = np.arange(len(s))
    symbol, text = np.concatenate([np.zeros(len(s), np.int64), symbol[kept]]), np.concatenate([lead, text[kept]])
    order = np.argsort(text, kind="stable")
    symbol, text = symbol[order], text[order]
    code, base = np.zeros(len(symbol), np.int64), 0
    for k in range(1, length + 1):
        n = len(symbol) - k + 1
        if n <= 0:
            return
        code = code[:n] * SYMBOLS + symbol[k - 1:]
        whole = text[:n] == text[k - 1:]
        yield text[:n][whole], code[whole] + base
        base += SYMBOLS ** k


def code_count(length: int = LENGTH) -> int:
    return sum(SYMBOLS ** k for k in range(1, length + 1))


def presence(s: textkit.Slice, column: np.ndarray, width: int, length: int = LENGTH) -> Iterator[tuple[int, int, np.ndarray]]:
    """0/1 rows of the texts of a slice, from text a to b; ``column`` maps a code to a column, -1 for none."""
    got = []
    for text, code in grams(s, length):
        at = column[code]
        known = at >= 0
        got.append((text[known], at[known]))
    for a in range(0, len(s), BATCH_ROWS):
        b = min(a + BATCH_ROWS, len(s))
        out = np.zeros((b - a, width), np.float32)
        for text, at in got:
            lo, hi = np.searchsorted(text, [a, b])
            out[text[lo:hi] - a, at[lo:hi]] = 1
        yield a, b, out


def unit(rows: np.ndarray) -> np.ndarray:
    """1 / sqrt of the number of n-grams of each row, 0 for none."""
    n = rows.sum(axis=1, dtype=np.float64)
    return np.where(n > 0, 1 / np.sqrt(np.maximum(n, 1)), 0)


@dataclasses.dataclass
class Model:
    """A fitted classifier: ``weights`` per n-gram and language; small, so that it travels with the tasks."""

    langs: list[str]
    codes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    length: int = LENGTH

    def __post_init__(self):
        self._column = None

    def __getstate__(self):
        return {**self.__dict__, "_column": None}

    def column(self) -> np.ndarray:
        if self._column is None:
            self._column = np.full(code_count(self.length), -1, np.int32)
            self._column[self.codes] = np.arange(len(self.codes), dtype=np.int32)
        return self._column

    def outputs(self, s: textkit.Slice) -> np.ndarray:
        """A row per text with the output of each regression."""
        out = np.empty((len(s), len(self.bias)))
        for a, b, rows in presence(s, self.column(), len(self.codes), self.length):
            out[a:b] = (rows @ self.weights) * unit(rows)[:, None] + self.bias
        return out


def held_out(doc_id: Column) -> Column:
    """True for the quarter of the ids that is never learned from; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def training_texts(docs: DataFrame, limit: int = MAX_TRAIN) -> tuple[list[str], DataFrame]:
    """The languages and a written table ``lang``, ``text``, ``turn`` of at most about ``limit`` different texts, evenly from the languages.

    Rows without an id, a letter or a language and held-out rows are left out. ``turn`` numbers a language's texts.
    """
    rows = docs.select("doc_id", "lang", "text").filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))).filter(F.col("text").rlike(LETTER))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    sizes = written(sizes, "sizes")
    langs = sorted(r.lang for r in sizes.collect())  # one row a language, which the model has to hold anyway
    quota = -(-limit // max(len(langs), 1))
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    some = rows.join(beside(sizes), "lang").filter(place * F.col("n") < quota).select("lang", "text").distinct()
    return langs, written(some.withColumn("turn", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("text"), "text"))), "train")


def landmark_codes(train: DataFrame, langs: int, landmarks: int, length: int) -> list[np.ndarray]:
    """The n-gram codes of each landmark: at most ``landmarks`` + ``langs`` arrays."""
    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in textkit.slices(batch.column("text")):
                text, code = (np.concatenate(x) for x in zip(*grams(s, length), strict=True))
                pair = np.unique(text * code_count(length) + code)
                text, code = pair // code_count(length), pair % code_count(length)
                cut = np.searchsorted(text, np.arange(len(s) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(cut), pa.array(code.astype(np.int32)))], ["codes"])

    marks = train.filter(F.col("turn") <= -(-landmarks // langs)).orderBy("lang", "turn")
    return [np.asarray(r.codes, np.int64) for r in marks.select("text").coalesce(1).mapInArrow(codes, "codes array<int>").collect()]


def fit(docs: DataFrame, limit: int = MAX_TRAIN, landmarks: int = LANDMARKS, length: int = LENGTH) -> Model:
    """Landmarks, Nystroem map and one regression per language; without learnable rows a model without languages."""
    langs, train = training_texts(docs, limit)
    if not langs:
        return Model([], np.zeros(0, np.int64), np.zeros((0, 0), np.float32), np.zeros(0), length)
    marks = landmark_codes(train, len(langs), landmarks, length)
    codes = np.unique(np.concatenate(marks))
    rows = np.zeros((len(marks), len(codes)))
    for i, own in enumerate(marks):
        rows[i, np.searchsorted(codes, own)] = 1
    rows *= unit(rows)[:, None]
    value, vector = np.linalg.eigh(rows @ rows.T)
    good = value > CUT * value[-1]
    # Kernels with the landmarks, whitened: presence rows times this.
    whiten = rows.T @ (vector[:, good] / np.sqrt(value[good]))
    width = int(good.sum())
    nystroem = Model([], codes, whiten.astype(np.float32), np.zeros(width), length)
    number = {lang: i for i, lang in enumerate(langs)}

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width + 1 + len(langs)))
        for batch in batches:
            own = np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)
            for s in textkit.slices(batch.column("text")):
                z = np.column_stack([np.ones(len(s)), nystroem.outputs(s)])
                total += z.T @ np.column_stack([z, np.eye(len(langs))[own[s.lo:s.hi]]])
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], ["sums"])

    parts = train.select("lang", "text").coalesce(TRAIN_TASKS).mapInArrow(sums, "sums array<double>")
    got = parts.select(F.posexplode("sums").alias("k", "v")).groupBy("k").agg(F.sum("v").alias("v")).toPandas().sort_values("k")
    system = got["v"].to_numpy().reshape(width + 1, -1) / train.count()
    solved = np.linalg.solve(system[:, :width + 1] + RIDGE * np.diag(np.arange(width + 1) > 0), system[:, width + 1:])
    return Model(langs, codes, (whiten @ solved[1:]).astype(np.float32), solved[0], length)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` of every row by a fitted model."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            known = pc.fill_null(pc.match_substring_regex(text, LETTER), False).to_numpy(zero_copy_only=False) & bool(model.langs)
            best, score = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for s in textkit.slices(text) if model.langs else ():
                share = np.maximum(np.round(model.outputs(s), 5), 0)
                best[s.lo:s.hi] = share.argmax(axis=1)
                score[s.lo:s.hi] = np.round(share.max(axis=1) / np.maximum(share.sum(axis=1), 1e-5), 5)
            names = pa.array([*model.langs, UNKNOWN], pa.string()).take(pa.array(np.where(known, best, len(model.langs))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), names, pa.array(np.where(known, score, 0.0))], ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def identify_languages(docs: DataFrame, limit: int = MAX_TRAIN) -> DataFrame:
    """Language of every document, learned from ``docs`` itself: ``doc_id``, ``held_out``, ``lang_pred``, ``score``.

    ``docs`` needs ``doc_id``, ``text`` and ``lang``; other columns are ignored, so clashing
    names cannot occur. ``score`` is the winner's share of the positive outputs; ties go to the language first in code
    point order. Null texts and texts without a letter are ``und`` with score 0, as is everything if no row can be learned from.
    Repeated rows are judged each and alike and learned from once; a null ``doc_id`` is judged, never learned from and not
    held out. An empty table gives an empty result. Texts are read whole at any length.
    """
    got = identify(docs, fit(docs, limit))
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
