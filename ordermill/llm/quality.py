"""Quality classifier: random Fourier features, ridge scores, isotonic calibration.

Document statistics (no labels, language, source or id) are standardised and
mapped to random cosines that approximate a Gaussian kernel. Every partition
sums its share of the normal equations; the driver solves the small system
and calibrates the ridge score on rows that the fit did not see.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm import rules, textkit
from ordermill.llm.store import packed, written

FEATURES = ("log_bytes", "log_words", "upper", "digit", "stop", "comma", "mark", "symbol", "bar", "quote", "wide", "breaks",
            "word_length", "word_spread", "distinct", "top_word", "same_next", "upper_words", "symbol_words", "stop_words",
            "line_words", "dup_lines", "repeat_words", "long_words")
#: Cosines.
WIDTH = 200
#: Labelled rows that the fit uses at most (a hash of the id picks them); features and scores cover all rows.
MAX_TRAIN = 200_000
TRAIN_TASKS = 16
RIDGE = 1e-4
#: Kernel width in standardised units, per square root of the number of features.
KERNEL = 0.8
#: Scores are calibrated in so many steps of equal width.
STEPS = 4000
SEED = 11

_CLASSES = {"upper": range(65, 91), "digit": range(48, 58), "stop": b".", "comma": b",;:", "mark": b"!?", "symbol": b"#*$%&<>@^~=+\\", "bar": b"|",
            "quote": b"\"'()[]{}", "wide": range(128, 256), "breaks": b"\n"}


def _share(top: np.ndarray, bottom: np.ndarray) -> np.ndarray:
    return top / np.maximum(bottom, 1)


def statistics(s: textkit.Slice) -> np.ndarray:
    """A row of FEATURES for every text of a slice; the empty text has zeros."""
    n = len(s)
    size = np.diff(s.offsets)
    text, start, end, h = textkit.words(s)
    count = np.bincount(text, minlength=n)
    own = {}
    for name, chars in _CLASSES.items():
        hit = np.zeros(256, bool)
        hit[list(chars)] = True
        own[name] = _share(rules._per_text(hit[s.data], s.offsets), size)
        if name in ("upper", "symbol"):
            total = np.zeros(len(s.data) + 1, np.int64)
            np.cumsum(hit[s.data], out=total[1:])
            inside = total[end] - total[start]
            own[f"{name}_words"] = _share(np.bincount(text[(2 * inside > end - start) if name == "upper" else inside > 0], minlength=n), count)
    length = (end - start).astype(float)
    mean = _share(np.bincount(text, length, minlength=n), count)
    spread = np.sqrt(np.maximum(_share(np.bincount(text, length * length, minlength=n), count) - mean * mean, 0))
    _, first, times = np.unique(rules._by_text(h, text), return_index=True, return_counts=True)
    top = np.zeros(n)
    np.maximum.at(top, text[first], times)
    pair = text[1:][(text[1:] == text[:-1]) & (h[1:] == h[:-1])] if len(h) > 1 else text[:0]
    last = s.data[end - 1] if len(end) else s.data[:0]
    base = rules.base_counts(s)
    lines = 1 + rules._per_text(s.data == 0x0A, s.offsets)
    own |= {
        "log_bytes": np.log1p(size), "log_words": np.log1p(count), "word_length": mean, "word_spread": spread,
        "distinct": _share(np.bincount(text[first], minlength=n), count), "top_word": _share(top, count),
        "same_next": _share(np.bincount(pair, minlength=n), count),
        "stop_words": _share(np.bincount(text[last == ord(".")], minlength=n), count),
        "line_words": np.log1p(count / lines), "dup_lines": _share(base["n_dup_lines"], lines),
        "repeat_words": _share(base["n_repeat_words"], count), "long_words": _share(np.bincount(text[length > 20], minlength=n), count),
    }
    return np.column_stack([own[f] for f in FEATURES]).astype(float)


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for s in textkit.slices(batch.column("text")):
            x = statistics(s)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(s.lo, len(s)), pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))],
                ["doc_id", "x"])


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``x`` (array<double>, in the order of FEATURES) of every row; a null text counts as empty."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_statistics, f"doc_id {kind}, x array<double>")


def held_out(doc_id) -> F.Column:
    """True for the third of the ids whose labels are never learned from; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


@dataclasses.dataclass
class Model:
    """A fitted classifier; small, so that it travels with the tasks."""

    mean: np.ndarray
    scale: np.ndarray
    direction: np.ndarray
    phase: np.ndarray
    weight: np.ndarray
    knots: np.ndarray
    heights: np.ndarray

    def cosines(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.direction + self.phase
        return np.column_stack([np.ones(len(x)), np.sqrt(2 / len(self.phase)) * np.cos(z)])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.cosines(x) @ self.weight

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated score; a thousandth of it is the raw score, which keeps an order where the calibration is flat."""
        raw = self.raw(x)
        level = np.interp(raw, self.knots, self.heights) if len(self.knots) else np.full(len(x), 0.5)
        return np.round(np.clip(0.999 * level + 0.001 * np.clip((raw + 0.5) / 2, 0, 1), 0, 1), 9)


def _batches(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[list[np.ndarray]]:
    for b in batches:
        if b.num_rows:
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            yield [x, *(b.column(c).to_numpy(zero_copy_only=False) for c in names)]


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: mean place and level of each block of the best non-decreasing fit; x is sorted."""
    blocks: list[list[float]] = []
    for place, level, weight in zip(x, y, w, strict=True):
        blocks.append([place * weight, level * weight, weight])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last, strict=True)]
    out = np.array(blocks).reshape(-1, 3)
    return out[:, 0] / out[:, 2], out[:, 1] / out[:, 2]


def training_rows(stats: DataFrame, labels: DataFrame, limit: int = MAX_TRAIN) -> DataFrame:
    """``doc_id``, ``x``, ``y`` of at most about ``limit`` labelled rows outside the held-out third.

    Labels of one document are averaged; null labels and null ids do not count.
    """
    return stats.join(known_labels(labels, limit), "doc_id").select("doc_id", "x", "y")


def known_labels(labels: DataFrame, limit: int = MAX_TRAIN) -> DataFrame:
    """``doc_id``, ``y`` of at most about ``limit`` labelled documents outside the held-out third."""
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.avg("quality").alias("y")))
    share = min(1.0, limit / max(known.count(), 1))
    if share < 1:
        known = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 20)) < int(share * (1 << 20)))
    return known


def fit(stats: DataFrame, labels: DataFrame, limit: int = MAX_TRAIN, seed: int = SEED) -> Model:
    """Fit on the labelled rows outside the held-out third.

    Three quarters of them give the ridge weights, the rest the calibration.
    Without labelled rows every score is 0.5.
    """
    rows = written(training_rows(stats, labels, limit).withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(4))), "train")
    d = len(FEATURES)
    moment = rows.agg(F.count(F.lit(1)).alias("n"), *[f(F.get("x", F.lit(i))).alias(f"{k}{i}") for i in range(d) for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    # Rounded, as the order of a sum over tasks is not fixed.
    mean = np.array([float(f"{moment[f'm{i}'] or 0:.6g}") for i in range(d)])
    scale = np.array([float(f"{moment[f's{i}'] or 0:.6g}") for i in range(d)])
    rng = np.random.default_rng(seed)
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), rng.normal(size=(d, WIDTH)) / (KERNEL * np.sqrt(d)), rng.uniform(0, 2 * np.pi, WIDTH),
                  np.zeros(WIDTH + 1), np.zeros(0), np.zeros(0))
    if not moment["n"]:
        return model
    upper = np.triu_indices(WIDTH + 2)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((WIDTH + 2, WIDTH + 2))
        for x, y in _batches(batches, "y"):
            z = np.column_stack([model.cosines(x), y])
            total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array([total[upper]], pa.list_(pa.float64()))], ["sums"])

    fitted = rows.filter("fold > 0")
    if not fitted.limit(1).count():
        fitted = rows
    parts = fitted.select("x", "y").coalesce(TRAIN_TASKS).mapInArrow(sums, "sums array<double>")
    got = parts.select(F.posexplode("sums").alias("k", "v")).groupBy("k").agg(F.sum("v").alias("v")).toPandas().sort_values("k")
    system = np.zeros((WIDTH + 2, WIDTH + 2))
    system[upper] = got["v"].to_numpy()
    system = system + system.T - np.diag(np.diag(system))
    n = system[0, 0]
    model.weight = np.linalg.solve(system[:-1, :-1] / n + RIDGE * np.eye(WIDTH + 1), system[:-1, -1] / n)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, y in _batches(batches, "y"):
            step = np.clip(np.floor((model.raw(x) + 0.5) / 2 * STEPS), 0, STEPS - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(step), pa.array(y)], ["step", "y"])

    other = rows.filter("fold = 0")
    if not other.limit(1).count():
        other = rows
    steps = other.select("x", "y").mapInArrow(place, "step long, y double").groupBy("step").agg(F.sum("y").alias("y"), F.count("y").alias("n"))
    got = steps.toPandas().sort_values("step")  # STEPS rows at most
    model.knots, model.heights = isotonic((got["step"].to_numpy() + 0.5) / STEPS * 2 - 0.5, (got["y"] / got["n"]).to_numpy(), got["n"].to_numpy().astype(float))
    return model


def score(stats: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score`` of every row of statistics."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, in _batches(iter([batch])):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], ["doc_id", "score"])

    kind = stats.schema["doc_id"].dataType.simpleString()
    return stats.mapInArrow(run, f"doc_id {kind}, score double")


def score_documents(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAIN) -> DataFrame:
    """Quality of every document: ``doc_id``, ``held_out``, ``score``, ``predicted``.

    ``docs`` needs ``doc_id`` and ``text``, ``labels`` ``doc_id`` and ``quality`` (0 or 1);
    other columns are ignored, so clashing names cannot occur. Null and empty
    texts have statistics of zero and are scored like others; repeated rows are
    scored each and alike; a null ``doc_id`` is scored, never learned from and
    not held out. Without usable labels every score is 0.5. An empty table gives an
    empty result. Texts are read whole at any length.
    """
    stats = written(document_statistics(docs), "statistics")
    got = score(stats, fit(stats, labels, limit))
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def passed(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAIN) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject.

    A row goes if it is predicted 0; every row is judged by its own text in the pass that reads it, so repeated ids, null ids
    and repeated rows need no rule. Null and empty texts are scored like others. All columns pass through whatever their
    names; an empty table gives an empty result; texts are read whole at any length.
    """
    # About ``limit`` ids at most: the statistics of the training rows are made beside a broadcast of bounded size.
    learnt = docs.select("doc_id", "text").join(F.broadcast(known_labels(labels, limit).select("doc_id")), "doc_id", "left_semi")
    model = fit(document_statistics(learnt), labels, limit)

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in textkit.slices(batch.column("text")):
                fine = pa.array(model.score(statistics(s)) >= 0.5)
                yield batch.slice(s.lo, len(s)).filter(fine)

    rows = docs.select("text", packed(docs, ("text",)).alias("row"))
    got = rows.mapInArrow(good, rows.schema)
    return got.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
