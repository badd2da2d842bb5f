"""Target-distribution importance resampling.

Documents and target texts are counted in hashed buckets of word runs. A
bucket's gain is the logarithm of how much likelier the target is to hold it;
a document's weight is the sum of the gains of its features, looked up in
one array. With a Gumbel draw per document the highest scores are a sample
without replacement; the order comes from a distributed radix sort.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm import terms, textkit
from ordermill.llm.radix import radix_sort
from ordermill.llm.store import written

BUCKETS = 10_000
#: Features are all runs of 1 to RUNS consecutive words.
RUNS = 1
MIN_WORDS = 20
#: Share of the documents with MIN_WORDS words that is drawn.
PERCENT = 10
SEED = 2024


def features(s: textkit.Slice, runs: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of run from 1: the text and the bucket of every feature of a slice."""
    text, word = terms.words(s, terms.LETTERS_DIGITS)
    for k in range(1, runs + 1):
        n = len(word) - k + 1
        if n <= 0:
            return
        whole = text[:n] == text[k - 1:]
        run = word if k == 1 else pc.binary_join_element_wise(*[word.slice(j, n) for j in range(k)], pa.scalar(" ", pa.large_string())).filter(pa.array(whole))
        coded = run.dictionary_encode()
        crc = np.fromiter(map(zlib.crc32, coded.dictionary.cast(pa.large_binary()).to_pylist()), np.int64, len(coded.dictionary))
        yield text[:n][whole], (crc % buckets)[coded.indices.to_numpy()]


def bucket_counts(table: DataFrame, runs: int = RUNS, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts in each bucket. Tasks send at most ``buckets`` rows each, the driver gets as many."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for s in textkit.slices(batch.column("text")):
                for _, bucket in features(s, runs, buckets):
                    total += np.bincount(bucket, minlength=buckets)
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own])], ["bucket", "n"])

    got = table.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(buckets, np.int64)
    out[got["bucket"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket in thousandths, rounded down; one is added to every bucket of both sides."""
    s, t, n = source.astype(float), target.astype(float), float(len(source))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n))))


def weighted(docs: DataFrame, gain: np.ndarray, runs: int = RUNS) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight`` of every row."""
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in textkit.slices(batch.column("text")):
                n = len(s)
                n_words, n_features, weight = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
                for k, (text, bucket) in enumerate(features(s, runs, len(gain))):
                    count = np.bincount(text, minlength=n)
                    n_features += count
                    weight += np.bincount(text, gain[bucket], minlength=n)  # whole numbers, exact in doubles
                    if k == 0:
                        n_words = count
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(s.lo, n), pa.array(n_words), pa.array(n_features), pa.array(weight.astype(np.int64))],
                    ["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """A document's Gumbel draw in thousandths, rounded down, from the hash of its id; a null id counts as the empty text."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296)))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, runs: int = RUNS, seed: int = SEED) -> DataFrame:
    """Weight, score and rank of every document: ``doc_id``, ``n_features``, ``weight``, ``score``, ``rank``.

    ``docs`` needs ``doc_id`` (an integer) and ``text``, ``target`` ``text``; other
    columns are ignored, so clashing names cannot occur. Of the N documents
    with ``min_words`` words floor(percent * N / 100) are drawn, those with the highest
    scores; ``rank`` is 1, 2, 3, ... for them and null for the others. Ties go
    to the smaller ``doc_id`` and a null id comes last; repeated rows count
    each and get ranks of their own. Null and empty texts have no features, weight 0 and no rank. An
    empty target is allowed (then frequent features lose); an empty table of documents gives an empty result. Texts are
    read whole at any length.
    """
    gain = gains(bucket_counts(docs, runs), bucket_counts(target, runs))
    scored = weighted(docs, gain, runs).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    scored = written(scored, "scored")
    able = scored.filter(F.col("n_words") >= min_words)
    drawn = able.count() * percent // 100
    placed = radix_sort(able, [("score", True), ("doc_id", False)])
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    rest = scored.filter(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return placed.withColumn("rank", rank).drop("place").unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
