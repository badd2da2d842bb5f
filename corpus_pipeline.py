"""Corpus pipeline: quality classifier, line dedup, MinHash near-dedup, source mix, BPE.

Every stage takes (spark, docs, sf_dir) and works on all rows of ``docs``, which
is what the stage before kept. All but the last return the columns of
``documents``. Each result is written as Parquet to the shared folder and read
back as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ordermill.llm import bpe, linedup, mixing, neardup, quality, queries
from ordermill.llm.store import table, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject (learned from the labels of ``sf_dir``)."""
    return quality.passed(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that (nearly) equal an earlier one; ``n_chars`` follows the text."""
    return linedup.without_copied_lines(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return neardup.keep_one(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix to the target weights takes it (0 to 3 times)."""
    return mixing.mix_documents(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id`` and ``token_ids`` of every text of the mix."""
    return bpe.encode_documents(docs, queries.vocabulary())


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("MinHash near-dedup", near_stage),
    ("source mix", mix_stage),
    ("BPE encoding", encode_stage),
]

#: SQL cannot express the classifier, the signatures and the merges; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
