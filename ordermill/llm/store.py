"""Intermediate tables in the shared folder.

A written table cuts the lineage: what was read from it does not have to be
computed again when an executor is lost. Folders live below the session's
``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.session import remove, scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new shared folder and return the table read back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(df: DataFrame) -> None:
    """Delete the folder of a table that ``written`` returned and that nothing reads any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()[:1]}:
        remove(df.sparkSession, path)


#: Rows up to which a written table is broadcast.
BESIDE_ROWS = 50_000


def beside(df: DataFrame) -> DataFrame:
    """A written table of short rows as the small side of a join: broadcast if it is counted to have at most BESIDE_ROWS rows, else as it is."""
    return F.broadcast(df) if df.count() <= BESIDE_ROWS else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def column(name: str) -> Column:
    """A column of the given table, whatever its name."""
    return F.col(f"`{name.replace('`', '``')}`")


def packed(docs: DataFrame, without: tuple[str, ...] = ()) -> Column:
    """All columns of ``docs`` (but ``without``) as one struct, so that no name of theirs can clash with another one."""
    return F.struct(*[column(c).alias(c) for c in docs.columns if c not in without])


def row_name() -> Column:
    """What tells a document's rows apart: its id and the digest of its text. Rows with the same name are copies; a null id comes last."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.unhex(F.md5("text")).alias("digest"))
