"""Tables bucketed by a key: joins and groups on it need no shuffle (O-31, O-32).

Orders and items are written in the same number of buckets by ``order_id``; a report
then joins bucket by bucket and only its groups are exchanged. The layout is kept
beside the data, so a later session opens the table by its folder alone.

A bucket is read by one task. A table in which one key fills a bucket far beyond the
others is therefore read as plain files, whose join AQE cuts at the hot key: the rows
are the same, only the exchange comes back.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A bucket over so many times the mean size is hot, if it is also over HOT_BYTES.
HOT_TIMES = 5
HOT_BYTES = 256 << 20
#: Rows of a bucket at most, about: one task sorts a bucket and holds its groups.
ROWS_PER_BUCKET = 1_000_000
#: Layout of a table, one row.
LAYOUT = "key string, buckets int, table string"


@dataclass(frozen=True)
class Bucketed:
    """A bucketed table: ``schema`` of its rows, ``buckets`` by the hash of ``key`` in ``folder``."""

    folder: str
    key: str
    buckets: int
    schema: T.StructType

    def read(self, spark: SparkSession, hot_bytes: int = HOT_BYTES) -> DataFrame:
        """All rows, by bucket unless one of them is hot."""
        if is_hot(bucket_bytes(spark, self), self.buckets, hot_bytes):
            return spark.read.schema(self.schema).parquet(f"{self.folder}/data")
        return self.by_bucket(spark)

    def by_bucket(self, spark: SparkSession) -> DataFrame:
        """All rows, one partition to a bucket where that saves an exchange."""
        name = _name(self.folder)
        if not spark.catalog.tableExists(name):
            columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in self.schema.fields)
            at = f"{self.folder}/data".replace("'", "\\'")
            spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({_quoted(self.key)}) INTO {self.buckets} BUCKETS LOCATION '{at}'")
        return spark.table(name)


def buckets_for(rows: int) -> int:
    """Number of buckets for tables of which the largest has ``rows`` rows."""
    return max(1, -(-rows // ROWS_PER_BUCKET))


def create(rows: DataFrame, key: str, folder: str, buckets: int) -> Bucketed:
    """Write ``rows`` to a new ``folder`` in ``buckets`` by the hash of ``key`` (null keys in a bucket of their hash too).

    Tables that are joined take the same number of buckets (``buckets_for`` the larger one). Rows are
    brought together by key first, so a bucket is a file or few; a hot key's rows are written by several tasks.
    """
    spark = rows.sparkSession
    folder = folder.rstrip("/")
    name = _name(folder)
    (rows.hint("rebalance", buckets, _quoted(key)).write.format("parquet").option("path", f"{folder}/data")
     .bucketBy(buckets, key).mode("errorifexists").saveAsTable(name))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
    # The layout comes last: a folder without it is a write that did not end.
    spark.createDataFrame([(key, buckets, schema.json())], LAYOUT).coalesce(1).write.parquet(f"{folder}/layout")
    return Bucketed(folder, key, buckets, schema)


def open_table(spark: SparkSession, folder: str) -> Bucketed:
    """The table that ``create`` wrote to ``folder``, in this or an earlier session."""
    folder = folder.rstrip("/")
    row = spark.read.schema(LAYOUT).parquet(f"{folder}/layout").first()
    return Bucketed(folder, row["key"], row["buckets"], T.StructType.fromJson(json.loads(row["table"])))


def bucket_bytes(spark: SparkSession, table: Bucketed) -> dict[int, int]:
    """Bytes of each bucket that has rows, from the file list; no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"{table.folder}/data").select("path", "length")
    bucket = F.regexp_extract("path", r"_(\d+)(?:\.[^/]*)?$", 1).cast("int")
    return {r["bucket"]: r["bytes"] for r in files.groupBy(bucket.alias("bucket")).agg(F.sum("length").alias("bytes")).collect()}


def is_hot(sizes: dict[int, int], buckets: int, hot_bytes: int = HOT_BYTES) -> bool:
    """Whether one bucket is far larger than the mean."""
    top = max(sizes.values(), default=0)
    return top > hot_bytes and top * buckets > HOT_TIMES * sum(sizes.values())


def _name(folder: str) -> str:
    return "ordermill_bucketed_" + hashlib.md5(folder.encode()).hexdigest()


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
