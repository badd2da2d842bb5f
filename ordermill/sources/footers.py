"""High-water mark from Parquet footers (O-41).

The largest stamp of a table is in the statistics of its files, so finding it reads no
column: Spark pushes MAX into the Parquet scan. Stamps are asked for as the 64-bit
numbers they are stored as, since Spark pushes no MAX of a timestamp. What the footers say is only
used as a bound: the mark is taken from the rows at or above it, so a file with other
statistics (another unit, none at all) costs a scan and never gives another mark.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.operators import tables
from ordermill.schemas import WATERMARK_FLOOR
from ordermill.sources import keyed

_STAMPS = (T.TimestampType, T.TimestampNTZType)
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)


def footer_max(spark: SparkSession, paths: list[str], schema: T.StructType, column: str) -> DataFrame | None:
    """One row ``top``: MAX of ``column`` out of the footers of ``paths``, stamps as microseconds; None where Spark pushes none.

    ``schema`` is that of the files, in their order. Nested columns and types without a pushed MAX give None.
    """
    kind = schema[column].dataType
    flat = not any(isinstance(f.dataType, T.ArrayType | T.MapType | T.StructType) for f in schema.fields)
    if not flat or not isinstance(kind, _STAMPS + _NUMBERS):
        return None
    stored = T.StructType([T.StructField(f.name, T.LongType() if f.name == column and isinstance(kind, _STAMPS) else f.dataType) for f in schema.fields])
    # The pushed aggregate needs the newer file source; a session of its own leaves the caller's settings alone.
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.schema(stored).parquet(*paths).agg(F.max(f"`{column}`").alias("top"))


def high_watermark(spark: SparkSession, paths: list[str], schema: T.StructType, items: DataFrame | keyed.Version, key: str = "order_id",
                   ts: str = "created_on", default: str = WATERMARK_FLOOR) -> DataFrame:
    """1-row DataFrame ``max_date``, as ``tables.high_watermark`` over the order files ``paths`` gives it.

    The orders at or above the footers' maximum are the only ones read, and only their items are looked up (by file, if
    ``items`` is a keyed table). If none of them has items, or the footers say nothing, all orders are read.
    An empty table, or one without any items, gives ``default``.
    """
    orders = spark.read.schema(schema).parquet(*paths).select(key, ts)
    every = items.read() if isinstance(items, keyed.Version) else items
    kind = schema[ts].dataType
    top = _top(spark, paths, schema, ts)
    if top is not None:
        bound = F.timestamp_micros(F.lit(top)) if isinstance(kind, _STAMPS) else F.lit(top)
        newest = orders.filter(F.col(ts) >= bound.cast(kind))
        # A stamp may be shared by many orders; only those are joined.
        lines = keyed.lookup(items, newest.select(key)) if isinstance(items, keyed.Version) else every
        found = newest.join(lines.select(key), key, "left_semi").agg(F.max(ts).alias("max_date")).first()["max_date"]
        if found is not None:
            return spark.createDataFrame([(found,)], T.StructType([T.StructField("max_date", kind)]))
    return tables.high_watermark(every, orders, key, ts, default)


def _top(spark: SparkSession, paths: list[str], schema: T.StructType, ts: str):
    asked = footer_max(spark, paths, schema, ts)
    if asked is None:
        return None
    try:
        return asked.first()["top"]
    except (Py4JJavaError, PySparkException):
        return None  # files without usable statistics; a file that cannot be read at all fails in the scan
