"""Row shaping: header/item projections, de-duplication, surrogate ids
(O-17..O-20, O-46, O-47, O-58)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.functions import parse_ts
from ordermill.schemas import ITEM_COLUMNS, ORDER_COLUMNS

_TS_COLS = ("created_on", "modified_on", "fulfilled_on")


def _as_ts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cast text stamps to timestamps; columns that already hold timestamps stay (O-19)."""
    out = df
    for c in cols:
        if c in df.columns and dict(df.dtypes)[c] == "string":
            out = out.withColumn(c, parse_ts(c))
    return out


def order_headers(lines: DataFrame) -> DataFrame:
    """The 14 order columns of flat lines (O-17)."""
    return _as_ts(lines.select(*ORDER_COLUMNS), _TS_COLS)


def order_items(lines: DataFrame) -> DataFrame:
    """The line-item columns, with ``created_on`` carried for the watermark (O-18)."""
    return _as_ts(lines.select(*ITEM_COLUMNS), ("created_on",))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Drop fully identical rows (O-46). A hash aggregate on all columns with a
    map-side partial step, so copies of one row meet before the shuffle."""
    return df.dropDuplicates()


def _order_exprs(order_by: Sequence[Column | str]) -> list[Column]:
    return [F.col(c).desc() if isinstance(c, str) else c for c in order_by]


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str],
                   tie_break: Sequence[Column | str] = ()) -> DataFrame:
    """Keep one row per key: the first by ``order_by`` (strings mean descending),
    then ``tie_break`` (O-47, D3).

    ``row_number() = 1`` lets Catalyst insert a partial WindowGroupLimit before
    the shuffle: each map task keeps only its best row per key, so a key with a
    third of all rows ships one row per task, not its whole group.
    """
    w = Window.partitionBy(*keys).orderBy(*_order_exprs(order_by), *tie_break)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def assign_ids(df: DataFrame, id_col: str, order_by: Sequence[Column | str],
               start: int = 1, num_partitions: int | None = None, path: str | None = None) -> DataFrame:
    """Dense surrogate ids ``start, start+1, ...`` in ``order_by`` order (O-58).

    No single-partition window: rows are range-partitioned on the order keys,
    sorted inside each partition and numbered by position; a partition's
    offset is the number of rows in the partitions before it. The numbered
    rows are checkpointed once (reliable checkpoint in the shared
    ``spark.checkpoint.dir``), so the counts and the rows come from the same
    materialized partitioning even if executors are lost; a second range
    shuffle would sample its own bounds. The offsets table has one row per
    partition (a proven bound), so it is broadcast.

    Rows with equal ``order_by`` values are ordered by a hash of their whole
    content, so a value held by a third of all rows is spread over many range
    partitions instead of landing in one task, and ties get repeatable ids.
    The tie-breaker is deterministic on purpose: a position-based one would
    let a recomputed map task (after an executor loss) route rows to other
    range partitions. Rows identical in every column cannot be told apart and
    stay in one range partition; reduce copies with ``distinct_rows`` first
    when they are not meant to get ids of their own.

    With ``path`` the sorted rows are written there as Parquet, a file per partition, and a row's
    number is its place in the files: compressed, where a checkpoint holds the rows as they are in memory.
    """
    from ordermill.session import shared_dir

    spark = df.sparkSession
    shared_dir(spark)
    hashable = [F.col(f.name) for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    tied = df.select("*", F.xxhash64(*hashable).alias("_tie_h"))
    order = [F.col(c) if isinstance(c, str) else c for c in order_by] + [F.col("_tie_h")]
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = tied.repartitionByRange(n, *order).sortWithinPartitions(*order).drop("_tie_h")
    if path is not None:
        from ordermill.sources.sinks import with_place, write_staging

        write_staging(ranged, path, compression="zstd")
        return with_place(spark.read.schema(df.schema).parquet(path), id_col).withColumn(id_col, F.col(id_col) + F.lit(start - 1))
    mid = F.monotonically_increasing_id()
    numbered = ranged.select("*", F.shiftright(mid, 33).alias("_part"),
                             mid.bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos")).checkpoint(eager=True)
    counts = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_part",
        F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"))
    out = numbered.join(F.broadcast(offsets), "_part", "inner")
    return out.withColumn(id_col, F.lit(start) + F.col("_off") + F.col("_pos")).drop("_part", "_pos", "_off")
