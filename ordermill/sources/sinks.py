"""Table sinks and small literal sources (O-03, O-05, O-06, O-08, O-10).

Writes go to Parquet (or CSV for reports) directories. A file-based target is
written as a whole new directory and never rewritten in place: overwriting the
Parquet path being read fails (D19), so table changes go through
``ordermill.sources.snapshots``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_table(spark: SparkSession, rows: Sequence[Sequence], schema: T.StructType) -> DataFrame:
    """Small reference table from literal rows (O-10). Only for rows written in
    code; its size is bounded by the literal, so joins may broadcast it."""
    return spark.createDataFrame(list(rows), schema)


def write_staging(df: DataFrame, path: str, fmt: str = "parquet", **options) -> str:
    """Overwrite a staging table (O-05); ``options`` of the writer, as ``compression``."""
    df.write.mode("overwrite").format(fmt).options(**options).save(path)
    return path


def append_rows(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Append rows to a target table (O-06)."""
    df.write.mode("append").format(fmt).save(path)
    return path


def with_date_parts(df: DataFrame, date_col: Column | str | None = None,
                    run_date: _dt.date | str | None = None) -> DataFrame:
    """Add ``year``/``month``/``day`` partition columns from a column or a run date."""
    if date_col is not None:
        d = F.to_date(F.col(date_col) if isinstance(date_col, str) else date_col)
    else:
        # without a run date: the session's current day (the session is in UTC)
        d = F.current_date() if run_date is None else F.lit(str(run_date)).cast("date")
    return (df.withColumn("year", F.date_format(d, "yyyy"))
              .withColumn("month", F.date_format(d, "MM"))
              .withColumn("day", F.date_format(d, "dd")))


def write_partitioned_by_date(df: DataFrame, path: str, date_col: str | None = None,
                              run_date: _dt.date | str | None = None, fmt: str = "parquet") -> str:
    """Persist rows under ``year=/month=/day=`` folders (O-03).

    Dynamic partition overwrite replaces only the dates present in ``df``, so a
    rerun of one day is idempotent. With a date column the rows are
    rebalanced on the date (``REBALANCE`` hint): each task writes few date
    folders, and AQE splits a date holding a large share of all rows into
    advisory-sized pieces written by several tasks (and merges small ones).
    Unlike a range repartition it needs no sampling pass over the input.
    """
    parted = with_date_parts(df, date_col, run_date)
    if date_col is not None:
        parted = parted.hint("rebalance", "year", "month", "day")
    (parted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("year", "month", "day").format(fmt).save(path))
    return path


def report_path(root: str, name: str, run_date: _dt.date | str) -> str:
    """``<root>/reports/YYYY/MM/DD/<name>_<YYYY-MM-DD>`` (O-08)."""
    d = _dt.date.fromisoformat(str(run_date)[:10])
    return f"{root.rstrip('/')}/reports/{d:%Y}/{d:%m}/{d:%d}/{name}_{d:%Y-%m-%d}"


def write_report(df: DataFrame, root: str, name: str, run_date: _dt.date | str,
                 fmt: str = "csv", sort_cols: Iterable | None = None) -> str:
    """Write one report to its dated folder (O-08).

    With ``sort_cols`` the rows are range-partitioned and sorted by them, so
    the part files read in order; no single-partition step is needed.
    """
    out = report_path(root, name, run_date)
    if sort_cols:
        df = df.orderBy(*sort_cols)
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    w.save(out)
    return out


def with_place(written: DataFrame, name: str = "place") -> DataFrame:
    """Rows of a sorted Parquet folder with ``place`` (or ``name``), their number (from 1) in it.

    A file's rows follow those of the files before it by name; the counts per file
    are one row per write task.
    """
    rows = written.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1))
    files = files.select("_file", F.coalesce(before, F.lit(0)).alias("_before"))
    # One row per write task, so the rows stay where they are read.
    return rows.join(F.broadcast(files), "_file").withColumn(name, F.col("_before") + F.col("_row") + 1).drop("_file", "_row", "_before")
