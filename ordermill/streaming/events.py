"""The delivery manifest from a stream of storage events (O-73..O-76).

Storage events arrive at least once and in any order. A file is its bucket
and key; its first event makes the manifest rows, further events of it within the
watermark's delay are dropped by the stream's state, and events older than
the watermark are dropped as late, so a replay of any age adds nothing. The
state holds the files of the delay, not all files ever.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.operators.manifest import filter_suffix, parse_storage_events, report_manifest
from ordermill.schemas import STORAGE_EVENT
from ordermill.streaming.files import append_to_parquet

#: How long after the newest event a file's first event may arrive.
DELAY = "7 days"


def stream_events(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Storage events, one JSON text per line of the files below ``path``: ``bucket``, ``key`` of every record and ``event_time``.

    An event without a readable time counts at the time its file was written.
    """
    r = spark.readStream.option("recursiveFileLookup", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    text = r.text(path).select(F.col("value").alias("event"), F.col("_metadata.file_modification_time").alias("arrived"))
    return with_event_time(text)


def with_event_time(events: DataFrame) -> DataFrame:
    """``bucket``, ``key``, ``event_time`` of every record of the event texts (columns ``event``, ``arrived``)."""
    said = F.get(F.from_json("event", STORAGE_EVENT)["Records"], 0)["eventTime"]
    timed = events.withColumn("event_time", F.coalesce(F.try_to_timestamp(said), F.col("arrived")))
    return parse_storage_events(timed, "event", all_records=True).select("bucket", "key", "event_time")


def unique_files(events: DataFrame, delay: str = DELAY) -> DataFrame:
    """The first event of every report file; a stream's state forgets a file after ``delay``."""
    kept = filter_suffix(events, "key")
    if not events.isStreaming:
        return kept.dropDuplicates(["bucket", "key"])
    return kept.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["bucket", "key"])


def manifest_sink(path: str, run_date: _dt.date | str, recipients: str) -> Callable[[DataFrame, int], None]:
    """Batch function: the manifest rows of a micro-batch, in a folder of its own that a replay rewrites."""
    sink = append_to_parquet(path)

    def write(files: DataFrame, batch_id: int) -> None:
        sink(report_manifest(files.drop("event_time"), run_date, recipients), batch_id)
    return write
