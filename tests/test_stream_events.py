"""The manifest as a stream: replays and late duplicates add nothing; the batch result is the same."""

import json
import os

from pyspark.sql import functions as F

from ordermill.operators.manifest import report_manifest
from ordermill.streaming import events, files


def _event(key, at="2025-06-30T05:10:00.000Z", bucket="b"):
    return json.dumps({"Records": [{"eventTime": at, "s3": {"bucket": {"name": bucket}, "object": {"key": key, "size": 1}}}]})


def test_replayed_and_late_events_make_one_row_per_file_and_recipient(spark, tmp_dir):
    landing, out = f"{tmp_dir}/landing", f"{tmp_dir}/manifest"
    os.makedirs(landing)

    def deliver(name, *lines):
        with open(f"{landing}/{name}.txt", "w") as f:
            f.write("\n".join(lines) + "\n")
        stream = events.unique_files(events.stream_events(spark, landing, max_files_per_trigger=1))
        files.run_available(stream, events.manifest_sink(out, "2025-06-30", "x@e.com,y@e.com"), f"{tmp_dir}/checkpoint")
        return sorted((r.bucket, r.key, r.recipient) for r in spark.read.parquet(out).collect())

    a, b = "reports%2F2025%2F06%2F30%2Fa.xlsx", "reports/2025/06/30/b.XLSX"
    two = json.dumps({"Records": [json.loads(_event(k))["Records"][0] for k in ("c.xlsx", a, "c.csv")]})
    first = deliver("1", _event(a), _event(a), _event("reports/x.csv"), "no json", "{}", _event(b, bucket="other"))
    assert first == sorted([("b", a.replace("%2F", "/"), r) for r in ("x@e.com", "y@e.com")] + [("other", b, r) for r in ("x@e.com", "y@e.com")])
    second = deliver("2", _event(a, "2025-06-28T00:00:00.000Z"), two, _event(b))  # out of order, another bucket
    assert len(second) == 8 and len(set(second)) == 8
    third = deliver("3", _event("late.xlsx", "2025-08-01T00:00:00.000Z"))  # time goes on past the delay
    assert len(third) == 10
    assert deliver("4", _event(a), _event(b, bucket="other"), two) == third  # an old replay

    text = spark.read.text(landing).select(F.col("value").alias("event"), F.lit(None).cast("timestamp").alias("arrived"))
    batch = report_manifest(events.unique_files(events.with_event_time(text)).drop("event_time"), "2025-06-30", "x@e.com,y@e.com")
    assert sorted((r.bucket, r.key, r.recipient) for r in batch.collect()) == third
