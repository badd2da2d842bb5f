"""Report delivery manifest: storage events -> one row per report file and
recipient (O-73..O-76). The mail step itself is out of scope; any mailer can
consume this table."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions import ends_with_ci
from ordermill.schemas import STORAGE_EVENT

# The two escapes the reference decodes, the report suffix, and
# the date formats of the manifest.
KEY_ESCAPES = (("%3A", ":"), ("%2F", "/"))
REPORT_SUFFIX = ".xlsx"
DATE_TEXT_FORMAT = "yyyy-MM-dd"
DISPLAY_FORMAT = "MMMM dd, yyyy"
SUBJECT_PREFIX = "Orders Report - "


def decode_key(key: Column) -> Column:
    """Decode only ``%3A`` and ``%2F`` (D20); ``url_decode`` would also turn
    ``+`` into a space."""
    for enc, dec in KEY_ESCAPES:
        key = F.replace(key, F.lit(enc), F.lit(dec))
    return key


def parse_storage_events(df: DataFrame, col: str = "event", all_records: bool = False) -> DataFrame:
    """(bucket, key) from storage-event JSON text (O-73). By default only the
    first record is read, as in the reference; ``all_records`` explodes all."""
    ev = df.withColumn("_ev", F.from_json(F.col(col), STORAGE_EVENT))
    if all_records:
        ev = ev.withColumn("_rec", F.explode("_ev.Records"))
    else:
        ev = ev.withColumn("_rec", F.get(F.col("_ev.Records"), 0))
    return (ev.select("*", F.col("_rec.s3.bucket.name").alias("bucket"),
                      decode_key(F.col("_rec.s3.object.key")).alias("key"))
            .drop("_ev", "_rec"))


def filter_suffix(df: DataFrame, col: str = "key", suffix: str = REPORT_SUFFIX) -> DataFrame:
    """Keep keys ending with ``suffix``, case-insensitively (O-74)."""
    return df.filter(ends_with_ci(col, suffix))


def report_manifest(events: DataFrame, run_date: _dt.date | str, recipients: str | Column,
                    col: str = "key") -> DataFrame:
    """One row per report file and recipient (O-75, O-76, D27).

    ``report_date`` is parts 1-3 of ``a/YYYY/MM/DD/...`` joined with dashes when
    the key has four or more parts (not validated), else the run date.
    ``display_date`` parses it and falls back to the run date when it is no date.
    """
    run = _dt.date.fromisoformat(str(run_date)[:10])
    run_text = F.lit(run.isoformat())
    parts = F.split(F.col(col), "/")
    report_date = F.when(F.size(parts) >= 4,
                         F.concat_ws("-", F.get(parts, 1), F.get(parts, 2), F.get(parts, 3))
                         ).otherwise(run_text)
    parsed = F.try_to_timestamp(report_date, F.lit("yyyy-M-d"))
    display = F.date_format(F.coalesce(parsed, run_text.cast("timestamp")), DISPLAY_FORMAT)
    rcpt = recipients if isinstance(recipients, Column) else F.lit(recipients)
    out = events.select(
        "*",
        F.element_at(parts, -1).alias("file_name"),
        report_date.alias("report_date"),
        display.alias("display_date"),
        F.concat(F.lit(SUBJECT_PREFIX), report_date).alias("subject"),
        F.explode(F.split(rcpt, ",")).alias("recipient"),
    )
    return out
