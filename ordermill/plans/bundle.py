"""The weekly report set: three reports for one run date (O-09, O-08).

The pending report and the cut list share the pending quantities per product and price, which
are written once; the schedule is a job of its own. Each report is written to its dated folder.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame

from ordermill.operators import reports
from ordermill.session import remove
from ordermill.sources.sinks import write_report, write_staging

# Report names used in folder and file names.
REPORT_NAMES = ("pending_orders", "order_schedule", "cut_list")


def run_report_bundle(orders: DataFrame, items: DataFrame, products: DataFrame, bom: DataFrame,
                      root: str, run_date: _dt.date | str, fmt: str = "csv",
                      zone: str | None = None) -> dict[str, str]:
    """Write the three reports under ``<root>/reports/YYYY/MM/DD/``; returns their paths."""
    spark = items.sparkSession
    work = f"{root.rstrip('/')}/work"
    try:
        base = spark.read.parquet(write_staging(reports.pending_base(orders, items), f"{work}/pending"))
        frames = {
            "pending_orders": reports.pending_from_base(base, ordered=True),
            "order_schedule": reports.order_schedule(orders, items, ordered=True, zone=zone),
            "cut_list": reports.cut_list_from_base(base, products, bom, ordered=True),
        }
        return {name: write_report(df, root, name, run_date, fmt=fmt) for name, df in frames.items()}
    finally:
        remove(spark, work)
