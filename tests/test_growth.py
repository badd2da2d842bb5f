"""Numbers of files and of micro-batches follow the rows; rows that are only numbered stay where they are read."""

import glob

import pytest
from pyspark.sql import functions as F

from ordermill.plans import catalog
from ordermill.sources import sinks

from given_tables import SMOKE


@pytest.fixture()
def scratch(tmp_dir, monkeypatch):
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, name: f"{tmp_dir}/{name}")
    return tmp_dir


def test_places_do_not_move_the_rows(spark, tmp_dir):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = [spark.conf.get(n, None) for n in names]
    try:
        for n in names:
            spark.conf.set(n, "-1")  # as if large
        spark.range(1000).orderBy(F.col("id").desc()).write.parquet(f"{tmp_dir}/sorted")
        placed = sinks.with_place(spark.read.parquet(f"{tmp_dir}/sorted"))
        assert "SortMergeJoin" not in placed._jdf.queryExecution().executedPlan().toString()
        assert sorted((r.place, r.id) for r in placed.collect()) == [(i + 1, 999 - i) for i in range(1000)]
    finally:
        for n, v in zip(names, old):
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def test_a_micro_batch_holds_many_events(spark, scratch):
    spark.range(600).select(F.col("id").alias("page_id")).repartition(9).write.parquet(f"{scratch}/in/pages.parquet")
    rows = catalog.q_stream_manifest(spark, f"{scratch}/in")
    assert len(glob.glob(f"{scratch}/events/landing/*.txt")) == 2  # one a delivery, however many files the pages have
    assert rows.count() == rows.select("bucket", "key", "recipient").distinct().count() > 0


@pytest.mark.parametrize("query, data", [("footer_watermark", "footers/items/run=1"), ("upsert_by_file", "by-file/orders/run=1")])
def test_tables_by_file_have_a_bounded_number_of_files(spark, scratch, monkeypatch, query, data):
    monkeypatch.setattr(catalog, "_BY_FILE_ROWS", 10)
    monkeypatch.setattr(catalog, "_BY_FILE_FILES", 4)
    assert catalog.QUERIES[query](spark, SMOKE).count() > 0
    assert len(glob.glob(f"{scratch}/{data}/data/*.parquet")) <= 4
