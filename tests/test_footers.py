"""The high-water mark out of file footers: no column is read, and the mark is always that of the full join."""

import pytest
from pyspark.sql import functions as F

from ordermill.operators import tables
from ordermill.schemas import WATERMARK_FLOOR
from ordermill.sources import footers, keyed

ORDERS = "order_id string, n int, created_on timestamp_ntz"


def _orders(spark, n=1000):
    return spark.range(n).select(F.concat(F.lit("O"), "id").alias("order_id"), F.col("id").cast("int").alias("n"),
                                 F.timestamp_micros(F.col("id") * 1_000_003).cast("timestamp_ntz").alias("created_on"))


def _put(df, path):
    df.repartition(4).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _items(orders, where="true"):
    return orders.filter(where).select("order_id", F.lit("sku").alias("product_sku"))


def _both(spark, path, orders, items):
    got = footers.high_watermark(spark, [path], orders.schema, items).first()["max_date"]
    want = tables.high_watermark(items.read() if isinstance(items, keyed.Version) else items, orders).first()["max_date"]
    assert got == want
    return got


def test_no_column_is_scanned(spark, tmp_dir):
    orders = _put(_orders(spark), f"{tmp_dir}/o")
    asked = footers.footer_max(spark, [f"{tmp_dir}/o"], orders.schema, "created_on")
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(created_on)]" in plan and "ReadSchema: struct<max(created_on):bigint>" in plan
    assert asked.first()["top"] == 999 * 1_000_003
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown", "false") == "false"


@pytest.mark.parametrize("where", ["true", "n <> 999", "n < 10", "n % 7 = 3", "false"])
def test_mark_equals_the_join(spark, tmp_dir, where):
    """Newest orders without items move the mark down, whatever the footers say."""
    orders = _put(_orders(spark), f"{tmp_dir}/o")
    _both(spark, f"{tmp_dir}/o", orders, _items(orders, where))


def test_empty_tables_give_the_floor(spark, tmp_dir):
    orders = _put(_orders(spark, 0), f"{tmp_dir}/o")
    floor = _both(spark, f"{tmp_dir}/o", orders, _items(orders))
    assert str(floor).startswith(WATERMARK_FLOOR[:10])


def test_null_and_repeated_stamps(spark, tmp_dir):
    rows = _orders(spark).withColumn("created_on", F.when(F.col("n") % 5 > 0, F.date_trunc("minute", "created_on").cast("timestamp_ntz")))
    orders = _put(rows, f"{tmp_dir}/o")
    assert _both(spark, f"{tmp_dir}/o", orders, _items(orders, "n < 970")) is not None
    nothing = _put(rows.withColumn("created_on", F.lit(None).cast("timestamp_ntz")), f"{tmp_dir}/nulls")
    _both(spark, f"{tmp_dir}/nulls", nothing, _items(nothing))


@pytest.mark.parametrize("unit", ["INT96", "TIMESTAMP_MILLIS", "TIMESTAMP_MICROS"])
def test_files_of_other_stamp_types(spark, tmp_dir, unit):
    """Statistics that are missing or in another unit cost a scan and give the same mark."""
    name = "spark.sql.parquet.outputTimestampType"
    old = spark.conf.get(name)
    spark.conf.set(name, unit)
    try:
        orders = _put(_orders(spark).withColumn("created_on", F.date_trunc("second", "created_on").cast("timestamp")), f"{tmp_dir}/o")
    finally:
        spark.conf.set(name, old)
    _both(spark, f"{tmp_dir}/o", orders, _items(orders, "n <> 998"))


def test_nested_columns_are_not_asked(spark, tmp_dir):
    orders = _put(_orders(spark).withColumn("tags", F.array("order_id")), f"{tmp_dir}/o")
    assert footers.footer_max(spark, [f"{tmp_dir}/o"], orders.schema, "created_on") is None
    _both(spark, f"{tmp_dir}/o", orders, _items(orders))


def test_items_of_a_keyed_table_are_looked_up_by_file(spark, tmp_dir, monkeypatch):
    orders = _put(_orders(spark), f"{tmp_dir}/o")
    items = keyed.create(_put(_items(orders), f"{tmp_dir}/i"), "order_id", f"{tmp_dir}/items/run=1", rows_per_file=100)
    asked = []
    monkeypatch.setattr(footers.keyed, "holding", lambda v, k, real=keyed.holding: asked.append(real(v, k)) or asked[-1])
    _both(spark, f"{tmp_dir}/o", orders, items)
    assert len(asked) == 1 and len(asked[0]) == 1 < len(items.paths())
