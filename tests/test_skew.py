"""Hot keys: one order (and one SKU) holding a third of all line items."""

from pyspark.sql import functions as F

from ordermill.operators import reports, shape


def _skewed(spark, n=30000):
    ids = spark.range(n)
    # a third of all lines belong to order O0 and SKU S0
    items = ids.select(
        F.when(F.col("id") % 3 == 0, F.lit("O0")).otherwise(F.concat(F.lit("O"), (F.col("id") % 5000).cast("string")))
        .alias("order_id"),
        F.when(F.col("id") % 3 == 0, F.lit("S0")).otherwise(F.concat(F.lit("S"), (F.col("id") % 97).cast("string")))
        .alias("product_sku"),
        # incompressible text, so shuffle sizes follow row counts
        F.sha2(F.col("id").cast("string"), 256).alias("product_name"), F.lit("Red").alias("product_color"),
        F.lit(1).cast("smallint").alias("product_quantity"),
        F.lit(5).cast("decimal(10,2)").alias("product_price"))
    orders = spark.range(5000).select(
        F.concat(F.lit("O"), F.col("id").cast("string")).alias("order_id"),
        F.lit("PENDING").alias("fulfillment_status"),
        F.lit("2025-04-01 10:00:00").cast("timestamp").alias("created_on"))
    return orders, items


def test_hot_order_join_is_split_and_whole(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        orders, items = _skewed(spark)
        sched = reports.order_schedule(orders, items)
        total = sched.agg(F.sum("quantity")).first()[0]
        assert total == 30000  # no row dropped
        sched.collect()
        final = sched._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_keys_combine_before_shuffle(spark):
    orders, items = _skewed(spark)
    pend = reports.pending_orders(orders, items)
    expected = items.filter("product_sku = 'S0'").count()  # every order here is pending
    assert expected > 10000
    assert pend.filter("product_sku = 'S0'").agg(F.sum("quantity")).first()[0] == expected
    plan = pend._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan
    latest = shape.latest_per_key(items.withColumn("ts", F.monotonically_increasing_id()), ["order_id"], ["ts"])
    assert latest.count() == 5000


def test_hot_order_documents_are_bounded_and_whole(spark):
    from ordermill.plans import nested

    _, items = _skewed(spark, n=12000)
    items = items.select("*", F.lit(1).alias("l_linenumber"), F.col("product_name").alias("l_suppkey"),
                         F.concat(F.lit("P"), F.col("product_sku")).alias("product_id"))
    entries = nested.nest_items(items, chunk_items=100)
    stats = entries.groupBy("order_id").agg(F.count(F.lit(1)).alias("entries"),
                                            F.sum(F.size("lineItems")).alias("items"),
                                            F.max(F.size("lineItems")).alias("largest"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",  # as if large
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        entries.collect()  # small test input; runs this DataFrame's own plan
        final = entries._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in final  # the hot order's join partition is split
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    hot = stats.filter("order_id = 'O0'").first()
    n_hot = items.filter("order_id = 'O0'").count()
    assert n_hot > 4000
    assert hot["items"] == n_hot  # every item of the hot order is kept
    assert hot["entries"] == -(-n_hot // 100)  # split into ceil(n / 100) entries
    assert hot["largest"] <= 200  # no entry grows with the order
    assert stats.agg(F.sum("items")).first()[0] == 12000
    assert stats.filter("order_id != 'O0'").agg(F.max("entries")).first()[0] == 1


def test_surrogate_ids_spread_a_hot_sort_key(spark):
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    out = shape.assign_ids(rows, "sid", ["k"], start=1, num_partitions=8)
    stats = out.agg(F.min("sid"), F.max("sid"), F.countDistinct("sid")).first()
    assert tuple(stats) == (1, 30000, 30000)  # dense ids, nothing dropped
    # ids follow the sort key: every hot row (k = 0) comes before every other row
    assert out.filter("k = 0").agg(F.max("sid")).first()[0] == 10000
    biggest = out.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert biggest < 10000  # the hot key is split over several range partitions


def test_dated_write_splits_a_hot_date(spark, tmp_dir):
    import glob

    from ordermill.sources import sinks

    rows = spark.range(30000).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit("2025-04-01"))
        .otherwise(F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 60).cast("int")).cast("string"))
        .cast("date").alias("d"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    # a small advisory size stands in for a large input: the hot date exceeds it
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        path = f"{tmp_dir}/dated"
        sinks.write_partitioned_by_date(rows, path, date_col="d")
        back = spark.read.parquet(path)
        assert back.count() == 30000
        assert back.filter("year = 2025 AND month = 4 AND day = 1").count() == rows.filter("d = '2025-04-01'").count()
        hot_files = glob.glob(f"{tmp_dir}/dated/year=2025/month=04/day=01/*.parquet")
        assert len(hot_files) >= 3  # the hot date (a third of all rows) is written by several tasks
        # other dates stay in few files (a date sharing the hot date's partition may get two)
        normal = [f for f in glob.glob(f"{tmp_dir}/dated/year=*/month=*/day=*/*.parquet")
                  if "month=04/day=01" not in f]
        assert len(normal) <= 2 * 40
        # a rerun of one date replaces only that date (dynamic partition overwrite)
        sinks.write_partitioned_by_date(rows.filter("d = '2025-01-02'"), path, date_col="d")
        assert spark.read.parquet(path).count() == 30000
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_orders_without_items_reduce_a_hot_parent_key(spark):
    from ordermill.operators import contracts

    _, items = _skewed(spark)
    orders = spark.range(6000).select(F.concat(F.lit("O"), F.col("id").cast("string")).alias("order_id"))
    lonely = contracts.fk_orphans(orders, items, ["order_id"], distinct_parent=True)
    expected = orders.join(items.select("order_id").distinct(), "order_id", "left_anti").count()
    assert expected == 1000
    assert lonely.count() == expected
    lonely.collect()
    plan = lonely._jdf.queryExecution().executedPlan().toString()
    # the item keys are aggregated (map-side first) before they reach the anti join
    assert plan.count("HashAggregate(keys=[order_id") >= 2


def test_copies_holding_a_third_collapse_map_side(spark):
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit("copy")).otherwise(F.sha2(F.col("id").cast("string"), 256)).alias("v"))
    out = shape.distinct_rows(rows)
    assert out.count() == 20001  # 20,000 unique rows + one row for the 10,000 copies
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    # a partial aggregate before the exchange: each task ships one row for the copies
    assert plan.count("HashAggregate(keys=[k") >= 2
