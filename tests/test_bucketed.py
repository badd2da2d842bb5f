"""Bucketed tables: joins by bucket without an exchange, equal rows whichever way they are read."""

import pytest
from pyspark.sql import functions as F

from ordermill.operators import reports
from ordermill.plans import shopviews as sv
from ordermill.sources import bucketed

from given_tables import SMOKE


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("bucketed"))
    orders = bucketed.create(sv.shop_order_headers_df(spark, SMOKE), "order_id", f"{root}/orders", 4)
    items = bucketed.create(sv.shop_items_df(spark, SMOKE), "order_id", f"{root}/items", 4)
    return orders, items


@pytest.fixture()
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = [spark.conf.get(n, None) for n in names]
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, v in zip(names, old):
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


@pytest.mark.parametrize("report", [reports.pending_orders, reports.order_schedule])
def test_no_exchange_below_the_join(spark, shop, no_broadcast, report):
    """The groups are exchanged once; orders and items meet bucket by bucket."""
    orders, items = (t.read(spark) for t in shop)
    p = _plan(report(orders, items))
    assert p.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in p
    join = p.index("SortMergeJoin")
    assert "Exchange" not in p[join:]
    plain = _plan(report(*(spark.read.schema(t.schema).parquet(f"{t.folder}/data") for t in shop)))
    assert plain.count("Exchange hashpartitioning") == 3


def test_rows_and_reports_are_those_of_the_plain_tables(spark, shop):
    orders, items = (t.read(spark) for t in shop)
    o, i = sv.shop_order_headers_df(spark, SMOKE), sv.shop_items_df(spark, SMOKE)
    assert _rows(orders.select(*o.columns)) == _rows(o) and _rows(items.select(*i.columns)) == _rows(i)
    assert _rows(reports.pending_orders(orders, items)) == _rows(reports.pending_orders(o, i))


def test_a_table_is_opened_by_its_folder(spark, shop):
    again = bucketed.open_table(spark, shop[1].folder)
    assert again == shop[1]
    spark.sql(f"DROP TABLE {bucketed._name(again.folder)}")  # another session knows no name; the files stay
    assert again.read(spark).count() == sv.shop_items_df(spark, SMOKE).count()
    assert set(bucketed.bucket_bytes(spark, again)) == {0, 1, 2, 3}


def test_a_hot_bucket_is_read_as_plain_files(spark, tmp_dir, no_broadcast):
    """A third of all lines in one order: the join is cut by AQE instead of read by one task."""
    lines = spark.range(30000).select(F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("O"), F.col("id"))).alias("order_id"), F.col("id").alias("n"))
    table = bucketed.create(lines, "order_id", f"{tmp_dir}/hot", 32)
    sizes = bucketed.bucket_bytes(spark, table)
    assert not bucketed.is_hot(sizes, 32) and bucketed.is_hot(sizes, 32, hot_bytes=1000)
    keys = lines.select("order_id").distinct()
    by_bucket = table.read(spark).join(keys, "order_id", "left_semi")
    plain = table.read(spark, hot_bytes=1000)
    assert "Bucketed: true" in _plan(by_bucket) and "Bucketed: true" not in _plan(plain.join(keys, "order_id", "left_semi"))
    assert _rows(plain) == _rows(table.by_bucket(spark)) == _rows(lines)


def test_null_keys_odd_names_and_empty_tables(spark, tmp_dir):
    rows = spark.createDataFrame([(None, 1), ("a", 2), ("a", 3), ("", None)], "`k.e y` string, `b``c` int")
    table = bucketed.create(rows, "k.e y", f"{tmp_dir}/odd", 3)
    assert _rows(bucketed.open_table(spark, table.folder).read(spark)) == _rows(rows)
    empty = bucketed.create(rows.limit(0), "k.e y", f"{tmp_dir}/none", 3)
    assert empty.read(spark).count() == 0 and empty.read(spark).columns == rows.columns


def test_more_rows_get_more_buckets(spark, monkeypatch):
    """A bucket is one task, so it must not grow with the table."""
    from ordermill.plans import catalog

    assert [bucketed.buckets_for(n) for n in (0, 1, 1_000_000, 1_000_001, 216_000_000)] == [1, 1, 1, 2, 216]
    monkeypatch.setattr(bucketed, "ROWS_PER_BUCKET", 500)
    made = []
    real = bucketed.create
    monkeypatch.setattr(bucketed, "create", lambda rows, key, folder, buckets: made.append(buckets) or real(rows, key, folder, buckets))
    got = reports.order_schedule(*catalog._bucketed_shop(spark, SMOKE))
    n = sv.table(spark, SMOKE, "lineitem").count()
    assert made == [-(-n // 500)] * 2 and made[0] > catalog._BUCKETS
    assert _rows(got) == _rows(reports.order_schedule(sv.shop_order_headers_df(spark, SMOKE), sv.shop_items_df(spark, SMOKE)))
