"""Plan properties that matter at scale."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from ordermill.operators import reports, shape
from ordermill.plans import shopviews as sv

from given_tables import SMOKE


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key_limits_before_shuffle(spark):
    ev = sv.table(spark, SMOKE, "events")
    p = _plan(shape.latest_per_key(ev, ["user_id", "event_type"], ["ts"]))
    assert "WindowGroupLimit" in p and "Partial" in p


@pytest.mark.parametrize("name", ["cut_list", "pending_orders", "order_schedule", "flatten_order_lines",
                                  "dq_outcomes", "upsert_orders", "remap_bom_keys"])
def test_no_python_udf(spark, name):
    p = _plan(E.queries()[name](spark, SMOKE))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in p


def test_cut_list_aggregates_items_before_catalog_join(spark):
    o, i = sv.shop_order_headers_df(spark, SMOKE), sv.shop_items_df(spark, SMOKE)
    df = reports.cut_list(o, i, sv.shop_products_df(spark, SMOKE), sv.shop_bom_df(spark, SMOKE))
    opt = df._jdf.queryExecution().optimizedPlan().toString()
    # the plan is printed top down: the aggregate per SKU comes after (below) both catalog joins
    joins = [i for i in range(len(opt)) if opt.startswith("Join Inner", i)]
    per_sku = opt.index("AS sku_quantity")
    assert len([i for i in joins if i < per_sku]) == 2
    assert "Join LeftSemi" in opt and opt.index("Join LeftSemi") > per_sku


@pytest.mark.parametrize("name", ["cut_list", "order_schedule", "order_schedule_catalog", "upsert_orders", "remap_bom_keys", "dq_outcomes", "fk_orphans"])
def test_no_round_robin_exchange(spark, name):
    assert "RoundRobinPartitioning" not in _plan(E.queries()[name](spark, SMOKE))


def test_schedule_is_aggregated_before_the_catalog_join(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only a catalog that can be broadcast is joined earlier
    try:
        opt = E.queries()["order_schedule_catalog"](spark, SMOKE)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert opt.index("Join LeftSemi") < opt.index("Aggregate [")


def test_filters_and_pruning_reach_scan(spark):
    o = sv.shop_order_headers_df(spark, SMOKE)
    df = o.filter(F.col("created_on") < F.lit("1996-01-01").cast("timestamp_ntz")).select("order_id")
    p = _plan(df)
    # the stamp is computed in the view, so only the null checks of its columns reach the scan, in any order
    assert "IsNotNull(o_orderdate)" in p.split("PushedFilters: [")[1].split("]")[0]
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in p


def test_bom_literal_is_broadcast(spark):
    assert "BroadcastHashJoin" in _plan(sv.shop_bom_df(spark, SMOKE))


def test_global_single_partition_only_for_one_row_aggregates(spark):
    p = _plan(E.queries()["high_watermark"](spark, SMOKE))
    assert "SinglePartition" in p  # the 1-row MAX
    p2 = _plan(E.queries()["pending_orders"](spark, SMOKE))
    assert "SinglePartition" not in p2


def test_snapshot_dedup_limits_before_shuffle(spark):
    from ordermill.operators.flatten import flatten_order_lines
    from ordermill.plans import nested

    lines = flatten_order_lines(nested.raw_documents(spark, SMOKE), dedupe="latest_snapshot")
    p = _plan(lines)
    # each map task keeps only its best snapshot per order before the shuffle
    assert "WindowGroupLimit" in p and "Partial" in p
