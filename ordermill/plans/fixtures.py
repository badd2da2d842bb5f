"""Check inputs with injected faults, derived from the given tables.

Faults are injected by value rules on keys (every row is read and kept), so
the inputs grow with the tables and each rule's count is known to the SQL
oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.plans import shopviews as sv


def dq_lines(spark: SparkSession, d: str) -> DataFrame:
    """Flat order lines with null / zero quantities, missing e-mails and a
    negative price injected."""
    o = sv.shop_order_headers_df(spark, d).select("order_id", "customer_email", "order_total")
    it = sv.shop_items_df(spark, d, with_keys=True)
    j = it.join(o, "order_id", "inner")
    k = F.col("l_orderkey")
    qty = (F.when(k % 101 == 0, F.lit(None)).when(k % 103 == 0, F.lit(0))
           .otherwise(F.col("product_quantity")).cast("smallint"))
    price = F.when(F.substring("product_sku", 3, 7).cast("long") % 97 == 0, F.lit(-1)) \
        .otherwise(F.col("product_price"))
    return j.select(
        "order_id",
        F.when(k % 89 == 0, F.lit(None).cast("string")).otherwise(F.col("customer_email")).alias("customer_email"),
        "order_total", "product_sku", qty.alias("product_quantity"),
        price.cast("decimal(10,2)").alias("product_price"), "l_linenumber")


DQ_LINES_SQL = """
SELECT i.order_id,
       CASE WHEN i.l_orderkey % 89 = 0 THEN NULL ELSE o.customer_email END AS customer_email,
       o.order_total, i.product_sku,
       CAST(CASE WHEN i.l_orderkey % 101 = 0 THEN NULL WHEN i.l_orderkey % 103 = 0 THEN 0
                 ELSE i.product_quantity END AS SMALLINT) AS product_quantity,
       CAST(CASE WHEN CAST(substring(i.product_sku, 3, 7) AS BIGINT) % 97 = 0 THEN -1
                 ELSE i.product_price END AS DECIMAL(10,2)) AS product_price,
       i.l_linenumber
FROM shop_items i JOIN shop_orders o ON i.order_id = o.order_id"""


def bad_orders(spark: SparkSession, d: str) -> DataFrame:
    """Order headers with contract faults: repeated order numbers, over-long
    e-mails, totals beyond NUMERIC(10,2), missing names (already in the view)."""
    o = sv.shop_order_headers_df(spark, d)
    k = F.substring("order_id", 2, 30).cast("long")
    return (o.withColumn("order_number", F.when(k % 211 == 0, F.lit("N0")).otherwise(F.col("order_number")))
             .withColumn("customer_email", F.when(k % 307 == 0, F.concat(F.lit("x" * 90), F.col("customer_email")))
                         .otherwise(F.col("customer_email")))
             .withColumn("order_total", F.when(k % 401 == 0, F.lit(100000000).cast(T.DecimalType(12, 2)))
                         .otherwise(F.col("order_total").cast(T.DecimalType(12, 2)))))


BAD_ORDERS_SQL = f"""
SELECT order_id,
       CASE WHEN o_orderkey % 211 = 0 THEN 'N0' ELSE order_number END AS order_number,
       created_on, modified_on, fulfilled_on,
       CASE WHEN o_orderkey % 307 = 0 THEN '{"x" * 90}' || customer_email ELSE customer_email END AS customer_email,
       customer_name, shipping_city, shipping_state, shipping_country, fulfillment_status,
       discount_total, refund_total,
       CASE WHEN o_orderkey % 401 = 0 THEN CAST(100000000 AS DECIMAL(12,2))
            ELSE CAST(order_total AS DECIMAL(12,2)) END AS order_total
FROM shop_orders"""


def bad_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The five tables with faults: ``bad_orders``, quantities beyond SMALLINT, prices beyond the
    type only after rounding, texts that are no numbers or stamps, over-long names, missing keys."""
    k = F.substring("product_sku", 3, 30).cast("long")
    items = sv.shop_items_df(spark, d, with_keys=True).select(
        "order_id", "product_sku", F.when(k % 19 == 0, F.lit(None)).otherwise(F.col("product_id")).alias("product_id"), "product_name",
        F.when(k % 23 == 0, F.lit(40000)).otherwise(F.col("product_quantity").cast("int")).alias("product_quantity"),
        F.when(k % 29 == 0, "99999999.999").when(k % 31 == 0, "abc").otherwise(F.col("product_price").cast("string")).alias("product_price"), "product_color")
    products = sv.shop_products_df(spark, d).withColumn("product_name", F.when(k % 37 == 0, F.repeat("product_name", 20)).otherwise(F.col("product_name")))
    products = products.withColumn("created_at", F.when(k % 41 == 0, "soon").otherwise("2025-01-01 00:00:00"))
    bom = (sv.shop_bom_df(spark, d).withColumn("is_fabric", F.when(k % 43 == 0, "perhaps").otherwise(F.col("is_fabric").cast("string")))
           .withColumn("material_quantity", F.when(k % 47 == 0, F.lit(-32769)).otherwise(F.col("material_quantity").cast("int"))))
    log = sv.shop_products_df(spark, d).select(
        F.floor(k / 2).cast("long").alias("migration_id"), F.when(k % 53 == 0, F.repeat(F.lit("S"), 51)).otherwise(F.col("product_sku")).alias("old_sku"),
        F.col("product_sku").alias("new_sku"), F.col("modified_at").alias("migration_date"), F.lit(None).cast("string").alias("migration_reason"))
    return {"orders": bad_orders(spark, d), "order_items": items, "products": products, "bill_of_materials": bom, "sku_migration_log": log}


_K = "CAST(substr(product_sku, 3) AS BIGINT)"
BAD_SQL = {
    "orders": BAD_ORDERS_SQL,
    "order_items": f"""
SELECT order_id, product_sku, CASE WHEN {_K} % 19 = 0 THEN NULL ELSE product_id END AS product_id, product_name,
  CASE WHEN {_K} % 23 = 0 THEN 40000 ELSE CAST(product_quantity AS INTEGER) END AS product_quantity,
  CASE WHEN {_K} % 29 = 0 THEN '99999999.999' WHEN {_K} % 31 = 0 THEN 'abc' ELSE CAST(product_price AS VARCHAR) END AS product_price, product_color
FROM shop_items""",
    "products": f"""
SELECT product_sku, product_id, CASE WHEN {_K} % 37 = 0 THEN repeat(product_name, 20) ELSE product_name END AS product_name, product_color,
  CASE WHEN {_K} % 41 = 0 THEN 'soon' ELSE '2025-01-01 00:00:00' END AS created_at, TIMESTAMP '2025-01-01' AS modified_at FROM shop_products""",
    "bill_of_materials": f"""
SELECT product_sku, material_piece, material_color, CASE WHEN {_K} % 47 = 0 THEN -32769 ELSE CAST(material_quantity AS INTEGER) END AS material_quantity,
  CASE WHEN {_K} % 43 = 0 THEN 'perhaps' ELSE CAST(is_fabric AS VARCHAR) END AS is_fabric FROM shop_bom""",
    "sku_migration_log": f"""
SELECT {_K} // 2 AS migration_id, CASE WHEN {_K} % 53 = 0 THEN repeat('S', 51) ELSE product_sku END AS old_sku, product_sku AS new_sku,
  TIMESTAMP '2025-01-01' AS migration_date, CAST(NULL AS VARCHAR) AS migration_reason FROM shop_products""",
}
