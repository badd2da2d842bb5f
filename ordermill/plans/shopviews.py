"""Shop-shaped views over the driver's TPC-H-like tables.

The operators work on order / order-item / product / BOM tables. The test data
is a star schema, so these views re-shape it; each view is derived row by row
from a given table (plus a literal piece list for the BOM), so its size grows
with the data.

``*_df`` builders are the Spark side; ``VIEW_SQL`` holds the same derivations
as SQL text for the DuckDB oracle. They are written independently on purpose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.schemas import DEC
from ordermill.sources.sinks import literal_table

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Material pieces per part type for the test bill of materials.
# PROMO parts get no pieces (products without BOM vanish from the cut list,
# D12); LARGE lists one piece twice (fan-out, D13).
BOM_PIECES = [
    ("STANDARD", "Body panel", "Canvas", 2, True),
    ("STANDARD", "Strap", "Black", 1, False),
    ("MEDIUM", "Body panel", "Canvas", 1, True),
    ("MEDIUM", "Lining", "Natural", 1, True),
    ("ECONOMY", "Pocket", "Canvas", 1, True),
    ("SMALL", "Pouch panel", "Olive", 2, True),
    ("LARGE", "Body panel", "Waxed", 2, True),
    ("LARGE", "Strap", "Black", 1, False),
    ("LARGE", "Strap", "Black", 1, False),
]
BOM_PIECES_SCHEMA = T.StructType([
    T.StructField("p_type", T.StringType(), False),
    T.StructField("material_piece", T.StringType(), False),
    T.StructField("material_color", T.StringType(), False),
    T.StructField("material_quantity", T.ShortType(), False),
    T.StructField("is_fabric", T.BooleanType(), False),
])
CATALOG_STAMP = "2025-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _color(key: F.Column, default: str) -> F.Column:
    m = key % 4
    return (F.when(m == 0, "Red").when(m == 1, "Blue").when(m == 2, "Green").otherwise(default))


def _sku(key: F.Column) -> F.Column:
    return F.concat(F.lit("SQ"), F.lpad(key.cast("string"), 7, "0"))


def shop_orders_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    created = F.timestamp_add("SECOND", k % 86400, F.col("o_orderdate"))
    status = (F.when(F.col("o_orderstatus") == "P",
                     F.when(k % 2 == 0, F.lit("PENDING")).otherwise(F.lit("Pending")))
              .when(F.col("o_orderstatus") == "F", F.lit("FULFILLED"))
              .otherwise(F.lit("CANCELED")))
    return o.select(
        F.concat(F.lit("O"), k.cast("string")).alias("order_id"),
        F.concat(F.lit("N"), k.cast("string")).alias("order_number"),
        created.alias("created_on"),
        F.timestamp_add("DAY", k % 30, created).alias("modified_on"),
        F.when(F.col("o_orderstatus") == "F", F.timestamp_add("DAY", F.lit(7), created)).alias("fulfilled_on"),
        F.concat(F.lit("customer"), F.col("o_custkey").cast("string"), F.lit("@example.com")).alias("customer_email"),
        F.lit("Customer").alias("first_name"),
        F.when(F.col("o_custkey") % 97 != 0, F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("last_name"),
        F.concat(F.lit("City "), (F.col("o_custkey") % 100).cast("string")).alias("shipping_city"),
        F.concat(F.lit("ST"), (F.col("o_custkey") % 50).cast("string")).alias("shipping_state"),
        F.when(F.col("o_custkey") % 3 == 0, "US").when(F.col("o_custkey") % 3 == 1, "CA")
         .otherwise("MX").alias("shipping_country"),
        status.alias("fulfillment_status"),
        F.when(k % 7 == 0, F.lit(5)).otherwise(F.lit(0)).cast(DEC).alias("discount_total"),
        F.when((F.col("o_orderstatus") == "O") & (k % 11 == 0), F.lit(10)).otherwise(F.lit(0))
         .cast(DEC).alias("refund_total"),
        F.col("o_totalprice").cast(DEC).alias("order_total"),
    ).withColumn("customer_name", F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")))


ORDER_HEADER = ["order_id", "order_number", "created_on", "modified_on", "fulfilled_on",
                "customer_email", "customer_name", "shipping_city", "shipping_state",
                "shipping_country", "fulfillment_status", "discount_total", "refund_total",
                "order_total"]


def shop_order_headers_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shop_orders_df(spark, sf_dir).select(*ORDER_HEADER)


def shop_items_df(spark: SparkSession, sf_dir: str, with_keys: bool = False) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    j = li.join(part, li.l_partkey == part.p_partkey, "inner")
    price = (F.col("p_retailprice").cast(DEC) + (F.col("l_linenumber") % 2) * 5).cast(DEC)
    cols = [
        F.concat(F.lit("O"), F.col("l_orderkey").cast("string")).alias("order_id"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("product_id"),
        _sku(F.col("l_partkey")).alias("product_sku"),
        F.col("p_name").alias("product_name"),
        F.col("l_quantity").cast("smallint").alias("product_quantity"),
        price.alias("product_price"),
        _color(F.col("l_partkey"), "Default").alias("product_color"),
    ]
    if with_keys:
        cols += [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_suppkey")]
    return j.select(*cols)


def shop_products_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog from ``part``."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    stamp = F.lit(CATALOG_STAMP).cast("timestamp")
    return p.select(
        _sku(k).alias("product_sku"),
        F.concat(F.lit("P"), k.cast("string")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        _color(k, "Default Color").alias("product_color"),
        stamp.alias("created_at"),
        stamp.alias("modified_at"),
    )


def bom_pieces_df(spark: SparkSession) -> DataFrame:
    return literal_table(spark, BOM_PIECES, BOM_PIECES_SCHEMA)


def unknown_sku(sku: F.Column) -> F.Column:
    """The SKU, or for every seventh part key one that no catalog has."""
    return F.when(F.substring(sku, 3, 7).cast("long") % 7 == 0, F.concat(F.lit("ZZ"), sku)).otherwise(sku)


def shop_bom_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    # The piece list is a literal of a few rows: a proven size bound, so it is broadcast.
    j = p.join(F.broadcast(bom_pieces_df(spark)), "p_type", "inner")
    return j.select(
        _sku(F.col("p_partkey")).alias("product_sku"),
        "material_piece", "material_color", "material_quantity", "is_fabric",
    )


# --- the same views as SQL text (DuckDB oracle) ------------------------------

_BOM_VALUES = ",\n      ".join(
    f"('{t}', '{p}', '{c}', {q}, {'true' if f else 'false'})" for t, p, c, q, f in BOM_PIECES)

VIEW_SQL = {
    "shop_orders": """
  SELECT
    'O' || CAST(o_orderkey AS VARCHAR) AS order_id,
    'N' || CAST(o_orderkey AS VARCHAR) AS order_number,
    o_orderdate + to_seconds(CAST(o_orderkey % 86400 AS BIGINT)) AS created_on,
    o_orderdate + to_seconds(CAST(o_orderkey % 86400 AS BIGINT)) + to_days(CAST(o_orderkey % 30 AS INTEGER)) AS modified_on,
    CASE WHEN o_orderstatus = 'F'
         THEN o_orderdate + to_seconds(CAST(o_orderkey % 86400 AS BIGINT)) + INTERVAL 7 DAY END AS fulfilled_on,
    'customer' || CAST(o_custkey AS VARCHAR) || '@example.com' AS customer_email,
    'Customer' AS first_name,
    CASE WHEN o_custkey % 97 <> 0 THEN lpad(CAST(o_custkey AS VARCHAR), 9, '0') END AS last_name,
    CASE WHEN o_custkey % 97 <> 0 THEN 'Customer ' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') END AS customer_name,
    'City ' || CAST(o_custkey % 100 AS VARCHAR) AS shipping_city,
    'ST' || CAST(o_custkey % 50 AS VARCHAR) AS shipping_state,
    CASE o_custkey % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'CA' ELSE 'MX' END AS shipping_country,
    CASE WHEN o_orderstatus = 'P' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'PENDING' ELSE 'Pending' END
         WHEN o_orderstatus = 'F' THEN 'FULFILLED' ELSE 'CANCELED' END AS fulfillment_status,
    CAST(CASE WHEN o_orderkey % 7 = 0 THEN 5 ELSE 0 END AS DECIMAL(10,2)) AS discount_total,
    CAST(CASE WHEN o_orderstatus = 'O' AND o_orderkey % 11 = 0 THEN 10 ELSE 0 END AS DECIMAL(10,2)) AS refund_total,
    CAST(o_totalprice AS DECIMAL(10,2)) AS order_total,
    o_orderkey
  FROM orders""",
    "shop_items": """
  SELECT
    'O' || CAST(l.l_orderkey AS VARCHAR) AS order_id,
    'P' || CAST(l.l_partkey AS VARCHAR) AS product_id,
    'SQ' || lpad(CAST(l.l_partkey AS VARCHAR), 7, '0') AS product_sku,
    p.p_name AS product_name,
    CAST(l.l_quantity AS SMALLINT) AS product_quantity,
    CAST(CAST(p.p_retailprice AS DECIMAL(10,2)) + (l.l_linenumber % 2) * 5 AS DECIMAL(10,2)) AS product_price,
    CASE l.l_partkey % 4 WHEN 0 THEN 'Red' WHEN 1 THEN 'Blue' WHEN 2 THEN 'Green' ELSE 'Default' END AS product_color,
    l.l_orderkey, l.l_linenumber, l.l_suppkey
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""",
    "shop_products": """
  SELECT
    'SQ' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS product_sku,
    'P' || CAST(p_partkey AS VARCHAR) AS product_id,
    p_name AS product_name,
    CASE p_partkey % 4 WHEN 0 THEN 'Red' WHEN 1 THEN 'Blue' WHEN 2 THEN 'Green' ELSE 'Default Color' END AS product_color,
    p_partkey
  FROM part""",
    "shop_bom": f"""
  SELECT
    'SQ' || lpad(CAST(p.p_partkey AS VARCHAR), 7, '0') AS product_sku,
    m.material_piece, m.material_color,
    CAST(m.material_quantity AS SMALLINT) AS material_quantity, m.is_fabric
  FROM part p JOIN (VALUES
      {_BOM_VALUES}
  ) AS m(p_type, material_piece, material_color, material_quantity, is_fabric)
  ON p.p_type = m.p_type""",
}


def with_views(sql: str, *names: str, extra: tuple[tuple[str, str], ...] = ()) -> str:
    """Prefix a query with the named shop views (and ``extra`` named queries) as CTEs."""
    parts = [f"{n} AS ({VIEW_SQL[n]}\n)" for n in names] + [f"{n} AS ({q}\n)" for n, q in extra]
    return "WITH " + ",\n".join(parts) + "\n" + sql
