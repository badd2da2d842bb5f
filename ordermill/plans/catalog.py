"""Registered queries and their SQL oracles.

Each query takes ``(spark, sf_dir)``, reads the given tables through the shop
views, runs library operators, and returns a DataFrame. ``ORACLE`` holds, per
query, SQL text that DuckDB runs on the same parquet tables; it states the
reference semantics directly (plain joins and aggregates), independently of
the Spark-side plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill import schemas
from ordermill.operators import contracts, flatten, manifest, quality, reports, shape, tables
from ordermill.plans import bundle, fixtures, ingest, migration, nested
from ordermill.plans import shopviews as sv
from ordermill.session import scratch_path
from ordermill.sources import bucketed, footers, keyed, raw, retention, sinks, snapshots
from ordermill.streaming import events as event_stream
from ordermill.streaming import files as stream_files
from ordermill.plans.present import present

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = lambda spark, sf_dir: present(fn(spark, sf_dir))
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


# --- reports ------------------------------------------------------------------

_PENDING_KEYS = ("pending_keys", "SELECT order_id FROM shop_orders WHERE upper(fulfillment_status) = 'PENDING'")
_DAYS = ("days", "SELECT order_id, date_trunc('day', created_on) AS ordered_on FROM shop_orders")


@register("cut_list", sv.with_views("""
SELECT b.material_piece, b.material_color, t.product_name, t.product_color,
       CAST(SUM(b.material_quantity) * any_value(t.ordered) AS BIGINT) AS total_material_needed,
       CAST(COUNT(*) * any_value(t.ordered) AS BIGINT) AS total_products_ordered
FROM shop_bom b, totals t
WHERE t.product_sku = b.product_sku
GROUP BY b.product_sku, b.material_piece, b.material_color, t.product_name, t.product_color
""",
    "shop_orders", "shop_items", "shop_products", "shop_bom", extra=(_PENDING_KEYS, ("totals", """
  SELECT product_sku, c.product_name, c.product_color, q.ordered FROM shop_products c
  NATURAL JOIN (SELECT product_sku, SUM(CAST(product_quantity AS BIGINT)) AS ordered FROM shop_items
                WHERE order_id IN (FROM pending_keys) GROUP BY product_sku) q"""))))
def q_cut_list(spark: SparkSession, d: str) -> DataFrame:
    return reports.cut_list(sv.shop_order_headers_df(spark, d), sv.shop_items_df(spark, d),
                            sv.shop_products_df(spark, d), sv.shop_bom_df(spark, d))


@register("pending_orders", sv.with_views("""
SELECT product_sku, product_name, product_color, quantity FROM (
  SELECT product_sku, product_name, product_color, product_price, CAST(SUM(product_quantity) AS BIGINT) AS quantity
  FROM shop_items WHERE order_id IN (FROM pending_keys) GROUP BY 1, 2, 3, 4)
""", "shop_orders", "shop_items", extra=(_PENDING_KEYS,)))
def q_pending_orders(spark: SparkSession, d: str) -> DataFrame:
    return reports.pending_orders(sv.shop_order_headers_df(spark, d), sv.shop_items_df(spark, d))


@register("order_schedule", sv.with_views("""
SELECT CAST(ordered_on AS TIMESTAMP) AS ordered_on, product_sku, product_name, product_color, quantity FROM (
  SELECT ordered_on, product_sku AS product_sku, product_name, product_color, product_price, CAST(SUM(product_quantity) AS BIGINT) AS quantity
  FROM shop_items JOIN days USING (order_id) GROUP BY 1, 2, 3, 4, 5)
""", "shop_orders", "shop_items", extra=(_DAYS,)))
def q_order_schedule(spark: SparkSession, d: str) -> DataFrame:
    return reports.order_schedule(sv.shop_order_headers_df(spark, d), sv.shop_items_df(spark, d))


@register("order_schedule_catalog", sv.with_views("""
SELECT CAST(ordered_on AS TIMESTAMP) AS ordered_on, product_sku, product_name, product_color, quantity FROM (
  SELECT ordered_on, product_sku AS product_sku, product_name, product_color, product_price, CAST(SUM(product_quantity) AS BIGINT) AS quantity
  FROM shop_items JOIN days USING (order_id) WHERE CAST(substr(product_sku, 3) AS BIGINT) % 7 <> 0 GROUP BY 1, 2, 3, 4, 5)
""", "shop_orders", "shop_items", extra=(_DAYS,)))
def q_order_schedule_catalog(spark: SparkSession, d: str) -> DataFrame:
    """Every seventh product of the lines is in no catalog."""
    items = sv.shop_items_df(spark, d)
    return reports.order_schedule(sv.shop_order_headers_df(spark, d), items.withColumn("product_sku", sv.unknown_sku(F.col("product_sku"))),
                                  products=sv.shop_products_df(spark, d))


# --- reports on bucketed tables (O-31, O-32) -----------------------------------------

_BUCKETS = 8  # least number


def _bucketed_shop(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Orders and items written in the same buckets by order and opened again by their folders."""
    root = scratch_path(spark, "bucketed")
    # A bucket is one task of the join, so their number follows the larger table (counted from its footers).
    buckets = max(_BUCKETS, bucketed.buckets_for(sv.table(spark, d, "lineitem").count()))
    bucketed.create(sv.shop_order_headers_df(spark, d), "order_id", f"{root}/orders", buckets)
    bucketed.create(sv.shop_items_df(spark, d), "order_id", f"{root}/items", buckets)
    return bucketed.open_table(spark, f"{root}/orders").read(spark), bucketed.open_table(spark, f"{root}/items").read(spark)


@register("bucketed_pending_orders", ORACLE["pending_orders"])
def q_bucketed_pending_orders(spark: SparkSession, d: str) -> DataFrame:
    """Pending quantities; orders and items meet bucket by bucket."""
    return reports.pending_orders(*_bucketed_shop(spark, d))


@register("bucketed_order_schedule", ORACLE["order_schedule"])
def q_bucketed_order_schedule(spark: SparkSession, d: str) -> DataFrame:
    """Order schedule; orders and items meet bucket by bucket."""
    return reports.order_schedule(*_bucketed_shop(spark, d))


@register("bucketed_cut_list", ORACLE["cut_list"])
def q_bucketed_cut_list(spark: SparkSession, d: str) -> DataFrame:
    """Cut list; pending orders and items meet bucket by bucket, catalog and materials join the totals per SKU."""
    return reports.cut_list(*_bucketed_shop(spark, d), sv.shop_products_df(spark, d), sv.shop_bom_df(spark, d))


# --- flatten and shaping (O-11..O-20, O-04) ---------------------------------------

_FLAT_SQL = """
SELECT o.order_id, o.order_number, o.created_on, o.modified_on, o.fulfilled_on,
       o.customer_email, o.customer_name, o.shipping_city, o.shipping_state, o.shipping_country,
       o.fulfillment_status,
       CAST(o.discount_total AS DOUBLE) AS discount_total,
       CAST(CASE WHEN o.o_orderkey % 13 = 0 THEN 0 ELSE o.refund_total END AS DOUBLE) AS refund_total,
       CAST(o.order_total AS DOUBLE) AS order_total,
       i.product_id, i.product_sku, i.product_name,
       CAST(i.product_quantity AS INTEGER) AS product_quantity,
       CAST(i.product_price AS DOUBLE) AS product_price,
       i.product_color
FROM shop_orders o JOIN shop_items i ON o.order_id = i.order_id"""


@register("flatten_order_lines", sv.with_views(_FLAT_SQL, "shop_orders", "shop_items"))
def q_flatten_order_lines(spark: SparkSession, d: str) -> DataFrame:
    return flatten.flatten_order_lines(nested.landed_documents(spark, d))


@register("flatten_keep_empty", sv.with_views(f"""
SELECT * REPLACE (CAST(product_quantity AS DOUBLE) AS product_quantity) FROM ({_FLAT_SQL}) x
UNION ALL
SELECT o.order_id, o.order_number, o.created_on, o.modified_on, o.fulfilled_on,
       o.customer_email, o.customer_name, o.shipping_city, o.shipping_state, o.shipping_country,
       o.fulfillment_status, CAST(o.discount_total AS DOUBLE),
       CAST(CASE WHEN o.o_orderkey % 13 = 0 THEN 0 ELSE o.refund_total END AS DOUBLE),
       CAST(o.order_total AS DOUBLE),
       NULL, NULL, NULL, CAST(NULL AS DOUBLE), 0.0, 'Default'
FROM shop_orders o WHERE NOT EXISTS (SELECT 1 FROM shop_items i WHERE i.order_id = o.order_id)
""", "shop_orders", "shop_items"))
def q_flatten_keep_empty(spark: SparkSession, d: str) -> DataFrame:
    # product_quantity is null for orders without items; shown as double so
    # that both client libraries map the null the same way
    lines = flatten.flatten_order_lines(nested.landed_documents(spark, d), keep_empty=True)
    return lines.withColumn("product_quantity", F.col("product_quantity").cast("double"))


@register("raw_file_audit", sv.with_views("""
SELECT 'raw/orders/shop_orders_'
         || strftime(TIMESTAMP '2025-01-06 05:04:00' + to_hours(CAST(floor(page / 10) AS BIGINT)), '%m%d%Y_%H%M%S')
         || '.json' AS file,
       'shop_orders_'
         || strftime(TIMESTAMP '2025-01-06 05:04:00' + to_hours(CAST(floor(page / 10) AS BIGINT)), '%m%d%Y_%H%M%S')
         || '.json' AS file_name,
       TIMESTAMP '2025-01-06 05:04:00' + to_hours(CAST(floor(page / 10) AS BIGINT)) AS fetched_at,
       CAST(COUNT(*) AS BIGINT) AS documents,
       CAST(SUM(n) AS BIGINT) AS orders,
       bool_or(n >= 20) AS has_next_page
FROM (SELECT CAST(floor(o_orderkey / 20) AS BIGINT) AS page, COUNT(*) AS n FROM shop_orders GROUP BY 1) p
GROUP BY floor(page / 10)
""", "shop_orders"))
def q_raw_file_audit(spark: SparkSession, d: str) -> DataFrame:
    # every order of the test tables is one entry (at most 7 items, fewer than
    # nested.CHUNK_ITEMS), so entries per page are the orders of the page
    return raw.raw_file_audit(nested.raw_documents(spark, d))


@register("order_headers", sv.with_views("""
SELECT DISTINCT o.order_id, o.order_number, o.created_on, o.modified_on, o.fulfilled_on,
       o.customer_email, o.customer_name, o.shipping_city, o.shipping_state, o.shipping_country,
       o.fulfillment_status,
       CAST(o.discount_total AS DOUBLE) AS discount_total,
       CAST(CASE WHEN o.o_orderkey % 13 = 0 THEN 0 ELSE o.refund_total END AS DOUBLE) AS refund_total,
       CAST(o.order_total AS DOUBLE) AS order_total
FROM shop_orders o JOIN shop_items i ON o.order_id = i.order_id
""", "shop_orders", "shop_items"))
def q_order_headers(spark: SparkSession, d: str) -> DataFrame:
    lines = flatten.flatten_order_lines(nested.landed_documents(spark, d))
    return shape.distinct_rows(shape.order_headers(lines))


@register("order_items", sv.with_views("""
SELECT o.order_id, o.created_on, i.product_id, i.product_sku, i.product_name,
       CAST(i.product_quantity AS INTEGER) AS product_quantity,
       CAST(i.product_price AS DOUBLE) AS product_price, i.product_color
FROM shop_orders o JOIN shop_items i ON o.order_id = i.order_id
""", "shop_orders", "shop_items"))
def q_order_items(spark: SparkSession, d: str) -> DataFrame:
    return shape.order_items(flatten.flatten_order_lines(nested.landed_documents(spark, d)))


# --- de-duplication (O-46, O-47) ----------------------------------------------------

def _lines_with_copies(spark: SparkSession, d: str) -> DataFrame:
    """Line items twice: the second copy equals the first where the line number
    is a multiple of 3 and has a changed quantity elsewhere (exact copies to drop)."""
    li = sv.table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag")
    altered = li.withColumn("l_quantity", F.when(F.col("l_linenumber") % 3 == 0, F.col("l_quantity"))
                            .otherwise(F.col("l_quantity") + 1000))
    return li.unionByName(altered)


@register("distinct_rows", """
SELECT DISTINCT * FROM (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag FROM lineitem
  UNION ALL
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
         CASE WHEN l_linenumber % 3 = 0 THEN l_quantity ELSE l_quantity + 1000 END,
         l_extendedprice, l_returnflag FROM lineitem
) t
""")
def q_distinct_rows(spark: SparkSession, d: str) -> DataFrame:
    return shape.distinct_rows(_lines_with_copies(spark, d))


@register("latest_per_key", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) t
WHERE rn = 1
""")
def q_latest_per_key(spark: SparkSession, d: str) -> DataFrame:
    ev = sv.table(spark, d, "events")
    return shape.latest_per_key(ev, ["user_id", "event_type"], ["ts"], tie_break=[F.col("event_id").desc()])


@register("latest_order_snapshot", sv.with_views("""
SELECT order_id, order_number, created_on, modified_on, fulfillment_status, CAST(order_total AS DOUBLE) AS order_total
FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY modified_on DESC, order_number DESC) AS rn
  FROM (
    SELECT order_id, order_number, created_on, modified_on, fulfillment_status, order_total FROM shop_orders
    UNION ALL
    SELECT order_id, order_number || '-r', created_on, created_on, 'PENDING', order_total FROM shop_orders
  ) s) t
WHERE rn = 1
""", "shop_orders"))
def q_latest_order_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """Two snapshots per order (the current one and the one at creation); the
    latest by ``modified_on`` wins, ties broken by order number (O-47, D3)."""
    o = sv.shop_orders_df(spark, d).select("order_id", "order_number", "created_on", "modified_on",
                                          "fulfillment_status", "order_total")
    first = o.select("order_id", F.concat("order_number", F.lit("-r")).alias("order_number"), "created_on",
                     F.col("created_on").alias("modified_on"), F.lit("PENDING").alias("fulfillment_status"),
                     "order_total")
    return shape.latest_per_key(o.unionByName(first), ["order_id"], ["modified_on"],
                                tie_break=[F.col("order_number").desc()])


@register("assign_ids", sv.with_views("""
SELECT CAST(999 + row_number() OVER (ORDER BY product_sku) AS BIGINT) AS product_key,
       product_sku, product_id, product_name, product_color
FROM shop_products
""", "shop_products"))
def q_assign_ids(spark: SparkSession, d: str) -> DataFrame:
    p = sv.shop_products_df(spark, d).select("product_sku", "product_id", "product_name", "product_color")
    return shape.assign_ids(p, "product_key", ["product_sku"], start=1000)


# --- table changes (O-27, O-35, O-41, O-55..O-63) -----------------------------------

SNAPSHOT_END = "1999-01-01 00:00:00"      # target table = orders known before this time
CHANGES_FROM = "1998-07-01 00:00:00"      # staged batch = orders modified since this time
CHANGE_STAMP = "2025-05-01 00:00:00"      # fixed modification stamp of the migration
_HEADER_SQL = ("order_id, order_number, created_on, modified_on, fulfilled_on, customer_email, customer_name, "
               "shipping_city, shipping_state, shipping_country, fulfillment_status, "
               "CAST(discount_total AS DOUBLE) AS discount_total, CAST(refund_total AS DOUBLE) AS refund_total, "
               "CAST(order_total AS DOUBLE) AS order_total")
_STAGED_SQL = _HEADER_SQL.replace("fulfillment_status,", "'FULFILLED' AS fulfillment_status,")
_UPSERT_CTES = (
    ("base", f"SELECT {_HEADER_SQL} FROM shop_orders WHERE created_on < TIMESTAMP '{SNAPSHOT_END}'"),
    ("staged", f"SELECT {_STAGED_SQL} FROM shop_orders WHERE modified_on >= TIMESTAMP '{CHANGES_FROM}'"),
)


def _base_and_staged(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    o = sv.shop_order_headers_df(spark, d)
    base = o.filter(F.col("created_on") < F.lit(SNAPSHOT_END).cast("timestamp_ntz"))
    staged = (o.filter(F.col("modified_on") >= F.lit(CHANGES_FROM).cast("timestamp_ntz"))
              .withColumn("fulfillment_status", F.lit("FULFILLED")))
    return base, staged


@register("upsert_orders", sv.with_views("""
SELECT * FROM base b WHERE NOT EXISTS (SELECT 1 FROM staged s WHERE s.order_id = b.order_id)
UNION ALL
SELECT * FROM staged
""", "shop_orders", extra=_UPSERT_CTES))
def q_upsert_orders(spark: SparkSession, d: str) -> DataFrame:
    base, staged = _base_and_staged(spark, d)
    return tables.upsert(base, staged, ["order_id"])


@register("upsert_counts", sv.with_views("""
SELECT CAST(SUM(CASE WHEN b.order_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS inserted,
       CAST(SUM(CASE WHEN b.order_id IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS updated,
       CAST(COUNT(*) AS BIGINT) AS affected
FROM staged s LEFT JOIN base b ON s.order_id = b.order_id
""", "shop_orders", extra=_UPSERT_CTES))
def q_upsert_counts(spark: SparkSession, d: str) -> DataFrame:
    base, staged = _base_and_staged(spark, d)
    return tables.upsert_counts(base, staged, ["order_id"])


_ITEMS_TARGET = (
    "target_items",
    f"SELECT i.* FROM shop_items i WHERE EXISTS (SELECT 1 FROM shop_orders o WHERE o.order_id = i.order_id "
    f"AND o.created_on < TIMESTAMP '{SNAPSHOT_END}')")
_HWM_SQL = f"""
SELECT COALESCE(MAX(o.created_on), TIMESTAMP '1900-01-01 00:00:00') AS max_date
FROM shop_orders o
WHERE o.created_on < TIMESTAMP '{SNAPSHOT_END}'
  AND EXISTS (SELECT 1 FROM target_items i WHERE i.order_id = o.order_id)"""


def _target_items(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    base, _ = _base_and_staged(spark, d)
    items = sv.shop_items_df(spark, d)
    return base, items.join(base.select("order_id"), "order_id", "left_semi"), items


@register("high_watermark", sv.with_views(_HWM_SQL, "shop_orders", "shop_items", extra=(_ITEMS_TARGET,)))
def q_high_watermark(spark: SparkSession, d: str) -> DataFrame:
    base, target_items, _ = _target_items(spark, d)
    return tables.high_watermark(target_items, base)


@register("footer_watermark", sv.with_views(_HWM_SQL, "shop_orders", "shop_items", extra=(_ITEMS_TARGET,)))
def q_footer_watermark(spark: SparkSession, d: str) -> DataFrame:
    """The mark from the footers of the written orders; their items are a keyed file table (O-41)."""
    root = scratch_path(spark, "footers")
    base, target_items, _ = _target_items(spark, d)
    base.select("order_id", "created_on").write.parquet(f"{root}/orders")
    items = keyed.create(target_items, "order_id", f"{root}/items/run=1", _rows_per_file(spark, d, "lineitem"))
    return footers.high_watermark(spark, [f"{root}/orders"], base.select("order_id", "created_on").schema, items)


@register("append_since_watermark", sv.with_views(f"""
SELECT i.order_id, i.product_id, i.product_sku, i.product_name, i.product_quantity,
       CAST(i.product_price AS DOUBLE) AS product_price, i.product_color
FROM shop_items i JOIN shop_orders o ON i.order_id = o.order_id
WHERE o.created_on > ({_HWM_SQL})
""", "shop_orders", "shop_items", extra=(_ITEMS_TARGET,)))
def q_append_since_watermark(spark: SparkSession, d: str) -> DataFrame:
    base, target_items, items = _target_items(spark, d)
    orders = sv.shop_order_headers_df(spark, d)
    incoming = items.join(orders.select("order_id", "created_on"), "order_id", "inner")
    return tables.append_since_watermark(incoming, target_items, base)


_CATALOG_SQL = """
SELECT 'SQ' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS product_sku,
       'P' || CAST(p_partkey AS VARCHAR) AS product_id,
       p_name AS product_name,
       CASE p_partkey % 4 WHEN 0 THEN 'Red' WHEN 1 THEN 'Blue' WHEN 2 THEN 'Green' ELSE 'Default Color' END AS product_color,
       TIMESTAMP '2025-01-01 00:00:00' AS created_at, TIMESTAMP '2025-01-01 00:00:00' AS modified_at,
       p_partkey, p_size
FROM part"""
_NEW_PRODUCTS_SQL = f"""
SELECT 'SQ' || lpad(CAST(p_partkey + 1000 AS VARCHAR), 7, '0') AS product_sku,
       'N' || CAST(p_partkey AS VARCHAR) AS product_id,
       p_name || ' (new)' AS product_name,
       CASE WHEN p_partkey % 5 = 0 THEN 'Default Color' ELSE 'Natural' END AS product_color,
       TIMESTAMP '{CHANGE_STAMP}' AS created_at, TIMESTAMP '{CHANGE_STAMP}' AS modified_at
FROM part"""


def _new_products(spark: SparkSession, d: str) -> DataFrame:
    """New catalog rows with shifted SKUs; some collide with existing SKUs and
    some carry no color (the column default applies)."""
    p = sv.table(spark, d, "part")
    k = F.col("p_partkey")
    return p.select(
        F.concat(F.lit("SQ"), F.lpad((k + 1000).cast("string"), 7, "0")).alias("product_sku"),
        F.concat(F.lit("N"), k.cast("string")).alias("product_id"),
        F.concat(F.col("p_name"), F.lit(" (new)")).alias("product_name"),
        F.when(k % 5 != 0, F.lit("Natural")).alias("product_color"))


def _catalog_defaults() -> dict:
    return {c.name: c.default for c in schemas.PRODUCTS.columns if c.default is not None} | {
        "created_at": CHANGE_STAMP, "modified_at": CHANGE_STAMP}


@register("insert_rows_ignore", f"""
WITH catalog AS ({_CATALOG_SQL}), fresh AS ({_NEW_PRODUCTS_SQL})
SELECT product_sku, product_id, product_name, product_color, created_at, modified_at FROM catalog
UNION ALL
SELECT * FROM fresh f WHERE NOT EXISTS (SELECT 1 FROM catalog c WHERE c.product_sku = f.product_sku)
""")
def q_insert_rows_ignore(spark: SparkSession, d: str) -> DataFrame:
    catalog = sv.shop_products_df(spark, d)
    return tables.insert_rows(catalog, _new_products(spark, d), ["product_sku"],
                              defaults=_catalog_defaults(), on_conflict="ignore")


@register("insert_rows_replace", f"""
WITH catalog AS ({_CATALOG_SQL}), fresh AS ({_NEW_PRODUCTS_SQL})
SELECT product_sku, product_id, product_name, product_color, created_at, modified_at FROM catalog c
WHERE NOT EXISTS (SELECT 1 FROM fresh f WHERE c.product_sku = f.product_sku)
UNION ALL
SELECT * FROM fresh
""")
def q_insert_rows_replace(spark: SparkSession, d: str) -> DataFrame:
    catalog = sv.shop_products_df(spark, d)
    return tables.insert_rows(catalog, _new_products(spark, d), ["product_sku"],
                              defaults=_catalog_defaults(), on_conflict="replace")


def _legacy_keys(spark: SparkSession, d: str) -> DataFrame:
    p = sv.table(spark, d, "part")
    return p.filter(F.col("p_size") <= 10).select(
        F.concat(F.lit("SQ"), F.lpad(F.col("p_partkey").cast("string"), 7, "0")).alias("product_sku"))


_LEGACY_SQL = f"""
SELECT product_sku, product_id,
       CASE WHEN p_size <= 10 THEN product_name || ' - V1' ELSE product_name END AS product_name,
       product_color, created_at,
       CASE WHEN p_size <= 10 THEN TIMESTAMP '{CHANGE_STAMP}' ELSE modified_at END AS modified_at
FROM catalog"""


@register("update_where_suffix", f"WITH catalog AS ({_CATALOG_SQL})\n{_LEGACY_SQL}")
def q_update_where_suffix(spark: SparkSession, d: str) -> DataFrame:
    return tables.mark_legacy(sv.shop_products_df(spark, d), _legacy_keys(spark, d), at=CHANGE_STAMP)


def _sku_sql(expr: str) -> str:
    return f"'SQ' || lpad(CAST({expr} AS VARCHAR), 7, '0')"


_MAPPING_SQL = f"""
SELECT {_sku_sql('p_partkey')} AS old_sku, {_sku_sql('p_partkey + 100000')} AS new_sku,
       TIMESTAMP '2025-04-01 00:00:00' AS migration_date, p_partkey
FROM part WHERE p_size <= 25
UNION ALL
SELECT {_sku_sql('p_partkey')}, {_sku_sql('p_partkey + 200000')}, TIMESTAMP '2025-04-02 00:00:00', p_partkey
FROM part WHERE p_size <= 25 AND p_partkey % 2 = 0
UNION ALL
SELECT {_sku_sql('p_partkey')}, {_sku_sql('p_partkey')}, TIMESTAMP '2025-04-03 00:00:00', p_partkey
FROM part WHERE p_size = 1"""


def _mapping(spark: SparkSession, d: str) -> DataFrame:
    """Key-change log derived from the parts: one entry for small parts, a later
    second entry for half of them (repeated old keys), and a latest identity
    entry for the smallest (old = new)."""
    p = sv.table(spark, d, "part")
    k = F.col("p_partkey")

    def sku(e):
        return F.concat(F.lit("SQ"), F.lpad(e.cast("string"), 7, "0"))

    first = p.filter(F.col("p_size") <= 25).select(
        sku(k).alias("old_sku"), sku(k + 100000).alias("new_sku"),
        F.lit("2025-04-01 00:00:00").cast("timestamp").alias("migration_date"))
    second = p.filter((F.col("p_size") <= 25) & (k % 2 == 0)).select(
        sku(k).alias("old_sku"), sku(k + 200000).alias("new_sku"),
        F.lit("2025-04-02 00:00:00").cast("timestamp").alias("migration_date"))
    ident = p.filter(F.col("p_size") == 1).select(
        sku(k).alias("old_sku"), sku(k).alias("new_sku"),
        F.lit("2025-04-03 00:00:00").cast("timestamp").alias("migration_date"))
    return first.unionByName(second).unionByName(ident)


@register("remap_bom_keys", sv.with_views(f"""
SELECT COALESCE(m.new_sku, b.product_sku) AS product_sku, b.material_piece, b.material_color,
       b.material_quantity, b.is_fabric,
       CASE WHEN m.old_sku IS NOT NULL THEN TIMESTAMP '{CHANGE_STAMP}'
            ELSE TIMESTAMP '2025-01-01 00:00:00' END AS modified_at
FROM shop_bom b
LEFT JOIN (SELECT old_sku, new_sku FROM (
             SELECT *, row_number() OVER (PARTITION BY old_sku ORDER BY migration_date DESC, new_sku DESC) AS rn
             FROM mapping) x WHERE rn = 1) m
  ON b.product_sku = m.old_sku
""", "shop_bom", extra=(("mapping", _MAPPING_SQL),)))
def q_remap_bom_keys(spark: SparkSession, d: str) -> DataFrame:
    bom = sv.shop_bom_df(spark, d).withColumn("modified_at", F.lit(sv.CATALOG_STAMP).cast("timestamp"))
    return tables.remap_keys(bom, _mapping(spark, d), at=CHANGE_STAMP)


@register("migration_counts", f"""
WITH catalog AS ({_CATALOG_SQL}), fresh AS ({_NEW_PRODUCTS_SQL}), mapping AS ({_MAPPING_SQL}),
legacy AS ({_LEGACY_SQL}),
merged AS (
  SELECT product_name FROM legacy
  UNION ALL
  SELECT f.product_name FROM fresh f WHERE NOT EXISTS (SELECT 1 FROM legacy c WHERE c.product_sku = f.product_sku))
SELECT 'Legacy products' AS category, CAST(COUNT(*) AS BIGINT) AS count FROM merged WHERE product_name LIKE '% - V1'
UNION ALL
SELECT 'New products', CAST(COUNT(*) AS BIGINT) FROM merged WHERE product_name NOT LIKE '% - V1'
UNION ALL
SELECT 'Migration entries', CAST(COUNT(*) AS BIGINT) FROM mapping
""")
def q_migration_counts(spark: SparkSession, d: str) -> DataFrame:
    legacy = tables.mark_legacy(sv.shop_products_df(spark, d), _legacy_keys(spark, d), at=CHANGE_STAMP)
    merged = tables.insert_rows(legacy, _new_products(spark, d), ["product_sku"],
                                defaults=_catalog_defaults(), on_conflict="ignore")
    return tables.migration_counts(merged, _mapping(spark, d))


@register("append_log_defaults", f"""
SELECT CAST(row_number() OVER (ORDER BY old_sku, new_sku) AS BIGINT) AS migration_id,
       old_sku, new_sku, TIMESTAMP '{CHANGE_STAMP}' AS migration_date,
       COALESCE(reason, 'E-commerce migration') AS migration_reason
FROM (SELECT m.old_sku, m.new_sku,
             CASE WHEN m.p_partkey % 3 = 0 THEN NULL ELSE 'E-commerce migration - ' || p.p_name END AS reason
      FROM ({_MAPPING_SQL}) m JOIN part p ON m.p_partkey = p.p_partkey) x
""")
def q_append_log_defaults(spark: SparkSession, d: str) -> DataFrame:
    """The log that the composed migration publishes: column defaults and serial ids (O-58, O-62, O-63)."""
    p = sv.table(spark, d, "part").select(
        F.concat(F.lit("SQ"), F.lpad(F.col("p_partkey").cast("string"), 7, "0")).alias("old_sku"),
        "p_partkey", "p_name")
    rows = (_mapping(spark, d).join(p, "old_sku", "inner")
            .select("old_sku", "new_sku",
                    F.when(F.col("p_partkey") % 3 != 0,
                           F.concat(F.lit("E-commerce migration - "), F.col("p_name"))).alias("migration_reason")))
    root = scratch_path(spark, "migration")
    migration.publish_seed(spark, root, sv.shop_products_df(spark, d), sv.shop_bom_df(spark, d).withColumn("modified_at", F.lit(sv.CATALOG_STAMP).cast("timestamp")))
    migration.run_migration(root, _legacy_keys(spark, d), _new_products(spark, d), rows, None, "m1", at=CHANGE_STAMP, on_conflict="ignore")
    return snapshots.current(spark, root).read(spark, "log")


@register("migration_published", f"""
WITH catalog AS ({_CATALOG_SQL}), fresh AS ({_NEW_PRODUCTS_SQL})
{_LEGACY_SQL}
UNION ALL SELECT * FROM fresh f WHERE NOT EXISTS (SELECT 1 FROM catalog c WHERE c.product_sku = f.product_sku)
""")
def q_migration_published(spark: SparkSession, d: str) -> DataFrame:
    """The catalog that the composed migration publishes after its counts were checked (O-59, O-60, O-63)."""
    root = scratch_path(spark, "migration")
    catalog, fresh, legacy = sv.shop_products_df(spark, d), _new_products(spark, d), _legacy_keys(spark, d)
    mapping = _mapping(spark, d).select("old_sku", "new_sku", F.lit(None).cast("string").alias("migration_reason"))
    migration.publish_seed(spark, root, catalog, sv.shop_bom_df(spark, d).withColumn("modified_at", F.lit(sv.CATALOG_STAMP).cast("timestamp")))
    n_legacy, n_all = legacy.count(), catalog.join(fresh.select("product_sku"), "product_sku", "full_outer").count()
    expected = {"Legacy products": n_legacy, "New products": n_all - n_legacy, "Migration entries": mapping.count()}
    migration.run_migration(root, legacy, fresh, mapping, expected, "m1", at=CHANGE_STAMP, on_conflict="ignore")
    return snapshots.current(spark, root).read(spark, "products")


# --- data quality and contracts (O-36, O-48..O-52, O-64..O-68) ------------------------

_DQ_SQL = """
WITH m AS (SELECT CAST(COUNT(*) AS DOUBLE) AS n, COUNT(order_id) / n AS has_id, COUNT(customer_email) / n AS has_mail,
    COUNT(product_quantity) / n AS has_quantity, COUNT(product_price) / n AS has_price, COUNT(order_total) / n AS has_total,
    SUM(CASE WHEN product_quantity > 0 THEN 1.0 ELSE 0.0 END) / COUNT(product_quantity) AS quantity_positive,
    SUM(CASE WHEN product_price < 0 THEN 0.0 ELSE 1.0 END) / COUNT(product_price) AS price_not_negative FROM dq_lines)
SELECT rule, CASE WHEN good THEN 'Passed' ELSE 'Failed' END AS outcome, CAST(actual AS DOUBLE) AS actual FROM (
  SELECT 'RowCount > 0' AS rule, n > 0 AS good, n AS actual FROM m
  UNION ALL SELECT 'Completeness "order_id" = 1.0', has_id = 1, has_id FROM m
  UNION ALL SELECT 'Completeness "customer_email" = 1.0', has_mail = 1, has_mail FROM m
  UNION ALL SELECT 'Completeness "product_quantity" = 1.0', has_quantity = 1, has_quantity FROM m
  UNION ALL SELECT 'Completeness "product_price" = 1.0', has_price = 1, has_price FROM m
  UNION ALL SELECT 'Completeness "order_total" = 1.0', has_total = 1, has_total FROM m
  UNION ALL SELECT 'ColumnValues "product_quantity" > 0', quantity_positive = 1, quantity_positive FROM m
  UNION ALL SELECT 'ColumnValues "product_price" >= 0', price_not_negative = 1, price_not_negative FROM m)
"""


_DQ_CTE = (("dq_lines", fixtures.DQ_LINES_SQL),)


@register("dq_outcomes", sv.with_views("SELECT * FROM (" + _DQ_SQL + ")", "shop_orders", "shop_items", extra=_DQ_CTE))
def q_dq_outcomes(spark: SparkSession, d: str) -> DataFrame:
    return quality.evaluate_rules(fixtures.dq_lines(spark, d))


@register("dq_merged_outcomes", ORACLE["dq_outcomes"])
def q_dq_merged_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """The same outcomes merged from the stored states of three runs, each over the lines of some orders; no line is read again (O-48..O-51, O-54)."""
    path = scratch_path(spark, "dq-states")
    lines = fixtures.dq_lines(spark, d)
    for run in range(3):
        quality.append_states(quality.rule_states(lines.filter(F.pmod(F.xxhash64("order_id"), F.lit(3)) == run)), path, f"run-{run}")
    return quality.outcomes_of(quality.read_states(spark, path))


_DQ_ROW_SQL = """
SELECT order_id, product_sku, l_linenumber, CAST(len(f) AS INTEGER) AS n_failed, array_to_string(f, '; ') AS failed
FROM (SELECT *, list_filter([
    CASE WHEN order_id IS NULL THEN 'Completeness "order_id" = 1.0' END,
    CASE WHEN customer_email IS NULL THEN 'Completeness "customer_email" = 1.0' END,
    CASE WHEN product_quantity IS NULL THEN 'Completeness "product_quantity" = 1.0' END,
    CASE WHEN product_price IS NULL THEN 'Completeness "product_price" = 1.0' END,
    CASE WHEN order_total IS NULL THEN 'Completeness "order_total" = 1.0' END,
    CASE WHEN product_quantity <= 0 THEN 'ColumnValues "product_quantity" > 0' END,
    CASE WHEN product_price < 0 THEN 'ColumnValues "product_price" >= 0' END], lambda x: x IS NOT NULL) AS f FROM dq_lines)
"""


@register("dq_row_outcomes", sv.with_views(_DQ_ROW_SQL, "shop_orders", "shop_items", extra=_DQ_CTE))
def q_dq_row_outcomes(spark: SparkSession, d: str) -> DataFrame:
    rows = quality.row_outcomes(fixtures.dq_lines(spark, d))
    return rows.select("order_id", "product_sku", "l_linenumber",
                       F.size("failed_rules").alias("n_failed"),
                       F.array_join("failed_rules", "; ").alias("failed"))


# Written out per table: column -> the longest text, or the declared type; ! marks NOT NULL.
_DECLARED = {
    "orders": "order_id! 50, order_number! 50, created_on! timestamp, modified_on! timestamp, fulfilled_on timestamp, customer_email! 100, customer_name! 100, "
              "shipping_city 100, shipping_state 50, shipping_country 50, fulfillment_status! 20, discount_total! numeric, refund_total! numeric, order_total! numeric",
    "order_items": "order_id! 50, product_sku! 50, product_id! 50, product_name! 255, product_quantity! smallint, product_price! numeric, product_color 255",
    "products": "product_sku! 50, product_id! 50, product_name! 255, product_color! 255, created_at timestamp, modified_at timestamp",
    "bill_of_materials": "product_sku! 50, material_piece! 255, material_color! 50, material_quantity! smallint, is_fabric! boolean",
    "sku_migration_log": "migration_id! bigint, old_sku 50, new_sku 50, migration_date timestamp, migration_reason 255",
}
_MISSING = {"order_items": ["order_item_id"], "bill_of_materials": ["material_id", "created_at", "modified_at"]}
_UNIQUE = {"orders": ["order_id", "order_number"], "products": ["product_sku"], "sku_migration_log": ["migration_id"]}


def _contract_sql() -> str:
    kinds = {"numeric": ("numeric_10_2", "DECIMAL(10,2)"), "smallint": ("type_smallint", "SMALLINT"), "bigint": ("type_bigint", "BIGINT"),
             "boolean": ("type_boolean", "BOOLEAN"), "timestamp": ("type_timestamp", "TIMESTAMP")}
    rows = []

    def add(table: str, check: str, column: str, cond: str) -> None:
        rows.append(f"SELECT '{table}' AS table_name, '{check}' AS \"check\", '{column}' AS column_name, "
                    f"CAST(COUNT(*) FILTER (WHERE {cond}) AS BIGINT) AS violations FROM bad_{table}")

    for table, declared in _DECLARED.items():
        for name, kind in (x.split() for x in declared.split(", ")):
            column = name.rstrip("!")
            if name.endswith("!"):
                add(table, "not_null", column, f"{column} IS NULL")
            if kind.isdigit():
                add(table, f"max_length_{kind}", column, f"length({column}) > {kind}")
            else:
                add(table, kinds[kind][0], column, f"{column} IS NOT NULL AND TRY_CAST(CAST({column} AS VARCHAR) AS {kinds[kind][1]}) IS NULL")
        rows += [f"SELECT '{table}', 'missing_column', '{c}', CAST(1 AS BIGINT)" for c in _MISSING.get(table, [])]
        rows += [f"SELECT '{table}', 'unique', '{k}', CAST(COUNT(*) AS BIGINT) FROM (SELECT {k} FROM bad_{table} GROUP BY {k} HAVING COUNT(*) > 1)"
                 for k in _UNIQUE.get(table, [])]
    return "\nUNION ALL\n".join(rows)


@register("contract_violations", sv.with_views(_contract_sql(), "shop_orders", "shop_items", "shop_products", "shop_bom", extra=tuple(
    (f"bad_{name}", sql) for name, sql in fixtures.BAD_SQL.items())))
def q_contract_violations(spark: SparkSession, d: str) -> DataFrame:
    """All five tables with faults against their contracts, by declared type."""
    out = None
    for name, df in fixtures.bad_tables(spark, d).items():
        contract = schemas.CONTRACTS[name]
        found = contracts.check_contract(df, contract)
        keys = contracts.key_violations(df, contract)
        found = found if keys is None else found.unionByName(keys)
        out = found if out is None else out.unionByName(found)
    return out


@register("fk_orphans", sv.with_views("""
SELECT 'order_items->orders' AS relation, i.order_id AS key_value FROM shop_items i
WHERE NOT EXISTS (SELECT 1 FROM shop_orders o WHERE o.order_id = i.order_id)
UNION ALL
SELECT 'bill_of_materials->products', 'ZZ' || b.product_sku FROM shop_bom b WHERE CAST(substr(b.product_sku, 3) AS BIGINT) % 7 = 0
UNION ALL
SELECT 'orders without items', o.order_id FROM shop_orders o
WHERE NOT EXISTS (SELECT 1 FROM shop_items i WHERE i.order_id = o.order_id)
""", "shop_orders", "shop_items", "shop_products", "shop_bom"))
def q_fk_orphans(spark: SparkSession, d: str) -> DataFrame:
    orders = sv.shop_order_headers_df(spark, d)
    items = sv.shop_items_df(spark, d)
    catalog = sv.shop_products_df(spark, d)
    bom = sv.shop_bom_df(spark, d).withColumn("product_sku", sv.unknown_sku(F.col("product_sku")))

    def tag(df: DataFrame, rel: str, col: str) -> DataFrame:
        return df.select(F.lit(rel).alias("relation"), F.col(col).alias("key_value"))

    return (tag(contracts.fk_orphans(items, orders, ["order_id"]), "order_items->orders", "order_id")
            .unionByName(tag(contracts.fk_orphans(bom, catalog, ["product_sku"]),
                             "bill_of_materials->products", "product_sku"))
            .unionByName(tag(contracts.fk_orphans(orders, items, ["order_id"], distinct_parent=True),
                             "orders without items", "order_id")))


@register("cascade_delete", sv.with_views("""
SELECT i.order_id, i.product_sku, i.product_quantity, CAST(i.product_price AS DOUBLE) AS product_price
FROM shop_items i
WHERE NOT EXISTS (SELECT 1 FROM shop_orders o WHERE o.order_id = i.order_id AND o.fulfillment_status = 'CANCELED')
""", "shop_orders", "shop_items"))
def q_cascade_delete(spark: SparkSession, d: str) -> DataFrame:
    """Items left after deleting canceled orders (ON DELETE CASCADE, O-68)."""
    orders = sv.shop_order_headers_df(spark, d)
    deleted = orders.filter(F.col("fulfillment_status") == "CANCELED")
    items = sv.shop_items_df(spark, d).select("order_id", "product_sku", "product_quantity", "product_price")
    return contracts.cascade_delete(items, deleted, ["order_id"])


# --- delivery manifest (O-73..O-76) ----------------------------------------------------

MANIFEST_RUN_DATE = "2025-06-30"
_EVENTS_PER_FILE = 500_000
RECIPIENTS = "ops@example.com,floor@example.com"
_EVENT_KEY_SQL = """
CASE WHEN page_id % 7 = 0 THEN 'order_reports' || ext
     WHEN page_id % 11 = 0 THEN 'reports%2Flatest%2Fweekly%2Fcurrent%2Forder_reports' || ext
     ELSE 'reports%2F' || strftime(d, '%Y') || '%2F' || strftime(d, '%m') || '%2F' || strftime(d, '%d')
          || '%2Forder_reports_' || strftime(d, '%Y-%m-%d') || 'T05%3A04' || ext END"""


def _storage_events(spark: SparkSession, d: str) -> DataFrame:
    """One storage-event JSON document per page row, naming a report object."""
    p = sv.table(spark, d, "pages").select("page_id")
    pid = F.col("page_id")
    day = F.date_add(F.lit("2025-01-01").cast("date"), pid.cast("int"))
    ext = F.when(pid % 5 == 0, ".csv").when(pid % 5 == 1, ".XLSX").otherwise(".xlsx")
    key = (F.when(pid % 7 == 0, F.concat(F.lit("order_reports"), ext))
           .when(pid % 11 == 0, F.concat(F.lit("reports%2Flatest%2Fweekly%2Fcurrent%2Forder_reports"), ext))
           .otherwise(F.concat(F.lit("reports%2F"), F.date_format(day, "yyyy"), F.lit("%2F"),
                               F.date_format(day, "MM"), F.lit("%2F"), F.date_format(day, "dd"),
                               F.lit("%2Forder_reports_"), F.date_format(day, "yyyy-MM-dd"),
                               F.lit("T05%3A04"), ext)))
    rec = F.struct(
        F.lit("2025-06-30T05:10:00.000Z").alias("eventTime"),
        F.lit("ObjectCreated:Put").alias("eventName"),
        F.struct(F.struct(F.lit("reports-bucket").alias("name")).alias("bucket"),
                 F.struct(key.alias("key"), (pid * 100).alias("size")).alias("object")).alias("s3"))
    return p.select("page_id", F.to_json(F.struct(F.array(rec).alias("Records"))).alias("event"))


@register("report_manifest", f"""
WITH ev AS (
  SELECT page_id, replace(replace({_EVENT_KEY_SQL}, '%3A', ':'), '%2F', '/') AS key
  FROM (SELECT page_id, DATE '2025-01-01' + CAST(page_id AS INTEGER) AS d,
               CASE WHEN page_id % 5 = 0 THEN '.csv' WHEN page_id % 5 = 1 THEN '.XLSX' ELSE '.xlsx' END AS ext
        FROM pages) p),
kept AS (SELECT page_id, key, string_split(key, '/') AS parts FROM ev WHERE lower(key) LIKE '%.xlsx'),
dated AS (
  SELECT page_id, key, parts,
         CASE WHEN len(parts) >= 4 THEN parts[2] || '-' || parts[3] || '-' || parts[4]
              ELSE '{MANIFEST_RUN_DATE}' END AS report_date
  FROM kept)
SELECT page_id, 'reports-bucket' AS bucket, key, parts[len(parts)] AS file_name, report_date,
       strftime(COALESCE(try_strptime(report_date, '%Y-%m-%d'), TIMESTAMP '{MANIFEST_RUN_DATE}'),
                '%B %d, %Y') AS display_date,
       'Orders Report - ' || report_date AS subject,
       unnest(string_split('{RECIPIENTS}', ',')) AS recipient
FROM dated
""")
def q_report_manifest(spark: SparkSession, d: str) -> DataFrame:
    events = manifest.parse_storage_events(_storage_events(spark, d), "event")
    kept = manifest.filter_suffix(events, "key")
    return manifest.report_manifest(kept, MANIFEST_RUN_DATE, RECIPIENTS).drop("event")


@register("stream_manifest", f"""
WITH ev AS (
  SELECT replace(replace({_EVENT_KEY_SQL}, '%3A', ':'), '%2F', '/') AS key
  FROM (SELECT page_id, DATE '2025-01-01' + CAST(page_id AS INTEGER) AS d,
               CASE WHEN page_id % 5 = 0 THEN '.csv' WHEN page_id % 5 = 1 THEN '.XLSX' ELSE '.xlsx' END AS ext
        FROM pages) p),
kept AS (SELECT DISTINCT key, string_split(key, '/') AS parts FROM ev WHERE lower(key) LIKE '%.xlsx'),
dated AS (SELECT key, parts, CASE WHEN len(parts) >= 4 THEN parts[2] || '-' || parts[3] || '-' || parts[4] ELSE '{MANIFEST_RUN_DATE}' END AS report_date FROM kept)
SELECT 'reports-bucket' AS bucket, key, parts[len(parts)] AS file_name, report_date,
       strftime(COALESCE(try_strptime(report_date, '%Y-%m-%d'), TIMESTAMP '{MANIFEST_RUN_DATE}'), '%B %d, %Y') AS display_date,
       'Orders Report - ' || report_date AS subject, unnest(string_split('{RECIPIENTS}', ',')) AS recipient
FROM dated
""")
def q_stream_manifest(spark: SparkSession, d: str) -> DataFrame:
    """The manifest from a stream of events that arrive more than once: one row per file and recipient (O-73..O-76)."""
    root = scratch_path(spark, "events")
    events = _storage_events(spark, d).select(F.col("event").alias("value"))
    # A file is a micro-batch: their number follows the events, not the files that the pages happen to lie in.
    files = -(-sv.table(spark, d, "pages").count() // _EVENTS_PER_FILE)
    for delivery in range(2):  # every event is delivered twice
        events.repartition(max(1, files)).write.mode("append").text(f"{root}/landing")
    stream = event_stream.stream_events(spark, f"{root}/landing", max_files_per_trigger=1)
    stream_files.run_available(event_stream.unique_files(stream), event_stream.manifest_sink(f"{root}/manifest", MANIFEST_RUN_DATE, RECIPIENTS), f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/manifest").drop("batch_id")


# --- sinks, streaming, report set (O-01..O-03, O-08, O-09) -----------------------------

RUN_DATE = "2025-06-30"

@register("date_partitioned_write", sv.with_views("""
SELECT ordered_on, product_sku, product_name, product_color, quantity,
       '2025' AS year, '06' AS month, '30' AS day
FROM (SELECT CAST(CAST(o.created_on AS DATE) AS TIMESTAMP) AS ordered_on,
             oi.product_sku, oi.product_name, oi.product_color,
             CAST(SUM(oi.product_quantity) AS BIGINT) AS quantity
      FROM shop_orders o JOIN shop_items oi ON o.order_id = oi.order_id
      GROUP BY CAST(o.created_on AS DATE), oi.product_sku, oi.product_name, oi.product_color, oi.product_price) s
""", "shop_orders", "shop_items"))
def q_date_partitioned_write(spark: SparkSession, d: str) -> DataFrame:
    """Schedule persisted under year=/month=/day= of the processing date and
    read back (O-03); a rerun of the same date replaces only that partition."""
    sched = reports.order_schedule(sv.shop_order_headers_df(spark, d), sv.shop_items_df(spark, d))
    path = scratch_path(spark, "schedule")
    sinks.write_partitioned_by_date(sched, path, run_date=RUN_DATE)
    schema = T.StructType(sched.schema.fields + [T.StructField(c, T.StringType()) for c in ("year", "month", "day")])
    return spark.read.schema(schema).parquet(path)


@register("dated_write_by_column", sv.with_views("""
SELECT year(ordered_on)::VARCHAR AS year, lpad(month(ordered_on)::VARCHAR, 2, '0') AS month, lpad(day(ordered_on)::VARCHAR, 2, '0') AS day,
  product_sku, CAST(SUM(product_quantity) AS BIGINT) AS quantity
FROM shop_items JOIN days USING (order_id) GROUP BY ordered_on, product_sku, product_name, product_color, product_price
""", "shop_orders", "shop_items", extra=(_DAYS,)))
def q_dated_write_by_column(spark: SparkSession, d: str) -> DataFrame:
    """Schedule persisted under the date of each row and read back (O-03)."""
    sched = reports.order_schedule(sv.shop_order_headers_df(spark, d), sv.shop_items_df(spark, d))
    path = scratch_path(spark, "dated")
    sinks.write_partitioned_by_date(sched, path, date_col="ordered_on")
    schema = T.StructType(sched.schema.fields + [T.StructField(c, T.StringType()) for c in ("year", "month", "day")])
    return spark.read.schema(schema).parquet(path).select("year", "month", "day", "product_sku", "quantity")


_HEADER_SQL = """SELECT DISTINCT order_id, order_number, created_on, modified_on, fulfilled_on, customer_email, customer_name, shipping_city,
  shipping_state, shipping_country, fulfillment_status, discount_total, refund_total, order_total FROM"""
_ITEM_SQL = f"""SELECT order_id, product_id, product_sku, product_name, product_quantity, product_price, product_color
FROM (SELECT DISTINCT * FROM ({_FLAT_SQL}) f) x"""


def _ingested(spark: SparkSession, d: str, max_files: int | None) -> ingest.Tables:
    """The landed files through the composed stream job into new tables."""
    root = scratch_path(spark, "ingest")
    tables_ = ingest.Tables(f"{root}/tables")
    # Customer mails and amounts of the test documents are all there; the rules gate.
    ingest.run_stream(spark, nested.landed(spark, d), tables_, f"{root}/checkpoint", max_files_per_trigger=max_files)
    return tables_


@register("ingest_orders", sv.with_views(f"{_HEADER_SQL} ({_FLAT_SQL}) f", "shop_orders", "shop_items"))
def q_ingest_orders(spark: SparkSession, d: str) -> DataFrame:
    """Orders after a stream run of two files a micro-batch over sub-folders whose files hold orders of all dates (O-01, O-02, O-56)."""
    return ingest.read_orders(spark, _ingested(spark, d, 2))


@register("ingest_items", sv.with_views(_ITEM_SQL, "shop_orders", "shop_items"))
def q_ingest_items(spark: SparkSession, d: str) -> DataFrame:
    """Items of the same run: one high-water mark holds for all its micro-batches (O-55)."""
    return ingest.read_items(spark, _ingested(spark, d, 2)).drop("order_item_id")


@register("ingest_items_one_batch", sv.with_views(_ITEM_SQL, "shop_orders", "shop_items"))
def q_ingest_items_one_batch(spark: SparkSession, d: str) -> DataFrame:
    """Items of a run without a limit of files: the same rows."""
    return ingest.read_items(spark, _ingested(spark, d, None)).drop("order_item_id")


@register("ingest_moved_orders", sv.with_views(f"""
SELECT order_id, CASE WHEN CAST(substr(order_id, 2) AS BIGINT) % 5 = 0 THEN created_on + INTERVAL 45 DAY ELSE created_on END AS created_on,
  modified_on, CASE WHEN CAST(substr(order_id, 2) AS BIGINT) % 5 = 0 THEN 'MOVED' ELSE fulfillment_status END AS fulfillment_status
FROM ({_HEADER_SQL} ({_FLAT_SQL}) f) h""", "shop_orders", "shop_items"))
def q_ingest_moved_orders(spark: SparkSession, d: str) -> DataFrame:
    """Two runs; in the second every fifth order was created 45 days later: each key stays once (O-56)."""
    tables_ = ingest.Tables(scratch_path(spark, "ingest"))
    docs = nested.landed_documents(spark, d)
    ingest.run_batch(docs, tables_, "run-1")

    def moved(o):
        later = F.date_format(F.timestamp_add("DAY", F.lit(45), F.to_timestamp(o["createdOn"])), nested.ISO)
        hit = F.substring(o["id"], 2, 30).cast("long") % 5 == 0
        return (o.withField("createdOn", F.when(hit, later).otherwise(o["createdOn"]))
                .withField("fulfillmentStatus", F.when(hit, "MOVED").otherwise(o["fulfillmentStatus"])))

    ingest.run_batch(docs.withColumn("result", F.transform("result", moved)), tables_, "run-2")
    return ingest.read_orders(spark, tables_).select("order_id", "created_on", "modified_on", "fulfillment_status")


# --- tables kept by file, maintained reports, retention (O-56, O-63, O-69..O-72) ----------

_BY_FILE_ROWS = 4000  # least rows of a file, so that the test tables have several
_BY_FILE_FILES = 100  # files of a table at most, until they reach the library's size


def _rows_per_file(spark: SparkSession, d: str, table: str) -> int:
    """Rows of a file for a table as large as the given one, counted from its footers: larger tables get larger files, as each is a row of the driver's list."""
    return min(keyed.ROWS_PER_FILE, max(_BY_FILE_ROWS, -(-sv.table(spark, d, table).count() // _BY_FILE_FILES)))


_RETURNED_SQL = f"""
SELECT order_id, order_number, created_on + INTERVAL 45 DAY AS created_on, modified_on, fulfilled_on, customer_email, customer_name, shipping_city,
  shipping_state, shipping_country, 'RETURNED' AS fulfillment_status, CAST(discount_total AS DOUBLE) AS discount_total,
  CAST(refund_total AS DOUBLE) AS refund_total, CAST(order_total AS DOUBLE) AS order_total
FROM shop_orders WHERE o_orderkey % 50 = 0"""


@register("upsert_by_file", sv.with_views("""
SELECT * FROM returned
UNION ALL SELECT * FROM staged s WHERE NOT EXISTS (SELECT 1 FROM returned r WHERE r.order_id = s.order_id)
UNION ALL SELECT * FROM base b WHERE NOT EXISTS (SELECT 1 FROM returned r WHERE r.order_id = b.order_id)
  AND NOT EXISTS (SELECT 1 FROM staged s WHERE s.order_id = b.order_id)
""", "shop_orders", extra=(*_UPSERT_CTES, ("returned", _RETURNED_SQL))))
def q_upsert_by_file(spark: SparkSession, d: str) -> DataFrame:
    """Two upserts into a keyed file table; the second moves orders to another date and repeats keys of the first (O-56, O-35)."""
    root = scratch_path(spark, "by-file")
    base, staged = _base_and_staged(spark, d)
    orders = sv.shop_order_headers_df(spark, d)
    returned = (orders.filter(F.substring("order_id", 2, 30).cast("long") % 50 == 0)
                .withColumn("created_on", F.timestamp_add("DAY", F.lit(45), F.col("created_on"))).withColumn("fulfillment_status", F.lit("RETURNED")))

    def written(df: DataFrame, name: str) -> DataFrame:
        return spark.read.parquet(sinks.write_staging(df, f"{root}/{name}"))

    rows_per_file = _rows_per_file(spark, d, "orders")
    version = keyed.create(written(base, "base"), "order_id", f"{root}/orders/run=1", rows_per_file)
    version = keyed.upsert(version, written(staged, "staged"), f"{root}/orders/run=2", rows_per_file)
    return keyed.upsert(version, written(returned, "returned"), f"{root}/orders/run=3", rows_per_file).read()


#: Orders created before this time come with the first run; some of them as they were before they changed.
FIRST_RUN_UNTIL = "1996-01-01T00:00:00"


def _two_runs(spark: SparkSession, d: str) -> ingest.Tables:
    """Two runs that keep the reports: older orders, of which every third was pending and every fourth dated
    differently (so they change groups in the second run), then all orders as they are."""
    tables_ = ingest.Tables(scratch_path(spark, "maintained"), reports=True, rows_per_file=_rows_per_file(spark, d, "lineitem"))
    docs = nested.landed_documents(spark, d)

    def earlier(o):
        key = F.substring(o["id"], 2, 30).cast("long")
        was = F.date_format(F.timestamp_add("DAY", F.lit(-9), F.to_timestamp(o["createdOn"])), nested.ISO)
        return (o.withField("fulfillmentStatus", F.when(key % 3 == 0, "PENDING").when(key % 3 == 1, "OPEN").otherwise(o["fulfillmentStatus"]))
                .withField("createdOn", F.when((key % 4 == 0) & (o["createdOn"] < "1995"), was).otherwise(o["createdOn"])))

    old = F.transform(F.filter("result", lambda o: o["createdOn"] < FIRST_RUN_UNTIL), earlier)
    ingest.run_batch(docs.withColumn("result", old), tables_, "week-1")
    ingest.run_batch(docs, tables_, "week-2")
    return tables_


_LINES = ("lines", f"SELECT DISTINCT * FROM ({_FLAT_SQL}) f")


@register("maintained_pending", sv.with_views("""
SELECT product_sku, product_name, product_color, product_price, CAST(SUM(product_quantity) AS BIGINT) AS quantity
FROM lines WHERE upper(fulfillment_status) = 'PENDING' GROUP BY product_sku, product_name, product_color, product_price
""", "shop_orders", "shop_items", extra=(_LINES,)))
def q_maintained_pending(spark: SparkSession, d: str) -> DataFrame:
    """Pending quantities after two runs, from the stored deltas alone (O-69)."""
    return ingest.read_report(spark, _two_runs(spark, d), "pending")


@register("maintained_schedule", sv.with_views("""
SELECT date_trunc('day', created_on)::TIMESTAMP AS ordered_on, product_sku, product_name, product_color, product_price,
  CAST(SUM(product_quantity) AS BIGINT) AS quantity
FROM lines GROUP BY 1, product_sku, product_name, product_color, product_price
""", "shop_orders", "shop_items", extra=(_LINES,)))
def q_maintained_schedule(spark: SparkSession, d: str) -> DataFrame:
    """Order schedule after two runs, from the deltas as compaction has merged them (O-70)."""
    tables_ = _two_runs(spark, d)
    ingest.compact(spark, tables_, "compact-1")
    return ingest.read_report(spark, tables_, "schedule")


@register("maintained_cut_list", sv.with_views("""
SELECT b.material_piece, b.material_color, t.product_name, t.product_color,
       CAST(SUM(b.material_quantity) * any_value(t.ordered) AS BIGINT) AS total_material_needed,
       CAST(COUNT(*) * any_value(t.ordered) AS BIGINT) AS total_products_ordered
FROM shop_bom b JOIN totals t ON t.product_sku = b.product_sku
GROUP BY b.product_sku, b.material_piece, b.material_color, t.product_name, t.product_color
""", "shop_orders", "shop_items", "shop_products", "shop_bom", extra=(_LINES, ("totals", """
  SELECT c.product_sku, c.product_name, c.product_color, SUM(CAST(l.product_quantity AS BIGINT)) AS ordered
  FROM shop_products c JOIN lines l ON l.product_sku = c.product_sku WHERE upper(l.fulfillment_status) = 'PENDING' GROUP BY 1, 2, 3"""))))
def q_maintained_cut_list(spark: SparkSession, d: str) -> DataFrame:
    """Materials cut list from the maintained pending quantities (O-72)."""
    pending = ingest.read_report(spark, _two_runs(spark, d), "pending")
    return reports.cut_list_from_base(pending, sv.shop_products_df(spark, d), sv.shop_bom_df(spark, d))


@register("retained_items", sv.with_views("""
SELECT order_id, product_id, product_sku, product_name, product_quantity, product_price, product_color FROM lines
""", "shop_orders", "shop_items", extra=(_LINES,)))
def q_retained_items(spark: SparkSession, d: str) -> DataFrame:
    """Items of two runs after compaction, with only the newest pointer's files left (O-63)."""
    tables_ = _two_runs(spark, d)
    ingest.compact(spark, tables_, "compact-1")
    retention.vacuum(spark, tables_.root, keep=1)
    return ingest.read_items(spark, tables_).drop("order_item_id")


@register("ingest_failed_outcomes", sv.with_views("""
SELECT rule, outcome, CAST(actual AS DOUBLE) AS actual FROM (
  SELECT 'RowCount > 0' AS rule, 'Passed' AS outcome, COUNT(*) AS actual FROM l
  UNION ALL SELECT unnest(['Completeness "order_id" = 1.0', 'Completeness "customer_email" = 1.0', 'Completeness "product_quantity" = 1.0',
    'Completeness "product_price" = 1.0', 'Completeness "order_total" = 1.0', 'ColumnValues "product_quantity" > 0',
    'ColumnValues "product_price" >= 0', 'ColumnValues "out_of_range_amounts" = 0']), 'Passed', 1
  UNION ALL SELECT 'ColumnValues "malformed_amounts" = 0', 'Failed', AVG(CASE WHEN o_orderkey % 13 = 0 THEN 0.0 ELSE 1.0 END) FROM l
  UNION ALL SELECT 'ColumnValues "corrupt_record" = null', 'Passed', 0)
""", "shop_orders", "shop_items", extra=(("l", "SELECT o.o_orderkey FROM shop_orders o JOIN shop_items i ON o.order_id = i.order_id"),)))
def q_ingest_failed_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """The published outcomes of a run that the gate stops (every thirteenth order has a malformed amount) (O-30, O-53, O-54)."""
    tables_ = ingest.Tables(scratch_path(spark, "ingest"))
    try:
        ingest.run_batch(nested.landed_documents(spark, d), tables_, "run-1", report_only=())
    except quality.DataQualityError:
        return quality.read_outcomes(spark, tables_.outcomes).select("rule", "outcome", "actual")
    raise AssertionError("the gate let a failing run pass")


@register("stream_ingest", sv.with_views(_FLAT_SQL, "shop_orders", "shop_items"))
def q_stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    """The landed files picked up by the file stream (checkpointed), flattened per micro-batch and
    appended idempotently; the appended table is read back (O-02, O-01)."""
    root = scratch_path(spark, "stream")
    stream = stream_files.stream_raw_orders(spark, nested.landed(spark, d), max_files_per_trigger=4)
    sink = stream_files.append_to_parquet(f"{root}/flat")
    stream_files.run_available(stream, lambda df, batch_id: sink(flatten.flatten_order_lines(df), batch_id), f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/flat").drop("batch_id")


@register("report_bundle", sv.with_views("""
SELECT 'pending_orders' AS report, row_number() OVER (ORDER BY product_price DESC, product_sku, product_name, product_color) AS place,
  product_sku AS label, CAST(SUM(product_quantity) AS BIGINT) AS quantity
FROM shop_items WHERE order_id IN (FROM pending_keys) GROUP BY product_sku, product_name, product_color, product_price
UNION ALL
SELECT 'order_schedule', row_number() OVER (ORDER BY ordered_on, product_price DESC, product_sku, product_name, product_color),
  strftime(ordered_on, '%Y-%m-%d') || ' ' || product_sku, CAST(SUM(product_quantity) AS BIGINT)
FROM shop_items JOIN days USING (order_id) GROUP BY ordered_on, product_sku, product_name, product_color, product_price
UNION ALL
SELECT 'cut_list', row_number() OVER (ORDER BY b.material_piece, b.material_color, t.product_name, t.product_color, t.product_sku),
  b.material_piece || ' ' || b.material_color || ' ' || t.product_name, CAST(SUM(b.material_quantity) * any_value(t.ordered) AS BIGINT)
FROM shop_bom b JOIN (
  SELECT c.product_sku, c.product_name, c.product_color, SUM(CAST(i.product_quantity AS BIGINT)) AS ordered
  FROM shop_products c JOIN shop_items i ON c.product_sku = i.product_sku WHERE i.order_id IN (FROM pending_keys) GROUP BY 1, 2, 3) t
  ON b.product_sku = t.product_sku
GROUP BY b.material_piece, b.material_color, t.product_name, t.product_color, t.product_sku
""", "shop_orders", "shop_items", "shop_products", "shop_bom", extra=(_PENDING_KEYS, _DAYS)))
def q_report_bundle(spark: SparkSession, d: str) -> DataFrame:
    """The three reports as dated files, read back row by row with their place in the report (O-08, O-09, O-43..O-45)."""
    paths = bundle.run_report_bundle(sv.shop_order_headers_df(spark, d), sv.shop_items_df(spark, d), sv.shop_products_df(spark, d), sv.shop_bom_df(spark, d),
                                     scratch_path(spark, "reports"), RUN_DATE, fmt="parquet")
    shown = {"pending_orders": (F.col("product_sku"), "quantity"),
             "order_schedule": (F.concat_ws(" ", F.date_format("ordered_on", "yyyy-MM-dd"), "product_sku"), "quantity"),
             "cut_list": (F.concat_ws(" ", "material_piece", "material_color", "product_name"), "total_material_needed")}
    out = None
    for name, (label, quantity) in shown.items():
        rows = sinks.with_place(spark.read.parquet(paths[name]))
        rows = rows.select(F.lit(name).alias("report"), "place", label.alias("label"), F.col(quantity).cast("bigint").alias("quantity"))
        out = rows if out is None else out.unionByName(rows)
    return out
