"""Production reports: pending orders, order schedule, materials cut list (O-69..O-72).

Plan shape, chosen for large inputs:

* The status filter runs on ``orders`` before the join and only ``order_id``
  survives the projection, so the only wide shuffle is line items against a
  one-column key set (a left-semi join; ``orders`` is keyed by ``order_id``, so
  the semi join gives the same rows as the inner join of the SQL text).
* Aggregates are hash aggregates with a map-side partial step: a SKU holding a
  third of all lines collapses to one row per map task before the shuffle.
* The cut list aggregates line items to one row per SKU *before* touching the
  catalog and the bill of materials. Because the report groups by the SKU, the
  sums factor exactly:  sum(mq * q) over (item, product, bom) pairs equals
  sum(mq * Q_sku) over (product, bom) pairs with Q_sku = sum(q) per SKU. The
  catalog and BOM joins then see one row per SKU, and AQE turns them into
  broadcast joins only when the measured size is under the broadcast bound.
* Hidden grouping keys (``product_price``, ``product_sku``) are grouped on and
  dropped by the final projection (D9); sums are bigint (D11).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions import calendar_date, status_is, widen

PENDING = "pending"


def pending_keys(orders: DataFrame, status_col: str = "fulfillment_status",
                 status: str = PENDING, key: str = "order_id") -> DataFrame:
    """Keys of orders whose status matches case-insensitively (O-26, O-22)."""
    return orders.filter(status_is(status_col, status)).select(key)


def _ordered(df: DataFrame, ordered: bool, keys: list[Column]) -> DataFrame:
    return df.orderBy(*keys) if ordered else df


def pending_orders(orders: DataFrame, items: DataFrame, ordered: bool = False,
                   status: str = PENDING) -> DataFrame:
    """Pending quantity by SKU, name, color, grouped also by the hidden price (O-69)."""
    lines = items.join(pending_keys(orders, status=status), "order_id", "left_semi")
    agg = (lines.groupBy("product_sku", "product_name", "product_color", "product_price")
           .agg(F.sum(widen("product_quantity")).alias("quantity")))
    agg = _ordered(agg, ordered, [F.col("product_price").desc(), "product_sku",
                                  "product_name", "product_color"])
    return agg.select("product_sku", "product_name", "product_color", "quantity")


def order_schedule(orders: DataFrame, items: DataFrame, products: DataFrame | None = None,
                   ordered: bool = False, zone: str | None = None) -> DataFrame:
    """Quantity per order date and product, all statuses (O-70).

    With ``products`` the lines are restricted to catalog SKUs (O-71). The
    catalog is keyed by SKU, so the inner join of the SQL text is a semi join, and as the SKU is
    a grouping key it is made on the groups, not on the lines;
    product columns are taken from the line item (D8).
    """
    dated = orders.select("order_id", calendar_date("created_on", zone).alias("ordered_on"))
    lines = items.join(dated, "order_id", "inner")
    agg = (lines.groupBy("ordered_on", "product_sku", "product_name", "product_color", "product_price")
           .agg(F.sum(widen("product_quantity")).alias("quantity")))
    if products is not None:
        agg = agg.join(products.select("product_sku"), "product_sku", "left_semi")
    agg = _ordered(agg, ordered, [F.col("ordered_on").asc(), F.col("product_price").desc(),
                                  "product_sku", "product_name", "product_color"])
    return agg.select("ordered_on", "product_sku", "product_name", "product_color", "quantity")


def pending_quantity_by_sku(orders: DataFrame, items: DataFrame, status: str = PENDING) -> DataFrame:
    """One row per SKU with the pending quantity; the only step that reads all items."""
    lines = items.join(pending_keys(orders, status=status), "order_id", "left_semi")
    return lines.groupBy("product_sku").agg(F.sum(widen("product_quantity")).alias("sku_quantity"))


def cut_list_from_sku_totals(sku_totals: DataFrame, products: DataFrame, bom: DataFrame,
                             ordered: bool = False) -> DataFrame:
    """Cut list from per-SKU pending totals (``product_sku``, ``sku_quantity``)."""
    cat = products.select("product_sku", "product_name", "product_color")
    mat = bom.select("product_sku", "material_piece", "material_color", "material_quantity")
    joined = sku_totals.join(cat, "product_sku", "inner").join(mat, "product_sku", "inner")
    agg = (joined.groupBy("material_piece", "material_color", "product_name", "product_color", "product_sku")
           .agg(F.sum(widen("material_quantity") * F.col("sku_quantity")).alias("total_material_needed"),
                F.sum("sku_quantity").alias("total_products_ordered")))
    agg = _ordered(agg, ordered, ["material_piece", "material_color", "product_name",
                                  "product_color", "product_sku"])
    return agg.select("material_piece", "material_color", "total_material_needed",
                      "product_name", "product_color", "total_products_ordered")


def cut_list(orders: DataFrame, items: DataFrame, products: DataFrame, bom: DataFrame,
             ordered: bool = False, status: str = PENDING) -> DataFrame:
    """Material piece x color x product: material needed and products ordered (O-72)."""
    return cut_list_from_sku_totals(pending_quantity_by_sku(orders, items, status), products, bom, ordered)


# --- shared base for the report bundle (O-09) --------------------------------

def pending_base(orders: DataFrame, items: DataFrame, status: str = PENDING) -> DataFrame:
    """Pending quantity by SKU, name, color and price: what the pending report and the cut
    list group on. The schedule groups by date over all orders and shares nothing with it."""
    lines = items.join(pending_keys(orders, status=status), "order_id", "left_semi")
    return (lines.groupBy("product_sku", "product_name", "product_color", "product_price")
            .agg(F.sum(widen("product_quantity")).alias("quantity")))


def pending_from_base(base: DataFrame, ordered: bool = False) -> DataFrame:
    rows = _ordered(base, ordered, [F.col("product_price").desc(), "product_sku", "product_name", "product_color"])
    return rows.select("product_sku", "product_name", "product_color", "quantity")


def cut_list_from_base(base: DataFrame, products: DataFrame, bom: DataFrame,
                       ordered: bool = False) -> DataFrame:
    sku_totals = base.groupBy("product_sku").agg(F.sum("quantity").alias("sku_quantity"))
    return cut_list_from_sku_totals(sku_totals, products, bom, ordered)
