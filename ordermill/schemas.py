"""Schemas of the raw order document, the flat order line, and the table contracts.

The raw schema is declared, never inferred: inference turns an all-empty
``variantOptions`` into ``array<string>`` and a pretty-printed file into
``_corrupt_record`` (D17).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# The field names of the source's documents.
MONEY = T.StructType([
    T.StructField("currency", T.StringType()),
    T.StructField("value", T.StringType()),
])

ADDRESS = T.StructType([
    T.StructField("firstName", T.StringType()),
    T.StructField("lastName", T.StringType()),
    T.StructField("address1", T.StringType()),
    T.StructField("address2", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("countryCode", T.StringType()),
    T.StructField("postalCode", T.StringType()),
    T.StructField("phone", T.StringType()),
])

VARIANT_OPTION = T.StructType([
    T.StructField("optionName", T.StringType()),
    T.StructField("value", T.StringType()),
])

LINE_ITEM = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("variantId", T.StringType()),
    T.StructField("sku", T.StringType()),
    T.StructField("productId", T.StringType()),
    T.StructField("productName", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unitPricePaid", MONEY),
    T.StructField("variantOptions", T.ArrayType(VARIANT_OPTION)),
    T.StructField("customizations", T.ArrayType(T.StringType())),
    T.StructField("lineItemType", T.StringType()),
])

ORDER = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("orderNumber", T.StringType()),
    T.StructField("createdOn", T.StringType()),
    T.StructField("modifiedOn", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("testmode", T.BooleanType()),
    T.StructField("customerEmail", T.StringType()),
    T.StructField("billingAddress", ADDRESS),
    T.StructField("shippingAddress", ADDRESS),
    T.StructField("fulfillmentStatus", T.StringType()),
    T.StructField("lineItems", T.ArrayType(LINE_ITEM)),
    T.StructField("internalNotes", T.ArrayType(T.StringType())),
    T.StructField("subtotal", MONEY),
    T.StructField("shippingTotal", MONEY),
    T.StructField("discountTotal", MONEY),
    T.StructField("taxTotal", MONEY),
    T.StructField("refundedTotal", MONEY),
    T.StructField("grandTotal", MONEY),
    T.StructField("fulfilledOn", T.StringType()),
    T.StructField("discountLines", T.ArrayType(T.StringType())),
])

PAGINATION = T.StructType([
    T.StructField("nextPageUrl", T.StringType()),
    T.StructField("nextPageCursor", T.StringType()),
    T.StructField("hasNextPage", T.BooleanType()),
])

RAW_ORDERS = T.StructType([
    T.StructField("result", T.ArrayType(ORDER)),
    T.StructField("pagination", PAGINATION),
])

# Storage notification: only the fields the manifest reads (O-73).
STORAGE_EVENT = T.StructType([
    T.StructField("Records", T.ArrayType(T.StructType([
        T.StructField("eventTime", T.StringType()),
        T.StructField("eventName", T.StringType()),
        T.StructField("s3", T.StructType([
            T.StructField("bucket", T.StructType([T.StructField("name", T.StringType())])),
            T.StructField("object", T.StructType([
                T.StructField("key", T.StringType()),
                T.StructField("size", T.LongType()),
            ])),
        ])),
    ]))),
])

# Flat order line, 20 columns in the order of the flatten projection.
ORDER_COLUMNS = [
    "order_id", "order_number", "created_on", "modified_on", "fulfilled_on",
    "customer_email", "customer_name", "shipping_city", "shipping_state",
    "shipping_country", "fulfillment_status", "discount_total", "refund_total",
    "order_total",
]
ITEM_COLUMNS = [
    "order_id", "created_on", "product_id", "product_sku", "product_name",
    "product_quantity", "product_price", "product_color",
]
FLAT_COLUMNS = ORDER_COLUMNS + [
    "product_id", "product_sku", "product_name", "product_quantity",
    "product_price", "product_color",
]


@dataclass(frozen=True)
class Col:
    """One contract column: name, Spark type, nullability, text length, default."""

    name: str
    dtype: T.DataType
    nullable: bool = True
    max_len: int | None = None
    default: object = None


@dataclass(frozen=True)
class Contract:
    """Declarative table contract: what the relational DDL enforced."""

    name: str
    columns: tuple[Col, ...]
    key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    references: tuple[tuple[tuple[str, ...], str, tuple[str, ...]], ...] = field(default=())

    def column(self, name: str) -> Col:
        return next(c for c in self.columns if c.name == name)


DEC = T.DecimalType(10, 2)
TS = T.TimestampType()

# Column lengths, nullability and defaults of the four tables
# and the mapping log, as declared by the reference DDL.
ORDERS = Contract(
    name="orders",
    columns=(
        Col("order_id", T.StringType(), False, 50),
        Col("order_number", T.StringType(), False, 50),
        Col("created_on", TS, False),
        Col("modified_on", TS, False),
        Col("fulfilled_on", TS, True),
        Col("customer_email", T.StringType(), False, 100),
        Col("customer_name", T.StringType(), False, 100),
        Col("shipping_city", T.StringType(), True, 100),
        Col("shipping_state", T.StringType(), True, 50),
        Col("shipping_country", T.StringType(), True, 50),
        Col("fulfillment_status", T.StringType(), False, 20),
        Col("discount_total", DEC, False, default="0.00"),
        Col("refund_total", DEC, False, default="0.00"),
        Col("order_total", DEC, False, default="0.00"),
    ),
    key=("order_id",),
    unique=(("order_number",),),
)

ORDER_ITEMS = Contract(
    name="order_items",
    columns=(
        Col("order_item_id", T.LongType(), False),
        Col("order_id", T.StringType(), False, 50),
        Col("product_sku", T.StringType(), False, 50),
        Col("product_id", T.StringType(), False, 50),
        Col("product_name", T.StringType(), False, 255),
        Col("product_quantity", T.ShortType(), False, default=1),
        Col("product_price", DEC, False, default="0.00"),
        Col("product_color", T.StringType(), True, 255),
    ),
    key=("order_item_id",),
    references=((("order_id",), "orders", ("order_id",)),),
)

PRODUCTS = Contract(
    name="products",
    columns=(
        Col("product_sku", T.StringType(), False, 50),
        Col("product_id", T.StringType(), False, 50),
        Col("product_name", T.StringType(), False, 255),
        Col("product_color", T.StringType(), False, 255, default="Default Color"),
        Col("created_at", TS, True),
        Col("modified_at", TS, True),
    ),
    key=("product_sku",),
)

BILL_OF_MATERIALS = Contract(
    name="bill_of_materials",
    columns=(
        Col("material_id", T.LongType(), False),
        Col("product_sku", T.StringType(), False, 50),
        Col("material_piece", T.StringType(), False, 255),
        Col("material_color", T.StringType(), False, 50),
        Col("material_quantity", T.ShortType(), False, default=1),
        Col("is_fabric", T.BooleanType(), False, default=True),
        Col("created_at", TS, True),
        Col("modified_at", TS, True),
    ),
    key=("material_id",),
    references=((("product_sku",), "products", ("product_sku",)),),
)

SKU_MIGRATION_LOG = Contract(
    name="sku_migration_log",
    columns=(
        Col("migration_id", T.LongType(), False),
        Col("old_sku", T.StringType(), True, 50),
        Col("new_sku", T.StringType(), True, 50),
        Col("migration_date", TS, True),
        Col("migration_reason", T.StringType(), True, 255, default="E-commerce migration"),
    ),
    key=("migration_id",),
)

CONTRACTS = {c.name: c for c in (ORDERS, ORDER_ITEMS, PRODUCTS, BILL_OF_MATERIALS, SKU_MIGRATION_LOG)}

# The two color defaults used by the reference (D22).
FLATTEN_DEFAULT_COLOR = "Default"
CATALOG_DEFAULT_COLOR = "Default Color"
# Fixed value: suffix marking legacy catalog rows in the migration.
LEGACY_SUFFIX = " - V1"
# Fixed value: high-water mark used when the target has no rows.
WATERMARK_FLOOR = "1900-01-01 00:00:00"
