"""Declared schemas. Nothing in the lake relies on inference."""

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


PARTITION_FIELDS = _strings("year", "month", "day")

# Names, types and order of the columns of all layers below.
# Raw layer. Quantity stays text here: a row that does not parse has to reach
# the quarantine with its reason instead of failing the scan.
RAW_ORDERS = T.StructType(
    _strings("order_id", "customer_id", "product_id", "quantity", "order_date", "status")
)
RAW_ORDERS_PARTITIONED = T.StructType([*RAW_ORDERS.fields, *PARTITION_FIELDS])
RAW_CUSTOMERS = T.StructType(
    _strings("customer_id", "customer_name", "email", "country", "created_date")
)
RAW_PRODUCTS = T.StructType(
    [
        *_strings("product_id", "product_name", "category"),
        T.StructField("price", T.DoubleType()),
    ]
)
RAW_PRODUCTS_TEXT = T.StructType(_strings("product_id", "product_name", "category", "price"))

# Orders as a typed external table declares them (quantity as int).
TYPED_ORDERS = T.StructType(
    [
        *_strings("order_id", "customer_id", "product_id"),
        T.StructField("quantity", T.IntegerType()),
        *_strings("order_date", "status"),
    ]
)

CURATED_FILE = T.StructType(
    [
        *_strings(
            "order_id", "customer_id", "product_id", "product_name", "category", "country"
        ),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("order_total", T.DecimalType(12, 2)),
        *_strings("status"),
        T.StructField("order_date", T.TimestampType()),
    ]
)
CURATED = T.StructType([*CURATED_FILE.fields, *PARTITION_FIELDS])

QUARANTINE = T.StructType(
    [
        *_strings("order_id", "customer_id", "product_id"),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("order_date", T.TimestampType()),
        *_strings("status", "rejection_reason", "raw_order_date", "raw_quantity"),
    ]
)
QUARANTINE_RUNS = T.StructType([*QUARANTINE.fields, *_strings("run_id")])
