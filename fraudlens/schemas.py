"""Declared schemas: the order wire format and the three tables.

Timestamps are wall-clock values without an offset, so the tables use
``TIMESTAMP_NTZ``: ``hour()``, ``to_date()`` and the Jakarta formatting then
give the same answer whatever the session time zone is.
"""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT_COL = "_corrupt_record"

# One JSON object per line on the order topic.  created_date stays a string
# here: parsing it is part of ingest (bad dates are rejected, not nulled).
RAW_ORDER = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("amount", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("created_date", T.StringType()),
    ]
)

# Topic lines are read with every field as text, plus the PERMISSIVE-mode column
# that keeps unparsable lines: whether a line parses then doesn't depend on the
# columns a query asks for.  Types are checked by the ingest itself.
WIRE_ORDER = T.StructType(
    [T.StructField(f.name, T.StringType()) for f in RAW_ORDER.fields] + [T.StructField(CORRUPT_COL, T.StringType())]
)

# --- fixed values: longest text (characters) the orders table takes -------------
ORDER_LENGTHS = {"order_id": 50, "user_id": 50, "product_id": 50, "amount": 50, "payment_method": 50, "country": 10}
# ---------------------------------------------------------------------------------

# Ingested orders: raw columns, parsed created_date, fraud verdict.
ORDERS = T.StructType(
    [
        T.StructField("order_id", T.StringType(), False),
        T.StructField("user_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("amount", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("created_date", T.TimestampNTZType()),
        T.StructField("status", T.StringType()),
    ]
)

USERS = T.StructType(
    [
        T.StructField("user_id", T.StringType(), False),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("default_payment", T.StringType()),
        T.StructField("created_date", T.TimestampNTZType()),
    ]
)

PRODUCTS = T.StructType(
    [
        T.StructField("product_id", T.StringType(), False),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("price", T.LongType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)

# table name -> (schema, key column or None, event-time column used for the day partition)
TABLES = {
    "orders": (ORDERS, None, "created_date"),
    "users": (USERS, "user_id", "created_date"),
    "products": (PRODUCTS, "product_id", "updated_at"),
}


def required_columns(schema: T.StructType) -> list[str]:
    """Columns declared NOT NULL (Spark does not enforce this on read)."""
    return [f.name for f in schema.fields if not f.nullable]
