"""Staging models: typed projections with full-row de-duplication.

``distinct()`` plans as a partial (map-side) aggregate, a shuffle hashed on
all columns and a final aggregate.  Hashing on the whole row keeps the
shuffle balanced even when one user or product owns a large share of the
rows; replays that land in the same input split collapse before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.functions.amount import total_amount


def stg_orders(orders: DataFrame) -> DataFrame:
    """Ingested orders with ``amount`` text cleaned to BIGINT ``total_amount``;
    identical rows (replayed events, repeated loads) kept once."""
    return orders.select(
        "order_id",
        "user_id",
        "product_id",
        "quantity",
        total_amount("amount").alias("total_amount"),
        "payment_method",
        "country",
        "created_date",
        "status",
    ).distinct()


def stg_users(users: DataFrame) -> DataFrame:
    return users.select("user_id", "first_name", "last_name", "email", "default_payment", "created_date").distinct()


def stg_products(products: DataFrame) -> DataFrame:
    """Distinct product versions; a repriced product keeps both versions."""
    return products.select("product_id", "product_name", "category", "price", "updated_at").distinct()


def latest_by_key(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Opt-in: keep one row per ``key``, the one with the greatest ``ts``
    (ties broken by the remaining columns, so the result is deterministic).

    ``max(struct(ts, ...))`` is an ordinary aggregate: it is combined map-side
    before the shuffle, so a key with millions of versions costs one row per
    input split, unlike a window over the key.
    """
    rest = [c for c in df.columns if c not in (key, ts)]
    best = F.max(F.struct(F.col(ts).alias(ts), *[F.col(c) for c in rest])).alias("_best")
    return df.groupBy(key).agg(best).select(key, *[F.col(f"_best.{c}").alias(c) for c in [ts] + rest]).select(*df.columns)
