"""Core models: the order fact and the user / product dimensions.

``updated_at`` is the run clock (when the model was built), not a property
of the row; pass ``as_of`` for a reproducible build.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.functions.rules import FRAUD
from fraudlens.functions.timefmt import run_clock


def fct_orders(stg_orders: DataFrame, as_of=None) -> DataFrame:
    status = F.lower(F.col("status"))
    return stg_orders.select(
        "order_id",
        "user_id",
        "product_id",
        "quantity",
        "total_amount",
        "payment_method",
        "country",
        status.alias("order_status"),
        F.when(status == F.lit(FRAUD), F.lit(True)).otherwise(F.lit(False)).alias("is_fraud"),
        F.col("created_date").alias("order_date"),
        run_clock(as_of).alias("updated_at"),
    )


def dim_users(stg_users: DataFrame, as_of=None) -> DataFrame:
    """No second de-duplication after dropping columns: a user staged in two
    versions stays two rows (and repeats mart rows on join)."""
    return stg_users.select("user_id", "first_name", "email", run_clock(as_of).alias("updated_at"))


def dim_products(stg_products: DataFrame, as_of=None) -> DataFrame:
    return stg_products.select("product_id", "product_name", "price", run_clock(as_of).alias("updated_at"))
