"""Marts: order facts aggregated per user / product / payment method, then
joined to the dimensions.

Plan shape, on purpose:
- aggregate first, join after: the join sees one row per group, and a
  dimension with several versions of a key repeats mart rows rather than
  inflating counts (that is the models' semantics);
- every aggregate is decomposable (count, count_if, sum, max), so Spark
  combines map-side and a hot user / product / payment method costs one
  row per input split in the shuffle;
- joins are plain LEFT equi-joins; the planner broadcasts a dimension only
  when its estimated size is under ``spark.sql.autoBroadcastJoinThreshold``
  and AQE re-checks that at run time from real shuffle sizes.  Otherwise it
  is a sort-merge join whose aggregated side is already hash-partitioned on
  the key, and AQE's skew handling splits a hot key on that side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlens.functions.text import blacklist_label, grouped_number
from fraudlens.functions.timefmt import report_clock

# --- fixed values ------------------------------------------------------------
CRITICAL_HOURS = (0, 4)   # critical time: 00:00 to 04:59
# -------------------------------------------------------------------------------


def n_orders() -> Column:
    return F.count("order_id")


def n_genuine() -> Column:
    return F.count_if(~F.col("is_fraud"))


def n_fraud() -> Column:
    return F.count_if(F.col("is_fraud"))


def purchasing() -> Column:
    return F.sum("total_amount")


def fraud_loss() -> Column:
    # fraud rows with a NULL amount are skipped; a group of only those is NULL
    return F.sum(F.when(F.col("is_fraud"), F.col("total_amount")).otherwise(F.lit(0)))


def _users(dim_users: DataFrame) -> DataFrame:
    return dim_users.select("user_id", "first_name", "email")


def _products(dim_products: DataFrame) -> DataFrame:
    return dim_products.select("product_id", "product_name")


def user_fraud_flags(fct: DataFrame) -> DataFrame:
    """Per-user order and fraud totals, shared by the two user marts."""
    return fct.groupBy("user_id").agg(
        n_orders().alias("total_orders"),
        n_fraud().alias("fraud_orders_count"),
        purchasing().alias("total_purchasing"),
        fraud_loss().alias("total_fraud_loss"),
    )


def _ordered(df: DataFrame, ordered: bool, *keys) -> DataFrame:
    """Apply the model's ORDER BY, or leave rows unordered when the result is
    written as a table (a stored table keeps no row order, so the global sort,
    a sampling pass plus a range shuffle, would be wasted)."""
    return df.orderBy(*keys) if ordered else df


def mart_payment_critical_time(fct: DataFrame, ordered: bool = True) -> DataFrame:
    """Per payment method: orders placed 00:00-04:59 and how many were fraud."""
    lo, hi = CRITICAL_HOURS
    per_method = (
        fct.filter(F.hour("order_date").between(lo, hi))
        .groupBy("payment_method")
        .agg(
            n_orders().alias("total_orders_midnight"),
            n_genuine().alias("genuine_orders"),
            n_fraud().alias("fraud_orders"),
            purchasing().alias("total_purchasing"),
            fraud_loss().alias("total_fraud_loss"),
        )
    )
    out = per_method.select(
        "payment_method",
        "total_orders_midnight",
        "genuine_orders",
        "fraud_orders",
        (F.try_divide("fraud_orders", "total_orders_midnight") * 100).alias("fraud_percentage"),
        grouped_number("total_purchasing").alias("total_midnights_transaction"),
        grouped_number("total_fraud_loss").alias("fake_transaction"),
    )
    return _ordered(out, ordered, F.desc("fraud_orders"))


def mart_users_blacklist(fct: DataFrame, dim_users: DataFrame, flags: DataFrame | None = None) -> DataFrame:
    """Every user with orders, totals and a blacklist status.

    ``flags`` is the per-user aggregate of ``fct`` when already built (the
    two user marts share it); otherwise it is computed here."""
    flags = user_fraud_flags(fct) if flags is None else flags
    return flags.join(_users(dim_users), "user_id", "left").select(
        "user_id",
        "first_name",
        "email",
        "total_orders",
        "total_purchasing",
        "fraud_orders_count",
        "total_fraud_loss",
        blacklist_label("fraud_orders_count").alias("blacklist_status"),
    )


def mart_users_fraud_mostly(
    fct: DataFrame, dim_users: DataFrame, flags: DataFrame | None = None, ordered: bool = True
) -> DataFrame:
    """Users with at least one fraud order, most fraud first."""
    flags = (user_fraud_flags(fct) if flags is None else flags).filter(F.col("fraud_orders_count") > 0)
    out = flags.join(_users(dim_users), "user_id", "left").select(
        "user_id",
        "first_name",
        "email",
        "total_orders",
        grouped_number("total_purchasing").alias("total_transaction"),
        "fraud_orders_count",
        grouped_number("total_fraud_loss").alias("fake_transaction"),
        blacklist_label("fraud_orders_count").alias("blacklist_status"),
    )
    return _ordered(out, ordered, F.desc("fraud_orders_count"), F.desc("total_orders"), F.asc("user_id"))


def mart_user_product_habit(
    fct: DataFrame, dim_products: DataFrame, dim_users: DataFrame, ordered: bool = True
) -> DataFrame:
    """How often each user bought each product, and when last."""
    habit = fct.groupBy("user_id", "product_id").agg(
        n_orders().alias("total_orders"),
        n_genuine().alias("genuine_orders_count"),
        n_fraud().alias("fraud_orders_count"),
        F.max("order_date").alias("new_transaction"),
    )
    out = (
        habit.join(_products(dim_products), "product_id", "left")
        .join(_users(dim_users), "user_id", "left")
        .select(
            "user_id",
            "first_name",
            "email",
            "product_id",
            "product_name",
            "total_orders",
            "genuine_orders_count",
            "fraud_orders_count",
            report_clock("new_transaction").alias("latest_transaction"),
        )
    )
    return _ordered(out, ordered, F.desc("total_orders"), F.asc_nulls_last("first_name"), F.asc("user_id"), F.asc("product_id"))


def mart_product_payment(fct: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Per product and payment method: orders, genuine / fraud split, totals."""
    per_pair = fct.groupBy("product_id", "payment_method").agg(
        n_orders().alias("total_orders"),
        n_genuine().alias("genuine_orders_count"),
        n_fraud().alias("fraud_orders_count"),
        purchasing().alias("total_purchasing"),
        fraud_loss().alias("total_fraud_loss"),
    )
    return per_pair.join(_products(dim_products), "product_id", "left").select(
        "product_id",
        "product_name",
        "payment_method",
        "total_orders",
        grouped_number("total_purchasing").alias("total_transaction"),
        "genuine_orders_count",
        "fraud_orders_count",
        grouped_number("total_fraud_loss").alias("fake_transaction"),
    )
