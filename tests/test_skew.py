"""Hot keys: one user and one product own a third of all orders.

Results must stay whole and exact; the plan must combine map-side and let
AQE split the hot join partition (thresholds lowered so the small fixture
counts as skewed)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fraudlens.operators import marts, warehouse


def _fct(spark, n=30000, hot="user"):
    """A third of the rows belong to U0 (hot="user") or to P0 (hot="product";
    the hot product is bought by thousands of users, so it stays hot after
    grouping by user and product)."""
    i = F.col("id")
    if hot == "user":
        user = F.when(i % 3 == 0, F.lit("U0")).otherwise(F.concat(F.lit("U"), (i % 997 + 1).cast("string")))
        product = F.concat(F.lit("P"), (i % 211 + 1).cast("string"))
    else:
        # every order of the hot product comes from a different user
        user = F.concat(F.lit("U"), F.when(i % 3 == 0, i).otherwise(i % 5000 + 1).cast("string"))
        product = F.when(i % 3 == 0, F.lit("P0")).otherwise(F.concat(F.lit("P"), (i % 211 + 1).cast("string")))
    base = spark.range(n).select(i, user.alias("user_id"), product.alias("product_id"))
    return base.select(
        F.concat(F.lit("o"), F.col("id").cast("string")).alias("order_id"),
        "user_id",
        "product_id",
        F.lit(1).alias("quantity"),
        (F.col("id") % 1000).cast("bigint").alias("total_amount"),
        F.element_at(F.array(*[F.lit(p) for p in ["OVO", "DANA", "Gopay"]]), (F.col("id") % 3 + 1).cast("int")).alias("payment_method"),
        F.lit("ID").alias("country"),
        F.lit("genuine").alias("order_status"),
        (F.col("id") % 7 == 0).alias("is_fraud"),
        (F.lit(dt.datetime(2025, 11, 1)).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), (F.col("id") % 24).cast("int"))).alias("order_date"),
    )


def _dims(spark, n_users=30001):
    users = spark.range(0, n_users).select(
        F.concat(F.lit("U"), F.col("id").cast("string")).alias("user_id"),
        F.concat(F.lit("name"), F.col("id").cast("string")).alias("first_name"),
        F.lit("x@y").alias("email"),
    )
    products = spark.range(0, 212).select(
        F.concat(F.lit("P"), F.col("id").cast("string")).alias("product_id"),
        F.concat(F.lit("item"), F.col("id").cast("string")).alias("product_name"),
    )
    return users, products


@pytest.fixture()
def skew_conf(spark):
    keys = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_product_join_is_split_and_exact(spark, skew_conf):
    fct = _fct(spark, hot="product")
    users, products = _dims(spark)
    habit = marts.mart_user_product_habit(fct, products, users)
    rows = habit.collect()
    plan = habit._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    # exact: one row per (user, product) group, counts add up to every order
    assert len(rows) == fct.select("user_id", "product_id").distinct().count()
    assert sum(r.total_orders for r in rows) == fct.count()
    assert sum(r.total_orders for r in rows if r.product_id == "P0") == 10000
    assert all(r.product_name is not None for r in rows)


def test_hot_user_aggregates_map_side(spark):
    fct = _fct(spark)
    users, _ = _dims(spark)
    m = marts.mart_users_blacklist(fct, users)
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    got = {r.user_id: r.total_orders for r in m.collect()}
    assert got["U0"] == 10000 and sum(got.values()) == 30000


def test_hot_key_first_per_key(spark):
    batch = _fct(spark).select("user_id", "order_id", "order_date")
    got = {r.user_id: r.order_date for r in warehouse.first_per_key(batch, "user_id", ["order_date", "order_id"]).collect()}
    want = {r.user_id: r.m for r in batch.groupBy("user_id").agg(F.min("order_date").alias("m")).collect()}
    assert got == want
