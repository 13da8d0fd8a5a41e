"""Model graph: ordering, run clock, materialized run, plan shape."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from fraudlens.plans.catalog import sources_from_tables
from fraudlens.plans.models import CORE, MARTS, build_models, run_models

AS_OF = "2025-11-06 00:00:00"


@pytest.fixture(scope="module")
def models(tables):
    return build_models(sources_from_tables(tables), as_of=AS_OF)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_payment_mart_sorted_by_fraud_desc(models):
    got = [r.fraud_orders for r in models["mart_payment_critical_time"].collect()]
    assert got == sorted(got, reverse=True) and len(got) == 6


def test_fraud_mostly_sorted(models):
    got = [(r.fraud_orders_count, r.total_orders) for r in models["mart_users_fraud_mostly"].collect()]
    assert got == sorted(got, reverse=True)
    assert all(c > 0 for c, _ in got)


def test_habit_sorted_with_nulls_last(models):
    rows = models["mart_user_product_habit"].collect()
    keys = [(-r.total_orders, r.first_name is None, r.first_name or "", r.user_id) for r in rows]
    assert keys == sorted(keys)
    assert any(r.first_name is None for r in rows)


def test_habit_formats_in_jakarta(models, tables):
    fct = models["fct_orders"]
    one = fct.groupBy("user_id", "product_id").agg(F.max("order_date").alias("m")).orderBy("user_id", "product_id").first()
    row = models["mart_user_product_habit"].filter((F.col("user_id") == one.user_id) & (F.col("product_id") == one.product_id)).first()
    assert row.latest_transaction == (one.m + dt.timedelta(hours=7)).strftime("%Y-%m-%d %H:%M:%S")


def test_run_clock_default_is_now(tables):
    m = build_models(sources_from_tables(tables))
    ts = m["dim_users"].select("updated_at").first()[0]
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert abs((now - ts).total_seconds()) < 600


def test_fan_out_kept(models):
    # two versions of a repriced product repeat the habit rows
    habit = models["mart_user_product_habit"]
    assert habit.count() > habit.select("user_id", "product_id").distinct().count()


def test_percentage_and_nulls(models):
    for r in models["mart_payment_critical_time"].collect():
        assert r.fraud_percentage == pytest.approx(100.0 * r.fraud_orders / r.total_orders_midnight)


def test_run_models_materializes_core_then_marts(spark, tables, tmp_dir):
    out = os.path.join(tmp_dir, "models")
    paths = run_models(spark, sources_from_tables(tables), out, as_of=AS_OF)
    assert set(paths) == set(CORE) | set(MARTS)
    assert spark.read.parquet(paths["mart_users_blacklist"]).count() == 244
    assert spark.read.parquet(paths["fct_orders"]).count() == 5876


def test_aggregate_before_join_and_partial_aggregation(models):
    plan = _plan(models["mart_users_blacklist"])
    # map-side partial aggregation exists for the user totals
    assert plan.count("HashAggregate") >= 4
    # the join is planned after the aggregate (the join's left child is aggregated)
    assert plan.index("Join") < plan.rindex("HashAggregate")


def test_model_scan_prunes_columns(models):
    plan = models["mart_payment_critical_time"]._jdf.queryExecution().executedPlan().toString()
    # lineitem scan reads only the six columns the adapter needs
    assert "l_shipdate" not in plan and "l_tax" not in plan


def test_stored_dims_broadcast_only_under_the_bound(spark, tables, tmp_dir):
    from fraudlens.plans.models import stored_graph

    paths = run_models(spark, sources_from_tables(tables), os.path.join(tmp_dir, "m"), as_of=AS_OF)
    small = stored_graph(spark, paths)["mart_user_product_habit"]
    plan = _plan(small)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    big = stored_graph(spark, paths, broadcast_max_bytes=10)["mart_user_product_habit"]
    assert "BroadcastHashJoin" not in big._jdf.queryExecution().sparkPlan().toString()
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, big.collect()))


def test_run_models_select(spark, tables, tmp_dir):
    out = os.path.join(tmp_dir, "sel")
    paths = run_models(spark, sources_from_tables(tables), out, as_of=AS_OF, select=("mart_payment_critical_time",))
    assert set(paths) == set(CORE) | {"mart_payment_critical_time"}
    assert not os.path.exists(os.path.join(out, "_user_fraud_flags"))
    assert spark.read.parquet(paths["mart_payment_critical_time"]).count() == 6
