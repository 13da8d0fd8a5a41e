"""The whole flow: topic -> streaming ingest -> warehouse -> models."""

import os

import __spark_entry__ as E
from fraudlens.plans.loads import daily_load, init_tables, merge_products, merge_users, register_staging_views, warehouse_sources
from fraudlens.plans.models import ModelGraph
from fraudlens.plans.run import run_all
from fraudlens.schemas import USERS
from fraudlens.sources import adapter
from tests.conftest import SF_SMALL

AS_OF = "2025-11-06 00:00:00"


def _bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_run_all_matches_registered_queries(spark, tmp_dir):
    paths = run_all(spark, SF_SMALL, os.path.join(tmp_dir, "run"), as_of=AS_OF)
    for name in ("mart_users_blacklist", "mart_product_payment", "mart_payment_critical_time", "fct_orders"):
        got = spark.read.parquet(paths[name])
        want = E.queries()[name](spark, SF_SMALL)
        assert _bag(got) == _bag(want.select(*got.columns)), name


def test_daily_load_with_json_interchange(spark, tables, tmp_dir):
    wh = os.path.join(tmp_dir, "wh")
    users = adapter.raw_users(tables)
    assert daily_load(spark, "users", users, "2025-11-05", wh, interchange_dir=os.path.join(tmp_dir, "x"))
    assert not daily_load(spark, "users", users, "1999-01-01", wh)
    src = warehouse_sources(spark, wh)
    assert src.users.count() == 24
    assert src.users.columns == USERS.fieldNames()


def test_init_tables_and_views(spark, tables, tmp_dir):
    prefix = "t" + os.path.basename(tmp_dir).replace("-", "_") + "_"
    assert init_tables(spark, tmp_dir, prefix) == {"orders": True, "users": True, "products": True}
    assert init_tables(spark, tmp_dir, prefix) == {"orders": False, "users": False, "products": False}
    from fraudlens.plans.catalog import sources_from_tables

    names = register_staging_views(ModelGraph(sources_from_tables(tables), AS_OF), prefix)
    assert spark.table(names[1]).count() == 150


def test_merges_write_new_versions(spark, tables, tmp_dir):
    first, repriced = adapter.raw_products_versions(tables)
    out = merge_products(first, repriced, os.path.join(tmp_dir, "products_v2"))
    assert spark.read.parquet(out).count() == 210
    users_out = merge_users(adapter.raw_users(tables), adapter.user_signups(tables), os.path.join(tmp_dir, "users_v2"))
    assert spark.read.parquet(users_out).count() == 180


def test_cli_jobs(spark, tables, tmp_dir):
    from fraudlens.plans.run import main

    users, products = os.path.join(tmp_dir, "users"), os.path.join(tmp_dir, "products")
    adapter.raw_users(tables).write.parquet(users)
    first, repriced = adapter.raw_products_versions(tables)
    first.write.parquet(products)
    repriced.write.parquet(os.path.join(tmp_dir, "batch"))
    wh = os.path.join(tmp_dir, "wh")
    assert main(["load", "--table", "users", "--source", users, "--warehouse", wh, "--run-date", "2025-11-05"], spark)["loaded"]
    out = main(["merge", "--table", "products", "--current", products, "--batch", os.path.join(tmp_dir, "batch"),
                "--out", os.path.join(tmp_dir, "products_v2")], spark)["out"]
    assert spark.read.parquet(out).count() == 210
    # a topic with one file, ingested once
    from fraudlens.sources.topic import publish_orders

    topic = os.path.join(tmp_dir, "topic")
    publish_orders(adapter.raw_orders(tables), topic)
    main(["ingest", "--topic", topic, "--orders-out", os.path.join(tmp_dir, "orders"),
          "--checkpoint", os.path.join(tmp_dir, "ck"), "--once"], spark)
    from fraudlens.operators.ingest import ingest_orders

    assert spark.read.parquet(os.path.join(tmp_dir, "orders")).count() == ingest_orders(adapter.raw_orders(tables)).count()
    main(["load", "--table", "orders", "--source", os.path.join(tmp_dir, "orders"), "--warehouse", wh,
          "--run-date", "1995-02-19"], spark)
    main(["load", "--table", "products", "--source", out, "--warehouse", wh, "--run-date", "2025-11-05"], spark)
    paths = main(["models", "--warehouse", wh, "--out", os.path.join(tmp_dir, "models"), "--as-of", AS_OF], spark)
    assert spark.read.parquet(paths["mart_users_blacklist"]).count() > 0


def test_single_pass_output_feeds_the_daily_load(spark, tables, tmp_dir):
    from fraudlens.plans.run import main
    from fraudlens.sources.topic import publish_orders

    topic = os.path.join(tmp_dir, "topic")
    publish_orders(adapter.raw_orders_replayed(tables), topic)
    orders = os.path.join(tmp_dir, "orders")
    main(["ingest", "--topic", topic, "--orders-out", orders, "--checkpoint", os.path.join(tmp_dir, "ck"),
          "--rejects-out", os.path.join(tmp_dir, "rejects"), "--once", "--single-pass"], spark)
    wh = os.path.join(tmp_dir, "wh")
    assert main(["load", "--table", "orders", "--source", orders, "--published", os.path.join(tmp_dir, "ck"),
                 "--warehouse", wh, "--run-date", "1995-02-19"], spark)["loaded"]
    want = E.queries()["daily_slice_orders"](spark, SF_SMALL)
    got = warehouse_sources(spark, wh).orders
    assert _bag(got) == _bag(want)
