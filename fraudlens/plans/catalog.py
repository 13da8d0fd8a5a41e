"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query derives the pipeline inputs from the given tables (see
``sources.adapter``) and runs one operator or model over all of them.
The names are the keys of the DuckDB oracle in ``testing.oracle_sql``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlens.operators import compose, ingest, warehouse
from fraudlens.operators.position import with_position
from fraudlens.plans.models import ModelGraph, Sources, build_models
from fraudlens.schemas import ORDERS, PRODUCTS, USERS
from fraudlens.sources import adapter
from fraudlens.sources.tables import TableSet, load_tables

# --- fixed values: dates of the registered runs ---------------------------------
AS_OF = "2025-11-06 00:00:00"
ORDERS_RUN_DATE = "1995-02-19"
USERS_RUN_DATE = "2025-11-05"
PRODUCTS_RUN_DATE = "2025-11-05"
WINDOW_START, WINDOW_END = "1996-01-01", "1997-12-31"
DEDUP_EVENTS_PER_FILE = 500_000    # of the topic of stream_dedup, four files at least
DEDUP_FILES_PER_BATCH = 64         # at most, and no more than half of the files
DEALING = {    # a partition of the join is a file: small ones aren't merged
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.localShuffleReader.enabled": "false",
}
# -------------------------------------------------------------------------------

Query = Callable[[SparkSession, str], DataFrame]


def sources_from_tables(t: TableSet) -> Sources:
    """Warehouse sources as the daily loads would have filled them: every
    ingested order (replays included), the user table, both product versions."""
    return Sources(
        orders=lambda: ingest.ingest_orders(adapter.raw_orders_replayed(t)),
        users=lambda: adapter.raw_users(t),
        products=lambda: adapter.raw_products(t),
    )


def _model(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build_models(sources_from_tables(load_tables(spark, sf_dir)), as_of=AS_OF)[name]

    run.__name__ = name
    return run


#: The orders of the sorted marts (ascending, desc, or with nulls last), made total by further columns.
POSITION_KEYS = {
    "mart_payment_critical_time": ("fraud_orders desc", "payment_method"),
    "mart_users_fraud_mostly": ("fraud_orders_count desc", "total_orders desc", "user_id", "first_name", "email"),
    "mart_user_product_habit": ("total_orders desc", "first_name last", "user_id", "product_id", "email", "product_name"),
}


def _sort_key(key: str) -> Column:
    name, _, way = key.partition(" ")
    return {"desc": F.desc, "last": F.asc_nulls_last, "": F.asc}[way](name)


def _positions(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sources = sources_from_tables(load_tables(spark, sf_dir))
        return with_position(ModelGraph(sources, AS_OF, ordered=False)[name], *map(_sort_key, POSITION_KEYS[name]))

    run.__name__ = f"{name}_positions"
    return run


def q_clean_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.clean_amount(adapter.raw_orders(load_tables(spark, sf_dir)))


def q_ingest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.ingest_orders(adapter.raw_orders_replayed(load_tables(spark, sf_dir)))


def q_order_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.order_rejects(adapter.raw_orders_replayed(load_tables(spark, sf_dir)))


def q_ingest_iso_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose clock is spelled in each way of the ISO grammar."""
    return ingest.ingest_orders(adapter.raw_orders_spelled(load_tables(spark, sf_dir)))


def q_fraud_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = ingest.ingest_orders(adapter.raw_orders_replayed(load_tables(spark, sf_dir)))
    return ingest.fraud_rules(orders.distinct())


def q_daily_slice_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.ingest_day(adapter.raw_orders_replayed(load_tables(spark, sf_dir)), ORDERS_RUN_DATE)


def q_daily_slice_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.daily_slice(adapter.raw_users(load_tables(spark, sf_dir)), "created_date", USERS_RUN_DATE)


def q_daily_slice_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.daily_slice(adapter.raw_products(load_tables(spark, sf_dir)), "updated_at", PRODUCTS_RUN_DATE)


def q_upsert_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, repriced = adapter.raw_products_versions(load_tables(spark, sf_dir))
    return warehouse.upsert(first, repriced, "product_id")


def q_insert_users_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load_tables(spark, sf_dir)
    return warehouse.insert_if_absent(adapter.raw_users(t), adapter.user_signups(t), "user_id", ["created_date"])


def q_keyed_upsert_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product merge on a bucketed table: all products, the repricing batch, and the same
    batch again."""
    from fraudlens.session import scratch_dir
    from fraudlens.sources.keyed import KeyedTable

    first, repriced = adapter.raw_products_versions(load_tables(spark, sf_dir))
    table = KeyedTable(spark, scratch_dir(spark, "products"), PRODUCTS, "product_id")
    for batch in (first, repriced, repriced):
        table.upsert(batch)
    return table.read()


def q_keyed_insert_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user merge on a bucketed table: all users, the sign-ups, and these again."""
    from fraudlens.session import scratch_dir
    from fraudlens.sources.keyed import KeyedTable

    t = load_tables(spark, sf_dir)
    table = KeyedTable(spark, scratch_dir(spark, "users"), USERS, "user_id")
    for batch in (adapter.raw_users(t), adapter.user_signups(t), adapter.user_signups(t)):
        table.insert_if_absent(batch, ["created_date"])
    return table.read()


def q_email_styles(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = adapter.customer_profiles(load_tables(spark, sf_dir))
    return compose.with_email(profiles, F.col("style"), digit="digit").select(
        "user_id", "first_name", "last_name", "domain", "style", "email"
    )


def q_product_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = adapter.part_name_parts(load_tables(spark, sf_dir))
    return compose.with_product_name(parts).select("product_id", "category", "product_name")


def q_currency_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load_tables(spark, sf_dir)["orders"]
    valued = orders.select("o_orderkey", F.floor(F.col("o_totalprice") * 1000).cast("bigint").alias("amount_value"))
    return compose.with_currency(valued, "amount_value")


def q_stream_ingest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish the raw events to a fresh topic folder, run the streaming
    ingest once over it (availableNow) and read the ingested table back."""
    from fraudlens.session import scratch_dir
    from fraudlens.sources.topic import TOPIC_FILES, publish_orders
    from fraudlens.streaming.ingest import start_order_ingest

    base = scratch_dir(spark, "stream-ingest")
    publish_orders(adapter.raw_orders_replayed(load_tables(spark, sf_dir)), f"{base}/topic", **TOPIC_FILES)
    streams = start_order_ingest(spark, f"{base}/topic", f"{base}/orders", f"{base}/_checkpoints", available_now=True)
    streams.await_all()
    return spark.read.schema(ORDERS).parquet(f"{base}/orders")


def q_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest with the replay drop, several micro-batches: every distinct order once.

    The events are dealt out, so that copies meet in the state and not in one file; files
    and micro-batches are bounded, their number grows with the events.  Of the shuffles,
    those of the write or micro-batch that runs lie on the disk."""
    from fraudlens.session import scratch_dir
    from fraudlens.sources.topic import TOPIC_FILES, publish_orders, read_topic
    from fraudlens.streaming.ingest import SHUFFLE_CLEANUP, settings, start_order_ingest

    base = scratch_dir(spark, "stream-dedup")
    t = load_tables(spark, sf_dir)
    files = max(4, -(-t["lineitem"].count() // DEDUP_EVENTS_PER_FILE))
    with settings(spark, {**SHUFFLE_CLEANUP, **DEALING, "spark.sql.shuffle.partitions": str(files)}):
        publish_orders(adapter.raw_orders_dealt(t), f"{base}/topic", **{**TOPIC_FILES, "maxRecordsPerFile": str(2 * DEDUP_EVENTS_PER_FILE)})
    published = len(read_topic(spark, f"{base}/topic").inputFiles())    # more than asked for, if a partition was split
    start_order_ingest(
        spark, f"{base}/topic", f"{base}/orders", f"{base}/_checkpoints", available_now=True, dedup_delay="1 day",
        max_files_per_trigger=min(DEDUP_FILES_PER_BATCH, max(1, published // 2)),
    ).await_all()
    return spark.read.schema(ORDERS).parquet(f"{base}/orders")


def _topic_with_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published events, and for each order four lines that must be rejected."""
    from fraudlens.session import scratch_dir
    from fraudlens.sources.topic import TOPIC_FILES, publish_lines, publish_orders, read_topic

    topic = f"{scratch_dir(spark, 'topic')}/topic"
    t = load_tables(spark, sf_dir)
    publish_orders(adapter.raw_orders_replayed(t), topic, **TOPIC_FILES)
    key = F.col("o_orderkey").cast("string")
    event = '", "user_id": "U1", "product_id": "P1", "quantity": %s, "amount": "Rp.5", "created_date": "2025-01-01T00:00:00"'
    lines = F.array(
        F.concat(F.lit('{"order_id": "X'), key, F.lit(event % '"many"' + "}")),
        F.concat(F.lit('{"order_id": "Y'), key, F.lit(event % "1.5" + "}")),
        F.concat(F.lit('{"order_id": "Z'), key),
        F.concat(F.lit('{"order_id": "W'), F.lpad(key, 60, "0"), F.lit(event % "1" + "}")),
    )
    publish_lines(t["orders"].select(F.explode(lines).alias("value")), topic, **TOPIC_FILES)
    return read_topic(spark, topic)


def q_topic_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.ingest_orders(_topic_with_bad_lines(spark, sf_dir))


def q_topic_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = ingest.order_rejects(_topic_with_bad_lines(spark, sf_dir))
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def q_topic_reject_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.order_rejects(_topic_with_bad_lines(spark, sf_dir))


def q_table_lifecycle_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table created twice, loaded with every user, then asked to load a day without
    rows and a batch with a missing key: the rows, and what each step answered."""
    import uuid

    from fraudlens.plans.loads import backfill, daily_load, init_tables, table_path
    from fraudlens.session import scratch_dir
    from fraudlens.sources.warehouse import load_daily, read_warehouse

    base, prefix = scratch_dir(spark, "lifecycle"), f"lifecycle_{uuid.uuid4().hex[:12]}_"
    t = load_tables(spark, sf_dir)
    users = adapter.raw_users(t)
    created = init_tables(spark, f"{base}/tables", prefix)["users"]
    again = init_tables(spark, f"{base}/tables", prefix)["users"]
    loaded = backfill("users", users, f"{base}/warehouse")
    empty = daily_load(spark, "users", users, "1980-01-01", f"{base}/warehouse")
    keyless = users.withColumn("user_id", F.when(F.col("user_id") != "U1", F.col("user_id")))
    try:
        load_daily(keyless, table_path(f"{base}/warehouse", "users"), USERS, "created_date", table="users")
        refused = False
    except Exception as e:
        if "required column" not in str(e):
            raise
        refused = True
    rows = read_warehouse(spark, table_path(f"{base}/warehouse", "users"), USERS).drop(warehouse.PARTITION_COL)
    answers = {"created": created, "created_again": again, "loaded": loaded, "loaded_empty_day": empty, "refused_missing_key": refused}
    return spark.table(f"{prefix}users").unionByName(rows).withColumns({k: F.lit(v) for k, v in answers.items()})


def q_json_extract_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fraudlens.session import scratch_dir
    from fraudlens.sources.warehouse import read_json_extract, write_json_extract

    path = write_json_extract(adapter.raw_products(load_tables(spark, sf_dir)), scratch_dir(spark, "extract"))
    return read_json_extract(spark, path, PRODUCTS)


def q_json_array_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product extract as JSON arrays, read back by the reader that splits them."""
    from fraudlens.session import scratch_dir
    from fraudlens.sources.warehouse import read_json_extract, write_json_array_extract

    path = write_json_array_extract(adapter.raw_products(load_tables(spark, sf_dir)), scratch_dir(spark, "extract"))
    return read_json_extract(spark, path, PRODUCTS, json_array=True)


def _polled_arrivals(spark: SparkSession, sf_dir: str) -> str:
    """Events published at three hours, read by a poll after each of them; the checkpoint."""
    from datetime import datetime

    from fraudlens.session import scratch_dir
    from fraudlens.sources.topic import TOPIC_FILES
    from fraudlens.streaming.arrivals import ingest_open, publish_arrivals

    base = scratch_dir(spark, "arrivals")
    raw = adapter.raw_orders_replayed(load_tables(spark, sf_dir))
    for turn, hour in enumerate((1, 2, 9)):
        now = datetime(2025, 11, 3, hour, 30)
        publish_arrivals(raw.where(F.pmod(F.xxhash64("order_id"), F.lit(3)) == turn), f"{base}/topic", now, **TOPIC_FILES)
        ingest_open(spark, f"{base}/topic", f"{base}/orders", f"{base}/_checkpoints", now, f"{base}/rejects")
    return f"{base}/_checkpoints"


def q_arrival_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fraudlens.streaming.arrivals import read_arrivals

    return read_arrivals(spark, _polled_arrivals(spark, sf_dir))


def q_arrival_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fraudlens.streaming.arrivals import read_arrivals

    return read_arrivals(spark, _polled_arrivals(spark, sf_dir), "rejects")


def q_warehouse_load_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed, checked, day-partitioned load of every ingested order, read back."""
    from fraudlens.session import scratch_dir
    from fraudlens.sources.warehouse import load_daily, read_warehouse

    path = scratch_dir(spark, "warehouse")
    load_daily(q_ingest_orders(spark, sf_dir), path, ORDERS, "created_date", table="orders")
    return read_warehouse(spark, path, ORDERS).drop(warehouse.PARTITION_COL)


def q_warehouse_rerun_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appended loads, then a rerun that replaces the days: each user once."""
    from fraudlens.session import scratch_dir
    from fraudlens.sources.warehouse import load_daily, read_warehouse

    path = scratch_dir(spark, "warehouse")
    users = adapter.raw_users(load_tables(spark, sf_dir))
    for mode in ("append", "append", "overwrite_days"):
        load_daily(users, path, USERS, "created_date", mode=mode, table="users")
    return read_warehouse(spark, path, USERS).drop(warehouse.PARTITION_COL)


def q_staging_view_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fraudlens.plans.loads import register_staging_views

    register_staging_views(build_models(sources_from_tables(load_tables(spark, sf_dir)), as_of=AS_OF), prefix="v_")
    return spark.sql("SELECT * FROM v_stg_products")


def q_run_models_product_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full refresh that writes the core tables and one mart, read back."""
    from fraudlens.plans.models import run_models
    from fraudlens.session import scratch_dir

    sources = sources_from_tables(load_tables(spark, sf_dir))
    paths = run_models(spark, sources, scratch_dir(spark, "models"), as_of=AS_OF, select=("mart_product_payment",))
    return spark.read.parquet(paths["mart_product_payment"])


def q_windowed_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model over a day range of the warehouse: orders are limited, users not."""
    from fraudlens.plans.loads import backfill, warehouse_sources
    from fraudlens.session import scratch_dir

    base = scratch_dir(spark, "warehouse")
    t = load_tables(spark, sf_dir)
    backfill("orders", q_ingest_orders(spark, sf_dir), base)
    backfill("users", adapter.raw_users(t), base)
    return build_models(warehouse_sources(spark, base, WINDOW_START, WINDOW_END), as_of=AS_OF)["mart_users_blacklist"]


QUERIES: dict[str, Query] = {
    "clean_amount": q_clean_amount,
    "ingest_orders": q_ingest_orders,
    "order_rejects": q_order_rejects,
    "ingest_iso_dates": q_ingest_iso_dates,
    "fraud_rules": q_fraud_rules,
    "stg_orders": _model("stg_orders"),
    "stg_users": _model("stg_users"),
    "stg_products": _model("stg_products"),
    "fct_orders": _model("fct_orders"),
    "dim_users": _model("dim_users"),
    "dim_products": _model("dim_products"),
    "mart_payment_critical_time": _model("mart_payment_critical_time"),
    "mart_users_blacklist": _model("mart_users_blacklist"),
    "mart_users_fraud_mostly": _model("mart_users_fraud_mostly"),
    "mart_user_product_habit": _model("mart_user_product_habit"),
    "mart_product_payment": _model("mart_product_payment"),
    **{f"{name}_positions": _positions(name) for name in POSITION_KEYS},
    "daily_slice_orders": q_daily_slice_orders,
    "daily_slice_users": q_daily_slice_users,
    "daily_slice_products": q_daily_slice_products,
    "upsert_products": q_upsert_products,
    "insert_users_if_absent": q_insert_users_if_absent,
    "keyed_upsert_products": q_keyed_upsert_products,
    "keyed_insert_users": q_keyed_insert_users,
    "email_styles": q_email_styles,
    "product_names": q_product_names,
    "currency_string": q_currency_string,
    "stream_ingest_orders": q_stream_ingest_orders,
    "stream_dedup": q_stream_dedup,
    "topic_ingest": q_topic_ingest,
    "topic_rejects": q_topic_rejects,
    "topic_reject_rows": q_topic_reject_rows,
    "table_lifecycle_users": q_table_lifecycle_users,
    "json_extract_products": q_json_extract_products,
    "json_array_products": q_json_array_products,
    "arrival_orders": q_arrival_orders,
    "arrival_rejects": q_arrival_rejects,
    "warehouse_load_orders": q_warehouse_load_orders,
    "warehouse_rerun_users": q_warehouse_rerun_users,
    "staging_view_products": q_staging_view_products,
    "run_models_product_payment": q_run_models_product_payment,
    "windowed_blacklist": q_windowed_blacklist,
}

__all__ = ["QUERIES", "Query", "ModelGraph", "sources_from_tables", "ORDERS_RUN_DATE", "USERS_RUN_DATE", "PRODUCTS_RUN_DATE"]
