"""Table lifecycle flows built from the operators: table init, the daily
warehouse load, the hourly merges, and reading the warehouse back as model
sources.

Every flow takes its date or batch as a parameter (no wall-clock "today"),
so a rerun or a backfill does the same work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlens.functions.timefmt import run_clock
from fraudlens.operators import warehouse
from fraudlens.plans.models import ModelGraph, Sources
from fraudlens.schemas import TABLES
from fraudlens.sources.warehouse import (
    create_table_if_absent,
    load_daily,
    read_json_extract,
    read_warehouse,
    write_json_extract,
)


def table_path(base_dir: str, table: str) -> str:
    return f"{base_dir.rstrip('/')}/{table}"


def init_tables(spark: SparkSession, base_dir: str, prefix: str = "") -> dict[str, bool]:
    """Create the orders, users and products tables if absent (one declared
    schema each).  Returns ``table -> created``."""
    return {
        name: create_table_if_absent(spark, f"{prefix}{name}", schema, table_path(base_dir, name))
        for name, (schema, _key, _ts) in TABLES.items()
    }


def daily_load(
    spark: SparkSession,
    table: str,
    operational: DataFrame,
    run_date,
    warehouse_dir: str,
    mode: str = "append",
    interchange_dir: str | None = None,
) -> bool:
    """Load yesterday's rows of one operational table into the warehouse.

    ``operational`` is any DataFrame with the table's columns (a JDBC read,
    a Parquet table, ...).  The slice is the day before ``run_date`` on the
    table's event-time column; it is typed against the declared schema,
    checked for REQUIRED columns and written day-partitioned.  With
    ``interchange_dir`` the slice goes through a JSON-lines extract first
    (the hand-over format of the original flow).  Returns False when the
    day is empty and nothing was written.
    """
    schema, _key, ts_col = TABLES[table]
    day = warehouse.daily_slice(operational, ts_col, run_date).select(*schema.fieldNames())
    if interchange_dir:
        write_json_extract(day, interchange_dir)
        day = read_json_extract(spark, interchange_dir, schema)
    return load_daily(day, table_path(warehouse_dir, table), schema, ts_col, mode=mode, table=table)


def backfill(table: str, operational: DataFrame, warehouse_dir: str) -> bool:
    """Load every day of ``operational`` in one job, replacing the day
    partitions it covers (a rerun replaces, not duplicates)."""
    schema, _key, ts_col = TABLES[table]
    return load_daily(operational.select(*schema.fieldNames()), table_path(warehouse_dir, table), schema, ts_col,
                      mode="overwrite_days", table=table)


def merge_products(current: DataFrame, batch: DataFrame, out_path: str, as_of=None) -> str:
    """Hourly product merge: upsert ``batch`` by product_id and write the
    new table version to ``out_path`` (never the path ``current`` reads).  A row
    without ``updated_at`` gets the run clock (``as_of`` or now)."""
    batch = batch.withColumn("updated_at", F.coalesce("updated_at", run_clock(as_of)))
    warehouse.upsert(current, batch, "product_id").write.mode("overwrite").parquet(out_path)
    return out_path


def merge_users(current: DataFrame, batch: DataFrame, out_path: str, order_by: list[str] | None = None) -> str:
    """Hourly user merge: insert users whose key is new (first row of a key
    in the batch wins) and write the new table version to ``out_path``."""
    merged = warehouse.insert_if_absent(current, batch, "user_id", order_by or ["created_date"])
    merged.write.mode("overwrite").parquet(out_path)
    return out_path


def warehouse_sources(spark: SparkSession, warehouse_dir: str, start_day=None, end_day=None) -> Sources:
    """The three warehouse tables as model sources.  A day range limits the orders
    (pruned on the ``dt`` partitions); users and products are read whole, as an
    order may name one that was added on any day."""

    def read(table: str):
        schema, _key, _ts = TABLES[table]
        return read_warehouse(spark, table_path(warehouse_dir, table), schema).select(*schema.fieldNames())

    def orders():
        schema, _key, ts_col = TABLES["orders"]
        df = read_warehouse(spark, table_path(warehouse_dir, "orders"), schema)
        return warehouse.date_range(df, ts_col, start_day, end_day).select(*schema.fieldNames())

    return Sources(orders=orders, users=lambda: read("users"), products=lambda: read("products"))


def register_staging_views(graph: ModelGraph, prefix: str = "") -> list[str]:
    """Staging models as temporary views (they are views, not tables):
    queried by name, expanded into each query that reads them."""
    names = []
    for name in ("stg_orders", "stg_users", "stg_products"):
        graph[name].createOrReplaceTempView(f"{prefix}{name}")
        names.append(f"{prefix}{name}")
    return names
