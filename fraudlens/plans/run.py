"""Command-line entry points: the jobs a user of the pipeline runs.

    python -m fraudlens.plans.run ingest  --topic T --orders-out O --checkpoint C [--rejects-out R] [--once]
    python -m fraudlens.plans.run load    --table orders|users|products --source P --warehouse W --run-date D
    python -m fraudlens.plans.run merge   --table users|products --current P --batch B --out O
    python -m fraudlens.plans.run models  --warehouse W --out O [--as-of TS] [--start-day D] [--end-day D]
    python -m fraudlens.plans.run all     --sf-dir S --out O

``all`` runs the whole flow over the given tables:
1. derive raw order events, users and products from the tables;
2. publish the events to a topic folder and run the streaming ingest over
   it (availableNow) into the operational orders table, rejects aside;
3. back-fill the day-partitioned warehouse from the operational tables;
4. full refresh of the models (core tables, then marts) from the warehouse.

Every step is a Spark job over whole tables; nothing passes through the
driver.  Paths must be folders every executor can reach.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from fraudlens.plans.loads import backfill, daily_load, merge_products, merge_users, warehouse_sources
from fraudlens.plans.models import run_models
from fraudlens.schemas import ORDERS, TABLES
from fraudlens.sources import adapter
from fraudlens.sources.tables import load_tables
from fraudlens.sources.topic import publish_orders
from fraudlens.streaming.ingest import read_published, start_order_ingest


def run_all(spark: SparkSession, sf_dir: str, out: str, as_of=None) -> dict[str, str]:
    out = out.rstrip("/")
    t = load_tables(spark, sf_dir)
    # 1-2: topic -> streaming ingest -> operational orders (+ rejects)
    publish_orders(adapter.raw_orders_replayed(t), f"{out}/topic")
    streams = start_order_ingest(
        spark, f"{out}/topic", f"{out}/operational/orders", f"{out}/_checkpoints/ingest",
        rejects_out=f"{out}/operational/order_rejects", available_now=True,
    )
    streams.await_all()
    orders = spark.read.schema(ORDERS).parquet(f"{out}/operational/orders")
    # 3: warehouse back-fill, day-partitioned
    wh = f"{out}/warehouse"
    backfill("orders", orders, wh)
    backfill("users", adapter.raw_users(t), wh)
    backfill("products", adapter.raw_products(t), wh)
    # 4: models
    return run_models(spark, warehouse_sources(spark, wh), f"{out}/models", as_of=as_of)


def _read_table(spark: SparkSession, table: str, path: str):
    schema = TABLES[table][0]
    return spark.read.schema(schema).parquet(path)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="fraudlens", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("--master", default=None, help="only for local runs; a cluster launcher sets it")
    sub = ap.add_subparsers(dest="cmd", required=True)

    p = sub.add_parser("ingest", help="stream order events from a topic folder into the orders table")
    p.add_argument("--topic", required=True)
    p.add_argument("--orders-out", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--rejects-out")
    p.add_argument("--once", action="store_true", help="process what is on the topic, then stop")
    p.add_argument("--dedup-delay", help="opt-in: drop identical events seen again within this delay")
    p.add_argument("--single-pass", action="store_true", help="parse the topic once for orders and rejects")
    p.add_argument("--max-files-per-trigger", type=int, help="bound each micro-batch (backlog catch-up)")

    p = sub.add_parser("load", help="daily warehouse load of the day before --run-date")
    p.add_argument("--table", required=True, choices=sorted(TABLES))
    p.add_argument("--source", required=True, help="Parquet path of the operational table")
    p.add_argument("--published", help="checkpoint folder of a single-pass ingest: read its published batches, not --source")
    p.add_argument("--warehouse", required=True)
    p.add_argument("--run-date", required=True)
    p.add_argument("--mode", default="append", choices=["append", "overwrite_days"])
    p.add_argument("--interchange", help="hand the slice over as a JSON-lines extract in this folder")

    p = sub.add_parser("merge", help="hourly merge: upsert products / insert new users")
    p.add_argument("--table", required=True, choices=["users", "products"])
    p.add_argument("--current", required=True)
    p.add_argument("--batch", required=True)
    p.add_argument("--out", required=True, help="new table version (never the --current path)")

    p = sub.add_parser("models", help="full refresh of core tables and marts from the warehouse")
    p.add_argument("--warehouse", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--as-of")
    p.add_argument("--start-day")
    p.add_argument("--end-day")

    p = sub.add_parser("all", help="the whole flow over the given test tables")
    p.add_argument("--sf-dir", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--as-of")

    args = ap.parse_args(argv)
    if spark is None:
        from fraudlens.session import get_session

        spark = get_session(args.master)

    if args.cmd == "ingest":
        streams = start_order_ingest(
            spark, args.topic, args.orders_out, args.checkpoint, rejects_out=args.rejects_out,
            available_now=args.once, dedup_delay=args.dedup_delay, single_pass=args.single_pass,
            max_files_per_trigger=args.max_files_per_trigger,
        )
        streams.await_all()
        result = {"orders": args.orders_out, "rejects": args.rejects_out}
    elif args.cmd == "load":
        src = read_published(spark, args.published) if args.published else _read_table(spark, args.table, args.source)
        loaded = daily_load(spark, args.table, src, args.run_date, args.warehouse, args.mode, args.interchange)
        result = {"table": args.table, "loaded": loaded}
    elif args.cmd == "merge":
        current = _read_table(spark, args.table, args.current)
        batch = _read_table(spark, args.table, args.batch)
        merge = merge_products if args.table == "products" else merge_users
        result = {"table": args.table, "out": merge(current, batch, args.out)}
    elif args.cmd == "models":
        src = warehouse_sources(spark, args.warehouse, args.start_day, args.end_day)
        result = run_models(spark, src, args.out, as_of=args.as_of)
    else:
        result = run_all(spark, args.sf_dir, args.out, args.as_of)
    print(json.dumps(result, indent=1))
    return result


if __name__ == "__main__":
    main()
