"""Line verdicts, date parsing, loads and merges: what doesn't depend on the plan."""

import datetime as dt
import os

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fraudlens.functions.timefmt import may_be_on, parse_wall_clock, with_wall_clock
from fraudlens.operators import warehouse
from fraudlens.operators.ingest import ingest_orders, order_rejects
from fraudlens.operators.joins import checked_broadcast
from fraudlens.schemas import ORDERS
from fraudlens.sources.topic import read_topic
from fraudlens.sources.warehouse import load_daily, read_warehouse

LINE = '{"order_id": "%s", "user_id": "U1", "product_id": "P1", "quantity": %s, "amount": "Rp.5", "country": "%s", "created_date": "2025-01-01"}'


def test_json_verdict_does_not_depend_on_the_columns(spark, tmp_dir):
    path = os.path.join(tmp_dir, "topic")
    lines = [LINE % ("a", 1, "ID"), LINE % ("b", '"many"', "ID"), LINE % ("c", 1.5, "ID"), '{"order_id": "d"', LINE % ("e", "null", "ID"),
             LINE % ("f" * 51, 1, "ID"), LINE % ("g", 1, "ABCDEFGHIJK")]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    good, bad = ingest_orders(read_topic(spark, path)), order_rejects(read_topic(spark, path))
    assert good.count() == len(good.collect()) == 2
    assert sorted(r[0] for r in good.select("order_id").collect()) == ["a", "e"]
    assert bad.count() == len(bad.collect()) == 5
    assert sorted(r[0] for r in bad.select("reason").collect()) == ["bad_json"] * 3 + ["too_long"] * 2


DATES = ["2025-11-03", "20251103", "2025-11-3", "2025-02-30", "0000-01-01", "2025-11", "2025-W45", "2025-W45-1", "2025W45", "2025W451", "2020-W53-7",
         "2025-W53-1", "9999-W52-7", "9999-W52-4", "0001-W01-1", "0000-W01-1", "2025-W00-1", "2025-W45-8", "2025-307", "9999-12-31"]
PIECES = ["T", " ", "x", "Z", "+07:00", "+7", "+0700", "-23:59", "+25:00", "+2360", "+23:59:59.9", ":", ".", ",", "5", "123", "123456", "1234567", "10", "23",
          "24", "61", "00:00", "10:00:00", "100000", " Asia/Jakarta", "\n", "\u00e9", "-", "+", "W"]
texts = st.builds(lambda d, rest: d + "".join(rest), st.sampled_from(DATES), st.lists(st.sampled_from(PIECES), max_size=7))


def iso(v):
    try:
        return dt.datetime.fromisoformat(v).replace(tzinfo=None)
    except ValueError:
        return None


def parsed(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "v string")
    once = {r.v: r.t for r in with_wall_clock(rows, "v", "t").collect()}
    assert once == {r.v: r.t for r in rows.select("v", parse_wall_clock("v").alias("t")).collect()}
    return once


@settings(max_examples=6, deadline=None)
@given(st.lists(texts, min_size=200, max_size=400))
def test_dates_parse_as_the_iso_parser_does(spark, values):
    assert parsed(spark, values) == {v: iso(v) for v in values}


def test_every_short_spelling_parses_as_the_iso_parser_does(spark):
    """All pairs of pieces after each date, and digits in a row of any number."""
    values = [d + a + b + c for d in DATES for a in ["", *PIECES] for b in ["", *PIECES] for c in ("", "Z")]
    values += ["2025W45" + "1" * n + z for n in range(20) for z in ("", "Z", "T10")] + ["20251103" + "1" * n for n in range(20)]
    values += ["", "x" * 300_000, "2025W45" + "1" * 100_000, "2025-11-03T10:00:00.123456" + "x" * 100_000 + "Z"]
    found = parsed(spark, values)
    assert found == {v: iso(v) for v in values}
    assert sum(t is not None for t in found.values()) > 1000


def test_a_day_is_named_by_its_prefixes(spark):
    values = [d + t for d in DATES for t in ("", "T10", " 235959", "T10:00Z")]
    rows = spark.createDataFrame([(v,) for v in values], "v string")
    for day in ("2025-11-03", "2021-01-03", "9999-12-31", "0001-01-01", "2025-11-04"):
        named = {r.v for r in rows.filter(may_be_on("v", day)).collect()}
        assert {v for v in values if iso(v) and iso(v).date().isoformat() == day} <= named


def test_a_date_is_parsed_once_whatever_is_filtered(tables):
    from fraudlens.operators.ingest import ingest_day
    from fraudlens.sources import adapter

    raw = adapter.raw_orders_replayed(tables)
    late = ingest_orders(raw).filter("created_date >= TIMESTAMP_NTZ '1996-01-01' AND hour(created_date) < 5")
    for df in (late, ingest_day(raw, "1995-02-19"), order_rejects(raw)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("(?<moa>") == 1


def test_one_clock_load_uses_several_tasks(spark, tmp_dir):
    rows = spark.range(60_000).select(
        F.col("id").cast("string").alias("order_id"), F.lit("U1").alias("user_id"), F.sha2(F.col("id").cast("string"), 256).alias("product_id"),
        F.lit(1).alias("quantity"), F.lit("Rp.1").alias("amount"), F.lit("OVO").alias("payment_method"), F.lit("ID").alias("country"),
        F.lit("2025-01-01 00:00:00").cast("timestamp_ntz").alias("created_date"), F.lit("genuine").alias("status"),
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512k")
    try:
        assert load_daily(rows, tmp_dir + "/t", ORDERS, "created_date")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len([f for f in os.listdir(tmp_dir + "/t/dt=2025-01-01") if f.endswith(".parquet")]) > 1
    assert read_warehouse(spark, tmp_dir + "/t", ORDERS).count() == 60_000


def test_small_merge_does_not_shuffle_the_target(spark, tmp_dir):
    path = tmp_dir + "/target"
    spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v")).write.parquet(path)
    target = spark.read.parquet(path)
    batch = spark.createDataFrame([("k1", -1), ("new", -2)], "k string, v long")
    out = warehouse.upsert(target, batch, "k")
    assert out.count() == 5001 and out.where("k = 'k1'").first().v == -1
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_broadcast_is_checked_by_bytes(spark):
    wide = spark.range(100).select("id", F.repeat(F.lit("x"), 10_000).alias("text"))
    assert "ResolvedHint" not in checked_broadcast(wide, 500_000)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in checked_broadcast(wide.select("id"), 500_000)._jdf.queryExecution().analyzed().toString()
