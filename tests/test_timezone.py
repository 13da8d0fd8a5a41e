"""Results do not depend on the session time zone (all clocks are wall
clocks), including wall clocks inside a daylight-saving gap."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from fraudlens.functions.timefmt import iso_text, report_clock
from tests.conftest import SF_SMALL

QUERIES = ["ingest_orders", "mart_user_product_habit", "daily_slice_orders", "daily_slice_users", "fct_orders"]


@pytest.fixture()
def zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")

    def use(z):
        spark.conf.set("spark.sql.session.timeZone", z)

    yield use
    spark.conf.set("spark.sql.session.timeZone", old)


def _bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", QUERIES)
def test_same_result_in_any_session_zone(spark, zone, name):
    zone("UTC")
    want = _bag(E.queries()[name](spark, SF_SMALL))
    zone("America/New_York")
    got = _bag(E.queries()[name](spark, SF_SMALL))
    assert got == want


def test_wall_clock_in_dst_gap(spark, zone):
    zone("America/New_York")
    df = spark.createDataFrame([(dt.datetime(2025, 3, 9, 2, 30),)], "t timestamp_ntz")
    row = df.select(iso_text("t").alias("iso"), report_clock("t").alias("rep"), F.hour("t").alias("h")).first()
    assert row.iso == "2025-03-09T02:30:00"
    assert row.rep == "2025-03-09 09:30:00"
    assert row.h == 2
