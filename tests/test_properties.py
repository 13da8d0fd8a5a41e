"""Properties of the operators, on the adapter over sf0.001 and on
generated rows checked against a row-at-a-time restatement."""

import datetime as dt
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fraudlens.operators import warehouse
from fraudlens.operators.ingest import fraud_rules, ingest_orders, order_rejects
from fraudlens.operators.staging import stg_orders
from fraudlens.plans.catalog import sources_from_tables
from fraudlens.plans.models import build_models
from fraudlens.schemas import RAW_ORDER
from fraudlens.sources import adapter
from tests.reference_rules import verdict


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_status_is_or_of_rules(tables):
    got = fraud_rules(ingest_orders(adapter.raw_orders_replayed(tables)))
    any_rule = F.col("rule_critical_hour") | F.col("rule_foreign_country") | F.col("rule_anomaly") | F.col("rule_wallet_limit")
    assert got.filter((F.col("status") == "fraud") != any_rule).count() == 0


def test_accepted_plus_rejected_is_input(tables):
    raw = adapter.raw_orders_replayed(tables)
    assert ingest_orders(raw).count() + order_rejects(raw).count() == raw.count()


def test_counts_from_the_blueprint(tables):
    raw = adapter.raw_orders(tables)
    assert raw.count() == 6000
    assert adapter.raw_orders_replayed(tables).count() == 6116
    m = build_models(sources_from_tables(tables), as_of="2025-11-06 00:00:00")
    assert m["fct_orders"].count() == 5876
    assert m["mart_users_blacklist"].count() == 244
    assert m["mart_users_fraud_mostly"].count() == 123
    assert m["mart_user_product_habit"].count() == 5686
    assert m["mart_product_payment"].count() == 1621
    labels = Counter(r.blacklist_status for r in m["mart_users_blacklist"].collect())
    assert labels == {"Blacklist": 104, "Watchlist": 19, "Good Standing": 121}


def test_genuine_plus_fraud_is_total(tables):
    m = build_models(sources_from_tables(tables), as_of="2025-11-06 00:00:00")
    pay = m["mart_payment_critical_time"]
    assert pay.filter(F.col("genuine_orders") + F.col("fraud_orders") != F.col("total_orders_midnight")).count() == 0
    pp = m["mart_product_payment"]
    assert pp.filter(F.col("genuine_orders_count") + F.col("fraud_orders_count") != F.col("total_orders")).count() == 0


def test_staging_absorbs_replays(tables):
    orders = ingest_orders(adapter.raw_orders(tables))
    assert rows(stg_orders(orders.unionByName(orders))) == rows(stg_orders(orders))


def test_upsert_twice_is_once(tables):
    first, repriced = adapter.raw_products_versions(tables)
    once = warehouse.upsert(first, repriced, "product_id")
    twice = warehouse.upsert(once, repriced, "product_id")
    assert rows(once) == rows(twice)
    assert once.count() == 210


def test_insert_if_absent_twice_is_once(tables):
    users, signups = adapter.raw_users(tables), adapter.user_signups(tables)
    once = warehouse.insert_if_absent(users, signups, "user_id", ["created_date"])
    twice = warehouse.insert_if_absent(once, signups, "user_id", ["created_date"])
    assert rows(once) == rows(twice)
    # existing users untouched, new users take their earlier sign-up
    assert once.select("user_id").distinct().count() == once.count() == 180
    new = once.join(users, "user_id", "left_anti")
    assert new.filter(F.col("created_date") >= F.lit("2025-11-12").cast("timestamp_ntz")).count() == 0


amounts = st.one_of(
    st.none(),
    st.integers(min_value=0, max_value=10**12).map(lambda n: f"Rp.{n:,}"),
    st.sampled_from(["Rp.", "Rp.-5", "Rp.1.5", "", "abc", "Rp.100,000,000", "Rp.300,000,000", "Rp.50,000,001"]),
)
clocks = st.one_of(
    st.sampled_from(["bad", "", None, "2025-11-03", "2025-11-03T04:59:59.123456"]),
    st.builds(lambda h, m: f"2025-11-03T{h:02d}:{m:02d}:00", st.integers(0, 23), st.integers(0, 59)),
)
raw_rows = st.lists(
    st.fixed_dictionaries(
        {
            "order_id": st.text(alphabet="abcdef0123456789", min_size=1, max_size=8),
            "user_id": st.just("U100"),
            "product_id": st.just("P1111"),
            "quantity": st.one_of(st.none(), st.integers(0, 600)),
            "amount": amounts,
            "payment_method": st.sampled_from(["Bank Transfer", "Paylater", "Credit Card", "Gopay", "OVO", "DANA", None]),
            "country": st.sampled_from(["ID", "US", "SG", "MY", "id", None]),
            "created_date": clocks,
        }
    ),
    min_size=1,
    max_size=300,
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(raw_rows)
def test_ingest_matches_row_at_a_time(spark, data):
    df = spark.createDataFrame([tuple(r[c] for c in RAW_ORDER.fieldNames()) for r in data], RAW_ORDER)
    got = Counter((r.order_id, r.status) for r in ingest_orders(df).collect())
    want = Counter((r["order_id"], v) for r in data if (v := verdict(r)) is not None)
    assert got == want


keyed_rows = st.lists(st.tuples(st.sampled_from(["k1", "k2", "k3", "k4", "k5"]), st.integers(0, 9), st.integers(0, 99)), max_size=25)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(keyed_rows, keyed_rows)
def test_merges_match_row_at_a_time(spark, target_rows, batch_rows):
    # target has unique keys, as a keyed table does
    target_map = {}
    for k, v, pos in target_rows:
        target_map.setdefault(k, (k, v, pos))
    schema = "k string, v int, pos int"
    target = spark.createDataFrame(list(target_map.values()), schema)
    batch = spark.createDataFrame(batch_rows, schema)

    # insert-if-absent: keep the target, add the first batch row (lowest pos,
    # then lowest v) of every new key
    want = dict(target_map)
    for k, v, pos in sorted(batch_rows, key=lambda r: (r[2], r[1])):
        want.setdefault(k, (k, v, pos))
    got = warehouse.insert_if_absent(target, batch, "k", ["pos"]).collect()
    assert sorted(tuple(r) for r in got) == sorted(want.values())

    # upsert: batch rows replace / add; duplicate batch keys are an error
    keys = [k for k, _, _ in batch_rows]
    if len(keys) != len(set(keys)):
        with pytest.raises(ValueError):
            warehouse.upsert(target, batch, "k")
    else:
        want = dict(target_map)
        for k, v, pos in batch_rows:
            want[k] = (k, v, pos)
        got = warehouse.upsert(target, batch, "k").collect()
        assert sorted(tuple(r) for r in got) == sorted(want.values())


clock_near_midnight = st.builds(
    lambda day, sec: dt.datetime(2025, 11, 3) + dt.timedelta(days=day, seconds=sec),
    st.integers(-2, 2),
    st.one_of(st.integers(0, 5), st.integers(86_394, 86_399), st.integers(0, 86_399)),
)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(clock_near_midnight, min_size=1, max_size=40), st.integers(-1, 2))
def test_daily_slice_matches_calendar_day(spark, clocks, offset):
    run_date = dt.date(2025, 11, 4) + dt.timedelta(days=offset)
    df = spark.createDataFrame([(i, c) for i, c in enumerate(clocks)], "i int, ts timestamp_ntz")
    got = sorted(r.i for r in warehouse.daily_slice(df, "ts", run_date).collect())
    want = sorted(i for i, c in enumerate(clocks) if c.date() == run_date - dt.timedelta(days=1))
    assert got == want
