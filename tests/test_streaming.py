"""Streaming ingest: parity with batch, restart, rejects, opt-in dedup."""

import json
import os

import pytest

from fraudlens.operators.ingest import ingest_orders, order_rejects
from fraudlens.schemas import ORDERS
from fraudlens.sources import adapter
from fraudlens.sources.topic import publish_orders, read_topic
from fraudlens.streaming import ingest as ingest_module
from fraudlens.streaming.ingest import read_published, start_order_ingest, write_both


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stream_equals_batch_and_restart_adds_nothing(spark, tables, tmp_dir):
    topic, out, ckpt, rej = (os.path.join(tmp_dir, n) for n in ("topic", "orders", "ckpt", "rejects"))
    raw = adapter.raw_orders_replayed(tables)
    # k files published in two rounds
    publish_orders(raw.filter("quantity % 2 = 0"), topic)
    s = start_order_ingest(spark, topic, out, ckpt, rejects_out=rej, available_now=True)
    s.await_all()
    publish_orders(raw.filter("quantity % 2 = 1 OR quantity IS NULL"), topic)
    s = start_order_ingest(spark, topic, out, ckpt, rejects_out=rej, available_now=True)
    s.await_all()
    streamed = spark.read.schema(ORDERS).parquet(out)
    assert _rows(streamed) == _rows(ingest_orders(read_topic(spark, topic)))
    assert streamed.count() == ingest_orders(raw).count()
    # restart with nothing new: no rows added
    s = start_order_ingest(spark, topic, out, ckpt, rejects_out=rej, available_now=True)
    s.await_all()
    assert spark.read.schema(ORDERS).parquet(out).count() == streamed.count()
    assert spark.read.parquet(rej).count() == order_rejects(raw).count()


def test_bad_lines_land_in_rejects(spark, tmp_dir):
    topic, out, ckpt, rej = (os.path.join(tmp_dir, n) for n in ("topic", "orders", "ckpt", "rejects"))
    os.makedirs(topic)
    good = {"order_id": "g", "user_id": "U1", "product_id": "P1", "quantity": 1, "amount": "Rp.10",
            "payment_method": "OVO", "country": "ID", "created_date": "2025-11-03T10:00:00"}
    bad_type = dict(good, order_id="t", quantity="many")
    with open(os.path.join(topic, "a.json"), "w") as f:
        f.write(json.dumps(good) + "\n" + '{"order_id": "x", "user' + "\n" + json.dumps(bad_type) + "\n")
    s = start_order_ingest(spark, topic, out, ckpt, rejects_out=rej, available_now=True)
    s.await_all()
    assert [r.order_id for r in spark.read.parquet(out).collect()] == ["g"]
    reasons = sorted(r.reason for r in spark.read.parquet(rej).collect())
    assert reasons == ["bad_json", "bad_json"]


def test_topic_dir_created_when_absent(spark, tmp_dir):
    topic = os.path.join(tmp_dir, "not-yet")
    s = start_order_ingest(spark, topic, os.path.join(tmp_dir, "o"), os.path.join(tmp_dir, "c"), available_now=True)
    s.await_all()
    assert os.path.isdir(topic)


def test_opt_in_dedup_drops_replays(spark, tables, tmp_dir):
    topic, out, ckpt = (os.path.join(tmp_dir, n) for n in ("topic", "orders", "ckpt"))
    raw = adapter.raw_orders_replayed(tables)
    publish_orders(raw, topic)
    s = start_order_ingest(spark, topic, out, ckpt, available_now=True, dedup_delay="1 day")
    s.await_all()
    got = spark.read.schema(ORDERS).parquet(out)
    assert got.count() == ingest_orders(raw).distinct().count()


def test_single_pass_mode_equals_two_queries(spark, tables, tmp_dir):
    topic = os.path.join(tmp_dir, "topic")
    raw = adapter.raw_orders_replayed(tables)
    publish_orders(raw, topic)
    a = {n: os.path.join(tmp_dir, "a", n) for n in ("orders", "rejects", "ckpt")}
    b = {n: os.path.join(tmp_dir, "b", n) for n in ("orders", "rejects", "ckpt")}
    start_order_ingest(spark, topic, a["orders"], a["ckpt"], rejects_out=a["rejects"], available_now=True).await_all()
    s = start_order_ingest(spark, topic, b["orders"], b["ckpt"], rejects_out=b["rejects"], available_now=True,
                           single_pass=True, max_files_per_trigger=2)
    s.await_all()
    two = spark.read.schema(ORDERS).parquet(a["orders"])
    one = read_published(spark, b["ckpt"])
    assert _rows(one.select(*ORDERS.fieldNames())) == _rows(two)
    assert _rows(read_published(spark, b["ckpt"], "rejects")) == _rows(spark.read.parquet(a["rejects"]))
    # restart: nothing new, nothing added
    start_order_ingest(spark, topic, b["orders"], b["ckpt"], rejects_out=b["rejects"], available_now=True,
                       single_pass=True).await_all()
    assert read_published(spark, b["ckpt"]).count() == spark.read.parquet(b["orders"]).count() == two.count()


def test_no_reader_sees_a_batch_half_written(spark, tables, tmp_dir, monkeypatch):
    out, rejects, ckpt = (os.path.join(tmp_dir, n) for n in ("orders", "rejects", "ckpt"))
    raw = adapter.raw_orders(tables)
    fn = write_both(out, rejects, ckpt)
    fn(raw.limit(50), 0)
    first = _rows(read_published(spark, ckpt))

    def dies(batch):
        raise RuntimeError("lost between the two outputs")

    with monkeypatch.context() as m:
        m.setattr(ingest_module, "order_rejects", dies)
        with pytest.raises(RuntimeError):
            fn(raw, 1)
    assert spark.read.parquet(out).count() > len(first)  # orders of the dead attempt lie there
    assert _rows(read_published(spark, ckpt)) == first
    fn(raw, 1)  # tried again
    fn(raw, 1)  # and again, after it was published
    want = ingest_orders(raw.limit(50).unionByName(raw))
    assert read_published(spark, ckpt).count() == want.count()
    assert read_published(spark, ckpt, "rejects").count() == order_rejects(raw.limit(50).unionByName(raw)).count()


def test_replay_state_outlives_a_restart_on_disk(spark, tables, tmp_dir):
    topic, out, ckpt = (os.path.join(tmp_dir, n) for n in ("topic", "orders", "ck"))
    raw = adapter.raw_orders(tables)
    for _ in range(2):  # the same events again after the stream has ended
        publish_orders(raw, topic)
        start_order_ingest(spark, topic, out, ckpt, available_now=True, dedup_delay="1 day").await_all()
    assert _rows(spark.read.schema(ORDERS).parquet(out)) == _rows(ingest_orders(raw).distinct())
    state = [n for _, _, names in os.walk(f"{ckpt}/orders/state") for n in names]
    assert any(n.endswith((".zip", ".changelog")) for n in state)  # RocksDB's files
    assert "RocksDB" not in (spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) or "")


def test_dedup_keeps_late_originals_and_far_dates(spark, tables, tmp_dir):
    """One file in a batch, events out of order and one dated 9999: as distinct()."""
    topic, out = os.path.join(tmp_dir, "topic"), os.path.join(tmp_dir, "orders")
    raw = adapter.raw_orders_replayed(tables)
    publish_orders(raw.repartition(3), topic)
    far = raw.limit(1).selectExpr("* EXCEPT (created_date)", "'9999-01-01T00:00:00' AS created_date")
    publish_orders(far, topic)
    start_order_ingest(spark, topic, out, os.path.join(tmp_dir, "ck"), available_now=True, dedup_delay="1 day",
                       max_files_per_trigger=1).await_all()
    want = ingest_orders(raw.unionByName(far.select(*raw.columns))).distinct()
    assert _rows(spark.read.schema(ORDERS).parquet(out)) == _rows(want)


def test_older_file_arriving_later_is_read(spark, tables, tmp_dir):
    import glob
    import time

    topic, out, ckpt = (os.path.join(tmp_dir, n) for n in ("topic", "orders", "ckpt"))
    raw = adapter.raw_orders(tables)
    publish_orders(raw.limit(10).coalesce(1), topic)
    start_order_ingest(spark, topic, out, ckpt, available_now=True).await_all()
    before = set(glob.glob(topic + "/*.json"))
    publish_orders(raw.limit(7).coalesce(1), topic)
    old = time.time() - 30 * 86400
    for f in set(glob.glob(topic + "/*.json")) - before:
        os.utime(f, (old, old))
    start_order_ingest(spark, topic, out, ckpt, available_now=True).await_all()
    want = ingest_orders(raw.limit(10)).count() + ingest_orders(raw.limit(7)).count()
    assert spark.read.schema(ORDERS).parquet(out).count() == want


def test_output_without_its_checkpoint_is_refused(spark, tables, tmp_dir):
    topic, out = os.path.join(tmp_dir, "topic"), os.path.join(tmp_dir, "orders")
    publish_orders(adapter.raw_orders(tables).limit(5), topic)
    start_order_ingest(spark, topic, out, os.path.join(tmp_dir, "a"), available_now=True, single_pass=True).await_all()
    with pytest.raises(ValueError, match="checkpoint"):
        start_order_ingest(spark, topic, out, os.path.join(tmp_dir, "b"), available_now=True, single_pass=True)
