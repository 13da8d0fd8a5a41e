"""What must not grow with the tables: the sizes of partitions, files and batches."""

import os
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fraudlens import session
from fraudlens.operators.ingest import ingest_orders, order_rejects
from fraudlens.plans import catalog
from fraudlens.plans.catalog import QUERIES
from fraudlens.sources import adapter
from fraudlens.sources.tables import load_tables
from fraudlens.sources.topic import TOPIC_FILES, publish_lines, publish_orders, read_topic
from fraudlens.streaming.ingest import settings
from tests.conftest import SF_SMALL


@pytest.fixture()
def no_broadcast(spark):
    key = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", ["fct_orders", "mart_user_product_habit"])
def test_joins_of_small_partitions_sort_no_side(spark, no_broadcast, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() == len(df.collect()) > 0
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def _files(folder):
    return [os.path.join(d, n) for d, _, names in os.walk(folder) for n in names if not n.startswith((".", "_"))]


@pytest.mark.parametrize("name", ["topic_ingest", "topic_rejects", "topic_reject_rows", "stream_ingest_orders", "arrival_orders"])
def test_published_topic_takes_a_part_of_its_text(spark, tmp_dir, monkeypatch, name):
    """The topic was written as plain text, the most of what these queries wrote."""
    monkeypatch.setattr(session, "scratch_dir", lambda _spark, what: os.path.join(tmp_dir, what))
    QUERIES[name](spark, SF_SMALL).count()
    topic = [f for f in _files(tmp_dir) if f"{os.sep}topic{os.sep}" in f and "_checkpoints" not in f]
    text = spark.read.text(topic).selectExpr("sum(octet_length(value) + 1)").first()[0]
    assert 0 < sum(map(os.path.getsize, topic)) < text / 4


def test_topic_of_plain_and_compressed_files(spark, tables, tmp_dir):
    raw = adapter.raw_orders(tables)
    publish_orders(raw, tmp_dir)
    publish_orders(raw, tmp_dir, **{**TOPIC_FILES, "maxRecordsPerFile": "1000"})
    publish_lines(spark.createDataFrame([("{broken",)], "value string"), tmp_dir, **TOPIC_FILES)
    assert sum(f.endswith(".gz") for f in _files(tmp_dir)) > raw.count() / 1000
    assert read_topic(spark, tmp_dir).count() == 2 * raw.count() + 1
    assert ingest_orders(read_topic(spark, tmp_dir)).exceptAll(ingest_orders(raw.unionByName(raw))).isEmpty()
    assert order_rejects(read_topic(spark, tmp_dir)).where("reason = 'bad_json'").count() == 1


def test_dedup_reads_files_and_batches_that_do_not_grow(spark, tmp_dir, monkeypatch):
    """The topic was four files, however many the events."""
    monkeypatch.setattr(session, "scratch_dir", lambda _spark, what: os.path.join(tmp_dir, what))
    monkeypatch.setattr(catalog, "DEDUP_EVENTS_PER_FILE", 500, raising=False)
    monkeypatch.setattr(catalog, "DEDUP_FILES_PER_BATCH", 4, raising=False)
    got = QUERIES["stream_dedup"](spark, SF_SMALL)
    raw = adapter.raw_orders_replayed(load_tables(spark, SF_SMALL))
    assert got.count() == ingest_orders(raw).distinct().count()
    assert got.exceptAll(ingest_orders(raw).distinct()).isEmpty()
    base = os.path.join(tmp_dir, "stream-dedup")
    sizes = [spark.read.text(f).count() for f in _files(f"{base}/topic")]
    assert sum(sizes) == raw.count() and len(sizes) > 8 and max(sizes) < 1000
    batches = [f for f in _files(f"{base}/_checkpoints/orders/commits") if os.path.basename(f).isdigit()]
    assert len(batches) >= len(sizes) / 4


def _shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f: os.path.getsize(f) for d in dirs for f in _files(d) if os.path.basename(f).startswith("shuffle_")}


def test_dedup_leaves_no_shuffle_and_packs_its_state(spark, tmp_dir, monkeypatch):
    """The shuffles of the join, the dealing and every micro-batch lay there until the driver's heap
    was collected; the log of the state took over 80 bytes a row."""
    monkeypatch.setattr(session, "scratch_dir", lambda _spark, what: os.path.join(tmp_dir, what))
    before = _shuffle_files(spark)
    rows = QUERIES["stream_dedup"](spark, SF_SMALL)
    topic = sum(map(os.path.getsize, _files(os.path.join(tmp_dir, "stream-dedup", "topic"))))
    for _ in range(50):
        left = sum(size for f, size in _shuffle_files(spark).items() if f not in before)
        if left < topic / 50:
            break
        time.sleep(0.1)
    assert left < topic / 50
    logs = [f for f in _files(os.path.join(tmp_dir, "stream-dedup", "_checkpoints")) if f.endswith(".changelog")]
    assert 0 < sum(map(os.path.getsize, logs)) < 70 * rows.count()
    assert all(".zstd." in f for f in _files(os.path.join(tmp_dir, "stream-dedup", "orders")) if f.endswith(".parquet"))


def test_events_are_dealt_by_the_shuffle_of_their_join(spark, tables, no_broadcast):
    """Whole events were shuffled once more to deal them."""
    replayed = adapter.raw_orders_replayed(tables)
    with settings(spark, {**catalog.DEALING, "spark.sql.shuffle.partitions": "64"}):
        dealt = adapter.raw_orders_dealt(tables)
        rows = [tuple(r) for r in dealt.withColumn("part", F.spark_partition_id()).collect()]
        plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == replayed._jdf.queryExecution().executedPlan().toString().count("Exchange")
    assert Counter(r[:-1] for r in rows) == Counter(tuple(r) for r in replayed.collect())
    parts = {}
    for r in rows:
        parts.setdefault(r[:-1], []).append(r[-1])
    copies = [p for p in parts.values() if len(p) > 1]
    assert copies and sum(len(set(p)) == len(p) for p in copies) > 0.8 * len(copies)


def test_more_files_than_asked_for_make_no_more_batches(spark, tmp_dir, monkeypatch):
    """Batches were of half of the files asked for: 20 of 40 files where 4 were asked for."""
    dealt = adapter.raw_orders_dealt
    monkeypatch.setattr(session, "scratch_dir", lambda _spark, what: os.path.join(tmp_dir, what))
    monkeypatch.setattr(adapter, "raw_orders_dealt", lambda t: dealt(t).repartition(40))
    got = QUERIES["stream_dedup"](spark, SF_SMALL)
    raw = adapter.raw_orders_replayed(load_tables(spark, SF_SMALL))
    assert got.count() == ingest_orders(raw).distinct().count()
    base = os.path.join(tmp_dir, "stream-dedup")
    assert len(_files(f"{base}/topic")) == 40
    commits = [f for f in _files(f"{base}/_checkpoints/orders/commits") if os.path.basename(f).isdigit()]
    assert 2 <= len(commits) <= 4
