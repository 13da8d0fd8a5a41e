"""Structured Streaming order ingest: topic -> clean / flag -> orders table.

The stream runs the very same ``ingest_orders`` / ``order_rejects``
projections as the batch path; Spark executes them per micro-batch.
Delivery is exactly-once per output: the file source records which topic
files each batch read and the Parquet sink commits each batch once in its
own checkpoint, so a restart resumes where it stopped and adds no rows.

No watermark by default: every event is handled on its own, so a late
event is still ingested.  ``dedup_delay`` opts into dropping replayed
events (identical rows) that arrive within that delay of each other.
"""

from __future__ import annotations

import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fraudlens.operators.ingest import ingest_orders, order_rejects
from fraudlens.schemas import ORDERS, RAW_ORDER
from fraudlens.sources.topic import read_topic_stream
from fraudlens.sources.versions import VersionLog, VersionTaken

REJECTS = T.StructType([*RAW_ORDER.fields, T.StructField("reason", T.StringType()), T.StructField("raw_record", T.StringType())])

# --- fixed values ------------------------------------------------------------
POLL_INTERVAL = "500 milliseconds"    # how often an idle topic is polled
# -------------------------------------------------------------------------------


def ensure_dir(spark: SparkSession, path: str) -> None:
    """Create ``path`` if absent, on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        fs.mkdirs(p)


def _has_files(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and len(fs.listStatus(p)) > 0


# --- fixed values: state of the replay drop, on disk beside the executors' heap -----
# Shuffle files of a write or a micro-batch go when it has ended, not when the driver's heap is collected.
SHUFFLE_CLEANUP = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
STATE_SETTINGS = {
    **SHUFFLE_CLEANUP,
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # rows as keys are text: half of LZ4's bytes, in the change logs and in the tables
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.minBatchesToRetain": "10",    # of the state and its logs; a restart takes the last
}
SINK_COMPRESSION = "zstd"
# ---------------------------------------------------------------------------------------


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """The settings for what is started within; a query keeps those it was started with, and
    a checkpoint its state store."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def dedup_replays(orders: DataFrame, delay: str) -> DataFrame:
    """Drop identical order rows that arrive again within ``delay`` of the first.

    Full-row key, so rows are told apart by their bytes: two different orders that
    share an order_id both stay.  :func:`start_order_ingest` keeps the state in RocksDB.  The
    watermark runs on the arrival clock of the micro-batch, not on the event
    clock: a late original is never behind it, and an event dated in the far
    future doesn't move it.
    """
    return (
        orders.withColumn("_arrival", F.current_timestamp())
        .withWatermark("_arrival", delay)
        .dropDuplicatesWithinWatermark(ORDERS.fieldNames())
        .drop("_arrival")
    )


@dataclass
class IngestStreams:
    orders: StreamingQuery
    rejects: StreamingQuery | None

    def await_all(self, timeout: float | None = None) -> None:
        """Wait until all streams have ended; if one fails, stop the others and raise."""
        queries = [q for q in (self.orders, self.rejects) if q is not None]
        until = None if timeout is None else time.monotonic() + timeout
        while True:
            for q in queries:
                if q.exception() is not None:
                    self.stop()
                    q.awaitTermination()
            active = [q for q in queries if q.isActive]
            if not active or (until is not None and time.monotonic() >= until):
                return
            active[0].awaitTermination(0.5)

    def stop(self) -> None:
        for q in (self.orders, self.rejects):
            if q is not None and q.isActive:
                q.stop()


BATCH_COL = "batch_id"


def _batch_log(spark: SparkSession, checkpoint_dir: str) -> VersionLog:
    return VersionLog(spark, f"{checkpoint_dir.rstrip('/')}/published")


def write_both(orders_out: str, rejects_out: str | None, checkpoint_dir: str):
    """``foreachBatch`` function of the single-pass mode.

    The micro-batch is parsed once (persisted), then accepted orders and
    rejects are written to a folder of this attempt, ``<out>/batch_id=<n>/attempt=<id>``,
    and published by one record for both.  A batch that is tried again (it has the same id
    and the same input, as the source logs its offsets before running it) is published
    once: what an attempt that died has left is in no record, and a batch that was published
    before the failure isn't written again.  :func:`read_published` follows the records,
    so it sees whole batches only.
    """
    from pyspark import StorageLevel

    def fn(batch: DataFrame, batch_id: int) -> None:
        log = _batch_log(batch.sparkSession, checkpoint_dir)
        if log.number() > batch_id:
            return
        attempt = f"{BATCH_COL}={batch_id}/attempt={uuid.uuid4().hex}"
        record = {"orders": f"{orders_out}/{attempt}"}
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            ingest_orders(batch).write.parquet(record["orders"])
            if rejects_out:
                record["rejects"] = f"{rejects_out}/{attempt}"
                order_rejects(batch).write.parquet(record["rejects"])
        finally:
            batch.unpersist()
        try:
            log.publish(batch_id + 1, record)
        except VersionTaken:
            pass  # another attempt of this batch was first

    return fn


def published_paths(spark: SparkSession, checkpoint_dir: str, which: str = "orders") -> list[str]:
    """Folders of every batch that the single-pass mode has published."""
    log = _batch_log(spark, checkpoint_dir)
    records = [log.read(n) for n in range(1, log.number() + 1)]
    return [r[which] for r in records if which in r]


def read_published(spark: SparkSession, checkpoint_dir: str, which: str = "orders") -> DataFrame:
    """``orders`` or ``rejects`` of every batch that the single-pass mode has published."""
    schema = ORDERS if which == "orders" else REJECTS
    paths = published_paths(spark, checkpoint_dir, which)
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def start_order_ingest(
    spark: SparkSession,
    topic_dir: str,
    orders_out: str,
    checkpoint_dir: str,
    rejects_out: str | None = None,
    available_now: bool = False,
    dedup_delay: str | None = None,
    max_files_per_trigger: int | None = None,
    single_pass: bool = False,
    archive_dir: str | None = None,
) -> IngestStreams:
    """Start the ingest stream(s).

    ``available_now=True`` processes what is on the topic and stops (batch
    catch-up, tests); otherwise the topic is polled every 500 ms.  By
    default, accepted orders and rejects are two queries with separate
    checkpoints (``<checkpoint_dir>/orders``, ``<checkpoint_dir>/rejects``),
    each exactly-once on its own file sink (with its commit log).
    ``single_pass=True`` parses the topic once and writes both outputs from
    one ``foreachBatch`` query, batches published as a whole (see
    :func:`write_both`); it does not combine with ``dedup_delay``.
    ``archive_dir`` moves consumed topic files away, which needs one reader: it goes
    with ``single_pass`` or without ``rejects_out`` only.
    A non-empty output without its checkpoint is refused: batch numbers would start
    again and overwrite what is there.
    """
    ensure_dir(spark, topic_dir)
    ckpt = checkpoint_dir.rstrip("/")

    def _trigger(w):
        return w.trigger(availableNow=True) if available_now else w.trigger(processingTime=POLL_INTERVAL)

    def _start(df: DataFrame, out: str, name: str) -> StreamingQuery:
        w = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{ckpt}/{name}")
        w = w.option("compression", SINK_COMPRESSION)
        return _trigger(w).start(out)

    if archive_dir and rejects_out and not single_pass:
        raise ValueError("two queries read the topic: archive_dir needs single_pass")
    raw = read_topic_stream(spark, topic_dir, max_files_per_trigger, archive_dir=archive_dir)
    if single_pass:
        if dedup_delay:
            raise ValueError("single_pass does not combine with dedup_delay")
        if _has_files(spark, orders_out) and not _has_files(spark, f"{ckpt}/both"):
            raise ValueError(f"{orders_out} holds data, but its checkpoint {ckpt}/both is missing")
        w = raw.writeStream.foreachBatch(write_both(orders_out, rejects_out, ckpt)).option("checkpointLocation", f"{ckpt}/both")
        return IngestStreams(_trigger(w).start(), None)
    orders = ingest_orders(raw)
    if dedup_delay:
        orders = dedup_replays(orders, dedup_delay)
    with settings(spark, STATE_SETTINGS if dedup_delay else {}):
        q_orders = _start(orders, orders_out, "orders")
    q_rejects = _start(order_rejects(raw), rejects_out, "rejects") if rejects_out else None
    return IngestStreams(q_orders, q_rejects)
