"""A topic in folders of arrival hours, polled without listing what is done.

Publishers add files to the folder of the hour at which they publish
(``<topic>/arrival=2025110310``).  A poll lists the names of the hours and the files of the
open ones only.  Each hour is read by a single-pass stream of its own, with its own
checkpoint: the topic is parsed once for orders and rejects, and every batch is published
whole.  An hour that ended more than ``grace_hours`` ago, and was read after that, is closed by a
record and never listed again.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from fraudlens.schemas import ORDERS
from fraudlens.sources.topic import publish_orders
from fraudlens.sources.versions import VersionLog
from fraudlens.streaming.ingest import REJECTS, ensure_dir, published_paths, start_order_ingest

# --- fixed values ------------------------------------------------------------
HOUR = "%Y%m%d%H"
PREFIX = "arrival="
GRACE_HOURS = 2    # a publisher may take so long to finish a file of its hour
# -------------------------------------------------------------------------------


def publish_arrivals(df: DataFrame, topic_dir: str, now: datetime, **files: str) -> None:
    """Add raw order events to the folder of the hour ``now``."""
    publish_orders(df, f"{topic_dir.rstrip('/')}/{PREFIX}{now.strftime(HOUR)}", **files)


def _hours(spark: SparkSession, folder: str) -> list[str]:
    """Names of the hours below ``folder``, earliest first; no files are listed."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(n.removeprefix(PREFIX) for n in names if n.startswith(PREFIX))


def _closed(spark: SparkSession, checkpoint_dir: str) -> VersionLog:
    return VersionLog(spark, f"{checkpoint_dir.rstrip('/')}/closed")


def open_hours(spark: SparkSession, topic_dir: str, checkpoint_dir: str) -> list[str]:
    """Hours of the topic that aren't closed, earliest first."""
    last = _closed(spark, checkpoint_dir).read().get("up_to", "")
    return [h for h in _hours(spark, topic_dir) if h > last]


def ingest_open(
    spark: SparkSession,
    topic_dir: str,
    orders_out: str,
    checkpoint_dir: str,
    now: datetime,
    rejects_out: str | None = None,
    grace_hours: int = GRACE_HOURS,
    sweep: bool = False,
    max_files_per_trigger: int | None = None,
) -> list[str]:
    """One poll: read what the open hours hold and haven't given yet; returns these hours.

    ``now`` is the clock at the poll's start.  A poll that fails leaves its hours open, and the
    next one goes on from their checkpoints.  A file that comes to an hour after it is closed
    waits for a ``sweep``, which reads all hours; their checkpoints tell what is new.
    Polls of one topic must not overlap.
    """
    ensure_dir(spark, topic_dir)
    base, ckpt = topic_dir.rstrip("/"), checkpoint_dir.rstrip("/")
    hours = _hours(spark, base) if sweep else open_hours(spark, base, ckpt)
    for h in hours:
        start_order_ingest(
            spark,
            f"{base}/{PREFIX}{h}",
            f"{orders_out}/{PREFIX}{h}",
            f"{ckpt}/{PREFIX}{h}",
            rejects_out and f"{rejects_out}/{PREFIX}{h}",
            available_now=True,
            single_pass=True,
            max_files_per_trigger=max_files_per_trigger,
        ).await_all()
    log = _closed(spark, ckpt)
    ended = [h for h in hours if datetime.strptime(h, HOUR) + timedelta(hours=1 + grace_hours) <= now]
    if ended and ended[-1] > log.read().get("up_to", ""):
        log.publish(log.number() + 1, {"up_to": ended[-1]})
    return hours


def read_arrivals(spark: SparkSession, checkpoint_dir: str, which: str = "orders") -> DataFrame:
    """``orders`` or ``rejects`` of every batch that the polls have published."""
    base = checkpoint_dir.rstrip("/")
    paths = [p for h in _hours(spark, base) for p in published_paths(spark, f"{base}/{PREFIX}{h}", which)]
    schema = ORDERS if which == "orders" else REJECTS
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
