"""Exact de-duplication by a stream with disk-backed keyed state.

Each arriving row is appended to a landing folder with a digest of its text, its id and a
locator, by which its text is found there.  A stream reads digest, id and locator from that folder
and keeps state by digest, without a watermark and so without expiry: the number
of rows and the row with the largest (id, locator).  The state lives in RocksDB under the checkpoint
folder; a stream started again there goes on where it ended.  The state store
is then read as a table.

Hits, the digests that more than one row has, are checked on full bytes: the landed
texts of those rows, of whichever call, are grouped by the whole text, and a digest that turns out
to hold several texts is decided text by text.

Only DataFrame operations run here, on the driver and the executors.

Results in odd cases: a null text counts as empty; rows without an id take part
and lose against any id; of rows of equal id and text one stays;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlens.llm.common import restricted, texts_of, written
from fraudlens.session import scratch_dir

#: State on disk; files take the space they fill, as a store has one set of
#: files for each partition.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
STREAMED = "digest binary, doc_id bigint, locator bigint"
LANDED = STREAMED + ", text string"


def sha256_bytes(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def land(docs: DataFrame, folder: str, digest, call: str) -> None:
    """Append digest, id, locator and text of every row to the landing folder; no row of this
    or another call has the same locator."""
    locator = F.xxhash64(F.lit(call), F.monotonically_increasing_id())
    docs.select(digest(F.col("text")).alias("digest"), "doc_id", locator.alias("locator"), "text").write.mode("append").parquet(folder)


def run_stream(spark: SparkSession, folder: str, checkpoint: str) -> None:
    """Take in everything that has landed since the last run."""
    before = {name: spark.conf.get(name, None) for name in STATE_CONF}
    for name, value in STATE_CONF.items():
        spark.conf.set(name, value)
    try:
        kept = F.max(F.struct(F.coalesce("doc_id", F.lit(-(2**63))).alias("id"), "locator", "doc_id"))
        query = (
            spark.readStream.schema(STREAMED)
            .option("maxFileAge", "36500d")
            .parquet(folder)
            .groupBy("digest")
            .agg(F.count(F.lit(1)).alias("n"), kept.alias("top"))
            .writeStream.outputMode("update")
            .format("noop")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def read_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """digest, group_size, keep_id, keep_locator of every key in the state."""
    state = spark.read.format("statestore").load(checkpoint)
    # the value holds the aggregation buffers in the order of the aggregates
    count, top = (F.col(f"value.`{f.name}`") for f in state.schema["value"].dataType.fields[-2:])
    return state.select(
        F.col("key").getItem(state.schema["key"].dataType.names[0]).alias("digest"),
        count.alias("group_size"),
        top.getField("doc_id").alias("keep_id"),
        top.getField("locator").alias("keep_locator"),
    )


def exact_dedup(
    docs: DataFrame, folder: str | None = None, digest=sha256_bytes, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, locator, keep_id, group_size, kept and digest, one row for each
    row of ``docs``.  Of equal texts the row with the largest id stays.

    ``folder`` (default: a new one under the checkpoint folder) holds the landing
    files, texts included, and the stream's checkpoint; a later call with it adds its rows to
    those taken in before, and the result covers all of them.  Rows of a call that failed
    may have landed: repeat it with no rows, or they count twice.  ``digest`` may be
    any function of the text: rows are only ever joined on equal bytes.
    """
    spark = docs.sparkSession
    docs = texts_of(docs, id_col, text_col)
    base = folder or scratch_dir(spark, "exact-dedup")
    land(docs, f"{base}/landed", digest, uuid.uuid4().hex)
    run_stream(spark, f"{base}/landed", f"{base}/checkpoint")
    landed = spark.read.schema(LANDED).parquet(f"{base}/landed")
    # the state, one row for each digest, is written once and read from files
    state = written(read_state(spark, f"{base}/checkpoint"), "state")
    decided = landed.drop("text").join(state, "digest")

    # full bytes of the hits: equal texts meet before the shuffle, one row for each task and text
    hits = restricted(landed.select("digest", "text"), state.where("group_size > 1").select("digest"), "digest")
    by_text = hits.groupBy("digest", "text").agg(F.count(F.lit(1)).alias("n"))
    mixed = written(by_text.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("digest"), "mixed")
    if not mixed.isEmpty():
        decided = decided.join(mixed, "digest", "left_anti").unionByName(by_full_text(landed, mixed))
    kept = (F.col("locator") == F.col("keep_locator")) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return decided.select("doc_id", "locator", "keep_id", "group_size", kept.alias("kept"), "digest")


def by_full_text(landed: DataFrame, mixed: DataFrame) -> DataFrame:
    """Decisions for rows whose digest several texts share, by the texts."""
    rows = landed.join(mixed, "digest", "left_semi")
    top = F.max(F.struct(F.coalesce("doc_id", F.lit(-(2**63))).alias("id"), "locator", "doc_id")).alias("top")
    tops = rows.groupBy("digest", "text").agg(F.count(F.lit(1)).alias("group_size"), top)
    return rows.join(tops, ["digest", "text"]).select(
        "digest", "doc_id", "locator", "group_size", F.col("top.doc_id").alias("keep_id"), F.col("top.locator").alias("keep_locator")
    )
