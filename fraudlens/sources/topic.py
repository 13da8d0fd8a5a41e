"""The order topic: a directory of immutable JSON-lines files.

Publishers add new files (never append to an existing one: a file source
does not re-read a file it has already listed); readers, batch or
streaming, read every line with the declared wire schema in PERMISSIVE
mode so a malformed line becomes a row with ``_corrupt_record`` set
instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fraudlens.schemas import CORRUPT_COL, RAW_ORDER, WIRE_ORDER

# --- fixed values: files of a large publication ---------------------------------
TOPIC_FILES = {
    "compression": "gzip",                  # a tenth of the text; the extension tells the readers
    "zlib.compress.level": "BEST_SPEED",
    "maxRecordsPerFile": "200000",          # one task reads a compressed file, and tasks take files by their size
}
# -------------------------------------------------------------------------------


def publish_orders(df: DataFrame, topic_dir: str, **files: str) -> None:
    """Append raw order events to the topic as new JSON-lines files.

    ``files`` are options of the writer; a large publication takes TOPIC_FILES.  Plain and
    compressed files may lie side by side.
    """
    df.select(*RAW_ORDER.fieldNames()).write.mode("append").option("ignoreNullFields", "false").options(**files).json(topic_dir)


def publish_lines(df: DataFrame, topic_dir: str, **files: str) -> None:
    """Append ready lines, whatever they hold, to the topic (``df`` has one text column)."""
    df.write.mode("append").options(**files).text(topic_dir)


def _reader(r):
    return (
        r.schema(WIRE_ORDER)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COL)
    )


def read_topic(spark: SparkSession, topic_dir: str) -> DataFrame:
    """Batch read of everything on the topic."""
    return _reader(spark.read).json(topic_dir)


# --- fixed values --------------------------------------------------------------
MAX_FILES_PER_TRIGGER = 1000    # bounds the first micro-batch over a backlog
MAX_FILE_AGE = "36500d"         # a file is read however much older than the newest it is
# -------------------------------------------------------------------------------


def read_topic_stream(
    spark: SparkSession,
    topic_dir: str,
    max_files_per_trigger: int | None = None,
    max_file_age: str = MAX_FILE_AGE,
    archive_dir: str | None = None,
) -> DataFrame:
    """Streaming read: each micro-batch holds files added since the last, at most
    ``max_files_per_trigger`` (default MAX_FILES_PER_TRIGGER).

    The file source skips files older than ``max_file_age`` counted from the newest
    one it has seen, so a short age would lose late back-fills.  The folder is listed
    at every poll; with ``archive_dir`` consumed files move there, which keeps
    the listing short (one stream per topic folder, then).
    """
    r = _reader(spark.readStream).option("maxFileAge", max_file_age)
    r = r.option("maxFilesPerTrigger", str(max_files_per_trigger or MAX_FILES_PER_TRIGGER))
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return r.json(topic_dir)
