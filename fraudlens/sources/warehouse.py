"""Warehouse sinks and table lifecycle on Parquet.

- day-partitioned loads (``dt`` = event day): append, or replace only the
  days present in the batch (dynamic partition overwrite) for safe reruns;
- full-refresh table writes for models;
- create-if-absent tables in the session catalog;
- the JSON interchange file of the daily extract (write and typed read back).

Writes go to paths given by the caller (a shared file system on a cluster).
A merge never overwrites the path it reads from: it writes a new path and
the caller switches to it.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlens.functions.timefmt import iso_text
from fraudlens.operators.warehouse import PARTITION_COL, require_not_null, with_partition_day, with_schema
from fraudlens.schemas import required_columns
from fraudlens.sources.json_array import ROWS_PER_FILE, read_json_array, write_json_arrays


def load_daily(
    df: DataFrame,
    path: str,
    schema: T.StructType,
    ts_col: str,
    mode: str = "append",
    table: str = "table",
) -> bool:
    """Typed, checked, day-partitioned load of one extract.

    ``mode="append"`` adds rows (a rerun of the same day duplicates them; the
    staging DISTINCT absorbs that).  ``mode="overwrite_days"`` replaces just
    the ``dt`` partitions present in the batch.  Returns False when the extract is
    empty; no partition is written then.

    The extract is read once, by the write itself, which also counts its rows.
    Rows are rebalanced by day as they are written: small days share a task, and
    AQE splits a day that holds a third of the rows, even at one single clock.
    """
    if mode not in ("append", "overwrite_days"):
        raise ValueError(f"unknown load mode {mode!r}")
    typed = require_not_null(with_schema(df, schema), required_columns(schema), table)
    seen = Observation()
    out = with_partition_day(typed, ts_col).observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = out.hint("rebalance", F.col(PARTITION_COL)).write.partitionBy(PARTITION_COL)
    if mode == "append":
        writer.mode("append").parquet(path)
    else:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    return _rows_seen(seen) > 0


def _rows_seen(seen: Observation) -> int:
    try:
        return seen.get["rows"]
    except Py4JJavaError as e:
        # of an extract found empty at run time nothing is executed, nor observed: an assertion says so
        if e.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return 0


def read_warehouse(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a day-partitioned table; ``dt`` stays available for pruning."""
    full = T.StructType(schema.fields + [T.StructField(PARTITION_COL, T.DateType())])
    return spark.read.schema(full).parquet(path)


def write_table(df: DataFrame, path: str) -> str:
    """Full refresh of a model table."""
    df.write.mode("overwrite").parquet(path)
    return path


def create_table_if_absent(spark: SparkSession, name: str, schema: T.StructType, path: str) -> bool:
    """``CREATE TABLE IF NOT EXISTS`` for a Parquet table at ``path``.
    Returns True when the table was created."""
    if spark.catalog.tableExists(name):
        return False
    try:
        spark.catalog.createTable(name, path=path, source="parquet", schema=schema)
    except AnalysisException:
        if spark.catalog.tableExists(name):  # another job was first
            return False
        raise
    return True


def write_json_extract(df: DataFrame, path: str) -> str:
    """Daily extract as JSON lines, timestamps as ISO-8601 text."""
    _iso_clocks(df).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def write_json_array_extract(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> str:
    """Daily extract as files of one JSON array each, timestamps as ISO-8601 text."""
    return write_json_arrays(_iso_clocks(df), path, rows_per_file)


def _iso_clocks(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            iso_text(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def read_json_extract(spark: SparkSession, path: str, schema: T.StructType, json_array: bool = False) -> DataFrame:
    """Read a JSON extract back with the declared schema (timestamps parsed
    from their ISO text).  ``json_array=True`` reads files that hold one JSON
    array of objects each; a large file is split between tasks."""
    as_text = T.StructType(
        [
            T.StructField(f.name, T.StringType()) if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) else f
            for f in schema.fields
        ]
    )
    raw = read_json_array(spark, path, as_text) if json_array else spark.read.schema(as_text).json(path)
    return with_schema(raw, schema)
