"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import fraudlens
from fraudlens.session import scratch_dir

#: A list of ids is broadcast up to this many rows (8-byte ids: about 4 MB,
#: 20 MB as a hash relation); beyond it the join shuffles both sides.
BROADCAST_IDS = 500_000

#: Bytes of text a Python function works on at once; one longer document is
#: worked on alone.
SLICE_BYTES = 2_000_000


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once for each context, so
    that Python workers can import them wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_fraudlens_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(fraudlens.__file__))
    handle, path = tempfile.mkstemp(prefix="fraudlens-", suffix=".zip")
    with os.fdopen(handle, "wb") as out, zipfile.ZipFile(out, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("fraudlens", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._fraudlens_shipped = True


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: the rows are
    computed once, and a lost executor re-reads files instead of recomputing."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, whatever else ``docs`` carries; a
    null text counts as empty."""
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def restricted(rows: DataFrame, ids: DataFrame, key: str, limit: int = BROADCAST_IDS) -> DataFrame:
    """Rows whose ``key`` is in ``ids`` (one column of that name, stored).
    Few ids are broadcast, so the rows that stay need no shuffle before this;
    more than ``limit`` ids are joined by a shuffle of both sides."""
    ids = ids.select(key).distinct()
    if ids.limit(limit + 1).count() <= limit:
        return rows.join(F.broadcast(ids), key, "left_semi")
    return rows.hint("merge").join(ids, key, "left_semi")


def without(rows: DataFrame, ids: DataFrame, key: str, limit: int = BROADCAST_IDS) -> DataFrame:
    """Rows whose ``key`` is not in ``ids``, joined as in ``restricted``; rows
    without a key stay."""
    ids = ids.select(key).distinct()
    if ids.limit(limit + 1).count() <= limit:
        return rows.join(F.broadcast(ids), key, "left_anti")
    return rows.hint("merge").join(ids, key, "left_anti")


def sampled(share: Column | float, *keys: str) -> Column:
    """True for about ``share`` of the rows, by a hash of ``keys`` to 63 bits, so that a
    share of many billions of rows is not rounded to nothing."""
    share = share if isinstance(share, Column) else F.lit(float(share))
    return F.shiftrightunsigned(F.xxhash64(*keys), 1).cast("double") < share * 2.0**63


def release_unused() -> None:
    """Give back what Arrow keeps for later at the end of a task: the worker that ran it stays,
    beside others and the JVM, and its next task may run something else."""
    pa.default_memory_pool().release_unused()


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about ``most`` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(text)).fill_null(0).to_pylist()
        at = size = 0
        for i, n in enumerate(sizes):
            if size and size + n > most:
                yield batch.slice(at, i - at)
                at, size = i, 0
            size += n
        yield batch.slice(at)


def map_slices(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str, text: str = "text") -> DataFrame:
    """``fn`` turns a batch of at most about SLICE_BYTES of text into columns."""
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            out = fn(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[f.name], type=f.type) if not isinstance(out[f.name], pa.Array) else out[f.name] for f in target],
                schema=target,
            )
        release_unused()

    return df.mapInArrow(run, schema)
