"""Table maintenance operators: daily slices, checks, typed loads, merges.

All are ``DataFrame -> DataFrame``; writing is in ``sources.warehouse``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlens.functions.timefmt import as_date, day_window
from fraudlens.operators.joins import checked_broadcast

PARTITION_COL = "dt"


def previous_day(run_date):
    import datetime as _dt

    return as_date(run_date) - _dt.timedelta(days=1)


def daily_slice(df: DataFrame, ts_col: str, run_date) -> DataFrame:
    """Rows whose ``ts_col`` falls on the day before ``run_date``.

    The day is an explicit parameter (a rerun or backfill selects the same
    rows).  The predicate is a half-open range on the raw column, which the
    Parquet reader can use against row-group statistics; on a day-partitioned
    table (``dt`` column) the partition filter prunes whole directories.
    """
    day = previous_day(run_date)
    start, end = day_window(day)
    cond = (F.col(ts_col) >= start) & (F.col(ts_col) < end)
    if PARTITION_COL in df.columns:
        cond = (F.col(PARTITION_COL) == F.lit(day)) & cond
        df = df.filter(cond).drop(PARTITION_COL)
        return df
    return df.filter(cond)


def date_range(df: DataFrame, ts_col: str, start_day=None, end_day=None) -> DataFrame:
    """Optional [start_day, end_day] window for model runs over a warehouse
    table; prunes ``dt`` partitions when present."""
    if start_day is None and end_day is None:
        return df
    cond = F.lit(True)
    has_dt = PARTITION_COL in df.columns
    if start_day is not None:
        s, _ = day_window(start_day)
        cond = cond & (F.col(ts_col) >= s)
        if has_dt:
            cond = cond & (F.col(PARTITION_COL) >= F.lit(as_date(start_day)))
    if end_day is not None:
        _, e = day_window(end_day)
        cond = cond & (F.col(ts_col) < e)
        if has_dt:
            cond = cond & (F.col(PARTITION_COL) <= F.lit(as_date(end_day)))
    return df.filter(cond)


def require_not_null(df: DataFrame, columns: list[str], table: str = "table") -> DataFrame:
    """Fail the job when a REQUIRED column holds a NULL.

    The check is part of the plan (``assert_true`` in a filter that keeps
    every row), so it runs inside the write job on the executors; nothing is
    counted or collected first.
    """
    if not columns:
        return df
    ok = F.lit(True)
    for c in columns:
        ok = ok & F.col(c).isNotNull()
    msg = f"{table}: NULL in a required column ({', '.join(columns)})"
    return df.filter(F.assert_true(ok, msg).isNull())


def with_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Schema-typed load: the declared columns, in declared order, cast to the
    declared types.  Casts run under ANSI rules, so a value that does not fit
    fails the load instead of turning into NULL."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def with_partition_day(df: DataFrame, ts_col: str) -> DataFrame:
    """Add the ``dt`` day-partition column from the event-time column."""
    return df.withColumn(PARTITION_COL, F.to_date(F.col(ts_col)))


def duplicate_keys(batch: DataFrame, key: str | list[str]) -> DataFrame:
    """Keys that occur more than once in ``batch`` (a map-side combined count)."""
    keys = [key] if isinstance(key, str) else list(key)
    return batch.groupBy(*keys).count().filter(F.col("count") > 1).drop("count")


def upsert(target: DataFrame, batch: DataFrame, key: str | list[str], check_batch: bool = True) -> DataFrame:
    """Insert new keys, replace rows of existing keys with the batch row.

    ``target ⋉̸ batch ∪ batch``: the anti-join only needs the batch keys.
    Measured small, they are broadcast and the target is read without a shuffle;
    a large batch is joined by a shuffle of both sides.  A key twice in one batch
    is an error (the row to keep would be ambiguous), checked with one small
    aggregate job.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if check_batch and not duplicate_keys(batch, keys).isEmpty():
        raise ValueError(f"upsert batch has duplicate keys on {keys}")
    kept = target.join(checked_broadcast(batch.select(*keys)), keys, "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def first_per_key(batch: DataFrame, key: str | list[str], order_by: list[str]) -> DataFrame:
    """One row per key: the first by ``order_by`` (ties broken by the other
    columns, so the pick is deterministic).

    ``min(struct(order..., rest...))`` is a plain aggregate combined map-side,
    so a key that fills a third of the batch still costs one row per split in
    the shuffle (a window over the key would send all of it to one task).
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in batch.columns if c not in keys and c not in order_by]
    packed = F.struct(*[F.col(c) for c in order_by + rest])
    return (
        batch.groupBy(*keys)
        .agg(F.min(packed).alias("_first"))
        .select(*keys, *[F.col(f"_first.{c}").alias(c) for c in order_by + rest])
        .select(*batch.columns)
    )


def insert_if_absent(target: DataFrame, batch: DataFrame, key: str | list[str], order_by: list[str]) -> DataFrame:
    """Insert batch rows whose key is not in the target; existing keys are
    left untouched.  Within the batch the first row of a key wins.

    The target is only asked which of the batch's keys it has: measured small, the
    keys are broadcast to it, and nothing of the target is shuffled but hits."""
    keys = [key] if isinstance(key, str) else list(key)
    asked = batch.select(*keys).distinct()
    present = target.select(*keys).join(checked_broadcast(asked), keys, "left_semi").distinct()
    fresh = first_per_key(batch, keys, order_by).join(present, keys, "left_anti")
    return target.unionByName(fresh.select(*target.columns))
