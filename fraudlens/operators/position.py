"""Position of every row in a total order, without a window over all rows.

The rows are sorted by a range shuffle and written with the place that each task gives
them: its partition and its count within.  Ranges follow one another, so a row's position
is its count plus the rows of the partitions before.  Those sums are as many as partitions.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlens.session import scratch_dir

PLACE = "_place"
ROW_BITS = 33    # of a place; the bits above are the partition (monotonically_increasing_id)


def with_position(df: DataFrame, *keys: Column | str, name: str = "position", folder: str | None = None) -> DataFrame:
    """``df`` with ``name``: 1 for the first row by ``keys``, 2 for the next, and so on.

    Rows that tie in ``keys`` get positions of their own in no stated order, so add keys
    until the order is total where it matters.  Ties, equal rows included, may lie in
    several ranges: a last key that only splits them follows the given ones.  An empty
    ``df`` gives an empty result.  The sorted rows are written to ``folder`` (by default a
    new one under the checkpoint folder), so a lost executor doesn't change a position.
    """
    spark = df.sparkSession
    path = folder or scratch_dir(spark, "position")
    split = "_split"
    placed = (
        df.withColumn(split, F.monotonically_increasing_id())
        .orderBy(*keys, split)
        .drop(split)
        .withColumn(PLACE, F.monotonically_increasing_id())
    )
    placed.write.parquet(path)
    rows = spark.read.schema(placed.schema).parquet(path)
    part = F.shiftright(PLACE, ROW_BITS)
    counts = sorted(tuple(r) for r in rows.groupBy(part.alias("part")).count().collect())  # one row for each partition
    before = list(accumulate((n for _, n in counts), initial=0))
    sums = spark.createDataFrame([(p, b) for (p, _), b in zip(counts, before, strict=False)], "_part int, _before long")
    within = F.col(PLACE) - F.shiftleft(part.cast("long"), ROW_BITS)
    return (
        rows.withColumn("_part", part.cast("int"))
        .join(F.broadcast(sums), "_part")
        .withColumn(name, F.col("_before") + within + 1)
        .drop("_part", "_before", PLACE)
    )
