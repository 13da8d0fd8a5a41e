"""Join-side helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values ------------------------------------------------------------
# Bytes up to which a join side is broadcast (texts of its values, plus
# ROW_OVERHEAD for each row and VALUE_OVERHEAD for each value).
BROADCAST_MAX_BYTES = 64_000_000
ROW_OVERHEAD, VALUE_OVERHEAD = 32, 8
# -------------------------------------------------------------------------------


def measured_bytes(df: DataFrame) -> int:
    """Bytes that the rows of ``df`` take, measured by one aggregate over them."""
    sizes = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(0))
    per_row = sizes + F.lit(ROW_OVERHEAD + VALUE_OVERHEAD * len(df.columns))
    return df.agg(F.coalesce(F.sum(per_row.cast("bigint")), F.lit(0)).alias("bytes")).first()["bytes"]


def checked_broadcast(dim: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``broadcast(dim)`` when ``dim`` is measured to take at most ``max_bytes``,
    else ``dim`` unchanged (the planner then uses a sort-merge join and AQE handles
    skew).

    Meant for stored tables and small batches: the measure reads the rows once.
    Deciding before planning is what saves the shuffle of the large side; AQE's
    run-time conversion only comes after that side has been shuffled.
    """
    return F.broadcast(dim) if measured_bytes(dim) <= max_bytes else dim
