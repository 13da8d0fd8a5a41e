"""Amount strings such as ``Rp.125,000,000`` -> numbers.

Both the ingest rule check and the staging model keep only the ASCII digits
of the string and cast what is left; an empty or oversized result is NULL
(``try_cast``), never an error, so a bad row cannot fail a whole task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def amount_digits(amount) -> Column:
    """All characters but 0-9 removed (currency prefix, grouping, sign, point)."""
    return F.regexp_replace(_col(amount), "[^0-9]", "")


def amount_value(amount) -> Column:
    """Ingest-side number used by the fraud rules: DOUBLE, NULL when unusable."""
    return amount_digits(amount).try_cast("double")


def total_amount(amount) -> Column:
    """Staging-side number: BIGINT, NULL when empty or beyond the BIGINT range."""
    return amount_digits(amount).try_cast("bigint")
