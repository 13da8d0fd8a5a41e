"""Record composition operators: e-mail addresses, product names, currency
text and keys, as columns added to any DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.functions import text as X


def with_email(df: DataFrame, style, first="first_name", last="last_name", digit=None, domain="domain", out: str = "email") -> DataFrame:
    """Add an e-mail column.

    ``style`` is one of ``first_last`` / ``first_digit`` / ``last_initial``
    for the whole frame, or a column holding 1 / 2 / 3 per row.
    ``first_digit`` needs ``digit`` (a column of the caller).
    """
    if isinstance(style, str):
        if style == "first_last":
            col = X.email_first_last(first, last, domain)
        elif style == "first_digit":
            if digit is None:
                raise ValueError("first_digit style needs a digit column")
            col = X.email_first_digit(first, digit, domain)
        elif style == "last_initial":
            col = X.email_last_initial(last, first, domain)
        else:
            raise ValueError(f"unknown e-mail style {style!r}; one of {X.EMAIL_STYLES}")
    else:
        col = X.email_by_style(style, first, last, digit if digit is not None else F.lit(None), domain)
    return df.withColumn(out, col)


def with_product_name(df: DataFrame, category="category", part_a="part_a", part_b="part_b", part_c="part_c", out: str = "product_name") -> DataFrame:
    """Add a product name built by the category's template from three columns."""
    return df.withColumn(out, X.product_name(category, part_a, part_b, part_c))


def with_currency(df: DataFrame, amount: str, out: str = "amount") -> DataFrame:
    """Add ``Rp.``-formatted text of an integer amount column."""
    return df.withColumn(out, X.currency_text(amount))
