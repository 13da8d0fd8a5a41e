"""String compositions: grouped numbers, currency text, keys, e-mail
addresses, product names, blacklist labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: labels and name parts ------------------------------------
CURRENCY_PREFIX = "Rp."
USER_KEY_PREFIX = "U"
PRODUCT_KEY_PREFIX = "P"

BLACKLIST = "Blacklist"
WATCHLIST = "Watchlist"
GOOD_STANDING = "Good Standing"
BLACKLIST_MIN_FRAUD = 3

EMAIL_DOMAINS = ["gmail.com", "yahoo.com", "outlook.com"]

CATEGORIES = ["Electronics", "Office Tools", "Non-Fiction Books"]
# -----------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def grouped_number(n) -> Column:
    """Integer with comma thousands separators (``1234567`` -> ``1,234,567``);
    NULL stays NULL, a negative keeps its sign."""
    return F.format_number(_col(n), 0)


def currency_text(n) -> Column:
    """``Rp.`` + grouped integer, the wire format of order amounts."""
    return F.concat(F.lit(CURRENCY_PREFIX), grouped_number(n))


def prefixed_key(prefix: str, n) -> Column:
    """Key such as ``U123`` / ``P4567`` from a number column."""
    return F.concat(F.lit(prefix), _col(n).cast("string"))


def user_key(n) -> Column:
    return prefixed_key(USER_KEY_PREFIX, n)


def product_key(n) -> Column:
    return prefixed_key(PRODUCT_KEY_PREFIX, n)


def blacklist_label(fraud_count) -> Column:
    """3 or more fraud orders -> Blacklist, 1-2 -> Watchlist, else Good Standing."""
    c = _col(fraud_count)
    return (
        F.when(c >= BLACKLIST_MIN_FRAUD, F.lit(BLACKLIST))
        .when(c > 0, F.lit(WATCHLIST))
        .otherwise(F.lit(GOOD_STANDING))
    )


# ---- e-mail styles -----------------------------------------------------------
EMAIL_STYLES = ("first_last", "first_digit", "last_initial")


def email_first_last(first, last, domain) -> Column:
    """``first.last@domain`` in lower case."""
    return F.concat(F.lower(_col(first)), F.lit("."), F.lower(_col(last)), F.lit("@"), _col(domain))


def email_first_digit(first, digit, domain) -> Column:
    """``first.<digit>@domain``; the digit is a column chosen by the caller."""
    return F.concat(F.lower(_col(first)), F.lit("."), _col(digit).cast("string"), F.lit("@"), _col(domain))


def email_last_initial(last, first, domain) -> Column:
    """``last_<first initial>@domain`` in lower case."""
    initial = F.lower(F.substring(_col(first), 1, 1))
    return F.concat(F.lower(_col(last)), F.lit("_"), initial, F.lit("@"), _col(domain))


def email_by_style(style, first, last, digit, domain) -> Column:
    """Pick one of the three styles per row (``style`` is 1, 2 or 3)."""
    s = _col(style)
    return (
        F.when(s == 1, email_first_last(first, last, domain))
        .when(s == 2, email_first_digit(first, digit, domain))
        .when(s == 3, email_last_initial(last, first, domain))
    )


# ---- product names -----------------------------------------------------------
def product_name(category, part_a, part_b, part_c) -> Column:
    """Name by the category's template, from three columns of the caller:

    Electronics, Office Tools -> ``<a> <b> <c>`` (brand, model or attribute, item)
    Non-Fiction Books         -> ``<a> <b> by <c>`` (topic, suffix, publisher)

    An unknown category has no name.
    """
    c = _col(category)
    return F.when(c.isin(*CATEGORIES[:2]), F.concat_ws(" ", _col(part_a), _col(part_b), _col(part_c))).when(
        c == CATEGORIES[2], F.concat_ws(" ", _col(part_a), _col(part_b), F.lit("by"), _col(part_c))
    )
