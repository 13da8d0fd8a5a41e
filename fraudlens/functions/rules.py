"""The four fraud rules as boolean columns.

A row is 'fraud' when any rule holds.  The original flow checks the rules
one after another and only ever moves a row from 'genuine' to 'fraud', so the
verdict is the OR of the four rules whatever their order.

NULL handling: country NULL counts as foreign (rule B); a NULL quantity or
payment method makes only the sub-condition that reads it false, so amount,
country and payment still decide.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: thresholds and lists of the rule set -------------------
CRITICAL_HOUR_END = 5                 # rule A: hour 0..4 (00:00 to 04:59)
CRITICAL_AMOUNT = 100_000_000         # rule A: amount >= 100 million
CRITICAL_QUANTITY = 100               # rule A: quantity > 100
HOME_COUNTRY = "ID"                   # rule B: any other country (or none)
ANOMALY_AMOUNT = 300_000_000          # rule C: amount >= 300 million
ANOMALY_QUANTITY = 300                # rule C: quantity > 300
LIMITED_PAYMENTS = ["DANA", "OVO", "Gopay", "Paylater"]  # rule D
LIMITED_PAYMENT_MAX = 50_000_000      # rule D: amount > 50 million
FRAUD = "fraud"
GENUINE = "genuine"
# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rule_critical_hour(hour, amount, quantity) -> Column:
    """A: placed between 00:00 and 04:59 with a large amount or quantity."""
    h, a, q = _col(hour), _col(amount), _col(quantity)
    big = (a >= F.lit(CRITICAL_AMOUNT)) | (q > F.lit(CRITICAL_QUANTITY))
    return F.coalesce((h >= 0) & (h < CRITICAL_HOUR_END) & big, F.lit(False))


def rule_foreign_country(country) -> Column:
    """B: country other than ID; a missing country counts as foreign."""
    return ~_col(country).eqNullSafe(F.lit(HOME_COUNTRY))


def rule_anomaly(amount, quantity) -> Column:
    """C: amount of 300 million or more, or more than 300 items."""
    a, q = _col(amount), _col(quantity)
    return F.coalesce((a >= F.lit(ANOMALY_AMOUNT)) | (q > F.lit(ANOMALY_QUANTITY)), F.lit(False))


def rule_wallet_limit(payment_method, amount) -> Column:
    """D: e-wallet / paylater payment above 50 million."""
    p, a = _col(payment_method), _col(amount)
    return F.coalesce(p.isin(LIMITED_PAYMENTS) & (a > F.lit(LIMITED_PAYMENT_MAX)), F.lit(False))


def is_fraud(hour, amount, quantity, country, payment_method) -> Column:
    return (
        rule_critical_hour(hour, amount, quantity)
        | rule_foreign_country(country)
        | rule_anomaly(amount, quantity)
        | rule_wallet_limit(payment_method, amount)
    )


def fraud_status(hour, amount, quantity, country, payment_method) -> Column:
    """'fraud' / 'genuine' verdict for one order."""
    return F.when(is_fraud(hour, amount, quantity, country, payment_method), F.lit(FRAUD)).otherwise(F.lit(GENUINE))
