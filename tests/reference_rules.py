"""Row-at-a-time restatement of the ingest semantics, for brute-force checks
of the Spark operators on small fixtures (tests only)."""

from __future__ import annotations

import datetime as dt
import re

WALLETS = ("DANA", "OVO", "Gopay", "Paylater")


def clean_amount(text):
    if text is None:
        return None
    digits = re.sub(r"[^0-9]", "", text)
    return float(digits) if digits else None


def parse_clock(text):
    if text is None:
        return None
    try:
        return dt.datetime.fromisoformat(text).replace(tzinfo=None)
    except ValueError:
        return None


def verdict(order: dict):
    """'fraud' / 'genuine' or None when the row is rejected."""
    amount = clean_amount(order.get("amount"))
    if amount is None:
        return None
    ts = parse_clock(order.get("created_date"))
    if ts is None:
        return None
    q = order.get("quantity")

    def gt(a, b):
        return a is not None and a > b

    a = 0 <= ts.hour < 5 and (amount >= 100_000_000 or gt(q, 100))
    b = order.get("country") != "ID"
    c = amount >= 300_000_000 or gt(q, 300)
    d = order.get("payment_method") in WALLETS and amount > 50_000_000
    return "fraud" if (a or b or c or d) else "genuine"
