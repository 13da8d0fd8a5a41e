"""Order ingest: clean, validate and flag raw order events.

The same functions run on a batch DataFrame and on a streaming one
(``readStream``): they are stateless per-row projections and filters, so a
micro-batch plan is the same scan -> project -> filter as the batch plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlens.functions.amount import amount_value
from fraudlens.functions.rules import fraud_status
from fraudlens.functions.timefmt import may_be_on, with_wall_clock
from fraudlens.schemas import CORRUPT_COL, ORDER_LENGTHS, RAW_ORDER

# --- fixed values: reject reasons ------------------------------------------
BAD_JSON = "bad_json"
BAD_AMOUNT = "bad_amount"
BAD_DATE = "bad_date"
TOO_LONG = "too_long"
# ----------------------------------------------------------------------------


def _with_checks(raw: DataFrame) -> DataFrame:
    """Raw columns and what the checks read, each worked out once for each line."""
    corrupt = F.col(CORRUPT_COL) if CORRUPT_COL in raw.columns else F.lit(None).cast("string")
    # the topic gives a quantity as text; one that is no whole number makes the line bad
    quantity = F.col("quantity").cast("string").try_cast("int")
    lines = raw.select(*RAW_ORDER.fieldNames(), corrupt.alias("_corrupt"), quantity.alias("_quantity"))
    return with_wall_clock(
        lines,
        "created_date",
        "_ts",
        _amount=amount_value("amount"),
        _bad_line=F.col("_corrupt").isNotNull() | (F.col("quantity").isNotNull() & F.col("_quantity").isNull()),
        _too_long=_too_long(),
    )


def _too_long():
    longer = F.lit(False)
    for name, most in ORDER_LENGTHS.items():
        longer = longer | F.coalesce(F.length(name) > most, F.lit(False))
    return longer


def _reason():
    # checked in the order of the original flow: line, then amount, then date
    return (
        F.when(F.col("_bad_line"), F.lit(BAD_JSON))
        .when(F.col("_amount").isNull(), F.lit(BAD_AMOUNT))
        .when(F.col("_ts").isNull(), F.lit(BAD_DATE))
        .when(F.col("_too_long"), F.lit(TOO_LONG))
    )


def ingest_orders(raw: DataFrame) -> DataFrame:
    """Raw events -> ingested orders (ORDERS schema) with a fraud verdict.

    Lines that did not parse as JSON or hold a quantity that is no whole number,
    amounts with no digits, dates that are not ISO-8601 and texts longer than their
    column are dropped (see :func:`order_rejects`).  The stored
    ``amount`` keeps its raw text; the staging model cleans it again.
    """
    good = ~F.col("_bad_line") & F.col("_amount").isNotNull() & F.col("_ts").isNotNull() & ~F.col("_too_long")
    return _with_checks(raw).filter(good).select(
        "order_id",
        "user_id",
        "product_id",
        F.col("_quantity").alias("quantity"),
        "amount",
        "payment_method",
        "country",
        F.col("_ts").alias("created_date"),
        fraud_status(F.hour("_ts"), "_amount", "_quantity", "country", "payment_method").alias("status"),
    )


def ingest_day(raw: DataFrame, run_date) -> DataFrame:
    """The ingested orders of the day before ``run_date``, straight from raw events: texts
    that can't name that day are left out before anything is parsed."""
    from fraudlens.operators.warehouse import daily_slice, previous_day

    return daily_slice(ingest_orders(raw.filter(may_be_on("created_date", previous_day(run_date)))), "created_date", run_date)


def order_rejects(raw: DataFrame) -> DataFrame:
    """The rows :func:`ingest_orders` drops, each with its reason.

    Every raw column is part of the output, and the line's text where the line
    itself is bad.
    """
    columns = [F.col("_quantity").alias(c) if c == "quantity" else F.col(c) for c in RAW_ORDER.fieldNames()]
    line = F.coalesce("_corrupt", F.to_json(F.struct(*RAW_ORDER.fieldNames())))
    checked = _with_checks(raw).withColumn("reason", _reason()).filter(F.col("reason").isNotNull())
    return checked.select(*columns, "reason", F.when(F.col("_bad_line"), line).alias("raw_record"))


def clean_amount(raw: DataFrame) -> DataFrame:
    """Both readings of the amount text: rule input (DOUBLE) and the staged
    ``total_amount`` (BIGINT)."""
    from fraudlens.functions.amount import amount_digits, total_amount

    return raw.select(
        "order_id",
        "amount",
        amount_digits("amount").alias("amount_digits"),
        amount_value("amount").alias("amount_value"),
        total_amount("amount").alias("total_amount"),
    )


def fraud_rules(orders: DataFrame) -> DataFrame:
    """Each rule as its own flag next to the verdict, for ingested orders
    (raw ``amount`` text, parsed ``created_date``).  ``status`` is 'fraud'
    exactly when one of the four flags is true."""
    from fraudlens.functions import rules as R

    amount = amount_value("amount")
    hour = F.hour("created_date")
    return orders.select(
        "order_id",
        "created_date",
        "status",
        R.rule_critical_hour(hour, amount, "quantity").alias("rule_critical_hour"),
        R.rule_foreign_country("country").alias("rule_foreign_country"),
        R.rule_anomaly(amount, "quantity").alias("rule_anomaly"),
        R.rule_wallet_limit("payment_method", amount).alias("rule_wallet_limit"),
    )
