"""Derive the pipeline's logical inputs from the given star-schema tables.

There is no order topic in the test data, so every order line of
``lineitem`` becomes one raw order event (JSON-shaped, amount as currency
text, created_date as ISO text).  ``customer`` becomes the user table and
``part`` the product table.  Key-derived cases plant the bad and edge rows
the pipeline has to handle: empty and over-long amounts, unparsable dates,
missing countries, replayed events, orders of users and products that don't
exist, and products with a second price version.

All of it is plain joins and projections, so the derived tables grow with
the inputs; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlens.functions.text import product_key, user_key
from fraudlens.sources.tables import TableSet

# --- fixed values of the derivation -----------------------------------------
PAYMENT_CYCLE = ["Bank Transfer", "Paylater", "Credit Card", "Gopay", "OVO", "DANA"]
EMPTY_AMOUNT = "Rp."
OVERSIZED_AMOUNT = "Rp.99,999,999,999,999,999,999"
BAD_DATE = "not-a-date"
USER_CLOCK_START = "2025-11-01 00:00:00"
PRODUCT_CLOCK_START = "2025-11-01 00:00:00"
PRODUCT_REPRICE_START = "2025-11-20 00:00:00"
DEFAULT_PAYMENT_CYCLE = ["OVO", "Paylater", "Credit Card"]
REPLAYED_EVERY = 50    # events of orders with such a key are published twice
# -----------------------------------------------------------------------------

RAW_COLUMNS = ["order_id", "user_id", "product_id", "quantity", "amount", "payment_method", "country", "created_date"]


def _ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_pick(values: list[str], index_sql: str) -> str:
    """SQL ``values[index]`` for a non-negative integer expression."""
    return f"element_at(array({', '.join(_sql_str(v) for v in values)}), CAST(({index_sql}) + 1 AS INT))"


def _order_lines(t: TableSet) -> DataFrame:
    return t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


def _buyers(t: TableSet) -> DataFrame:
    orders = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    customer = t["customer"].select("c_custkey", "c_nationkey")
    return orders.join(customer, orders.o_custkey == customer.c_custkey)


def raw_orders_flagged(t: TableSet) -> DataFrame:
    """Raw order events plus a ``replayed`` flag (events published twice).

    orders is joined to customer first (orders-sized shuffle on custkey),
    then to lineitem on orderkey, so the lineitem-sized side is shuffled once.
    """
    li, buyer = _order_lines(t), _buyers(t)
    return _events(li.join(buyer, li.l_orderkey == buyer.o_orderkey))


def _events(j: DataFrame) -> DataFrame:
    """Order lines with their buyers -> raw events, flagged.

    The event columns are SQL expressions (``selectExpr``): one call builds
    the whole projection instead of hundreds of small Column objects.
    """
    k = "l_orderkey"
    amount_value = f"CAST(floor(l_extendedprice * CASE WHEN {k} % 40 IN (0, 2) THEN 5000 ELSE 400 END) AS BIGINT)"
    event_clock = f"timestampadd(HOUR, CAST(({k} * 7 + l_linenumber * 5) % 24 AS INT), CAST(o_orderdate AS TIMESTAMP_NTZ))"
    return j.selectExpr(
        "concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), "
        "CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING)) AS order_id",
        # some orders name a user or product that no table has (left-join misses)
        f"concat(CASE WHEN {k} % 11 = 0 THEN 'UX' ELSE 'U' END, CAST(o_custkey AS STRING)) AS user_id",
        f"concat(CASE WHEN {k} % 13 = 0 THEN 'PX' ELSE 'P' END, CAST(l_partkey AS STRING)) AS product_id",
        f"CAST(l_quantity AS INT) * CASE WHEN {k} % 40 = 1 THEN 10 ELSE 2 END AS quantity",
        f"CASE WHEN {k} % 97 = 0 THEN {_sql_str(EMPTY_AMOUNT)} WHEN {k} % 101 = 0 THEN {_sql_str(OVERSIZED_AMOUNT)} "
        f"ELSE concat('Rp.', format_number({amount_value}, 0)) END AS amount",
        f"{_sql_pick(PAYMENT_CYCLE, f'({k} + l_linenumber) % 6')} AS payment_method",
        f"CASE WHEN {k} % 103 = 0 THEN CAST(NULL AS STRING) WHEN c_nationkey % 9 < 6 THEN 'ID' "
        "WHEN c_nationkey % 9 = 6 THEN 'US' WHEN c_nationkey % 9 = 7 THEN 'SG' ELSE 'MY' END AS country",
        # the wall clock as ISO text: NTZ -> STRING involves no time zone
        f"CASE WHEN {k} % 107 = 0 THEN {_sql_str(BAD_DATE)} "
        f"ELSE regexp_replace(CAST({event_clock} AS STRING), ' ', 'T') END AS created_date",
        f"{k} % {REPLAYED_EVERY} = 0 AS replayed",
    )


def raw_orders(t: TableSet) -> DataFrame:
    """One raw event per order line."""
    return raw_orders_flagged(t).select(*RAW_COLUMNS)


def raw_orders_replayed(t: TableSet) -> DataFrame:
    """The topic as the subscriber sees it: every event once, replayed ones twice."""
    # One scan and one join; a replayed event is emitted twice by a generator.
    # The generator emits the whole event as a struct: filters placed on the
    # events later (ingest validation) then stay above it instead of being
    # pushed into the join condition, where the event text would be built
    # twice per row.
    copies = F.when(F.col("replayed"), F.lit(2)).otherwise(F.lit(1))
    events = F.explode(F.array_repeat(F.struct(*RAW_COLUMNS), copies)).alias("event")
    return raw_orders_flagged(t).select(events).select("event.*")


def raw_orders_dealt(t: TableSet) -> DataFrame:
    """The rows of :func:`raw_orders_replayed`, the two copies of an event in different
    partitions (as long as nothing merges the partitions of the join).

    A line is copied before the join, which shuffles it by its order and the number of the
    copy: no whole event is shuffled to deal it.
    """
    copies = F.array(F.lit(0)), F.array(F.lit(0), F.lit(1))

    def copy(key: str) -> Column:
        return F.explode(F.when(F.col(key) % REPLAYED_EVERY == 0, copies[1]).otherwise(copies[0]))

    li = _order_lines(t).select("*", copy("l_orderkey").alias("l_copy"))
    buyer = _buyers(t).select("*", copy("o_orderkey").alias("o_copy"))
    j = li.join(buyer, (li.l_orderkey == buyer.o_orderkey) & (li.l_copy == buyer.o_copy))
    return _events(j).select(*RAW_COLUMNS)


def raw_orders_spelled(t: TableSet) -> DataFrame:
    """One raw event per order, its clock spelled in the ways the ISO grammar has: calendar
    and week dates, with dashes or compact, with parts of a time, fractions and offsets;
    every tenth one names a week that no year has."""
    k = "o_orderkey"
    clock = f"timestampadd(MINUTE, CAST({k} * 437 % 1440 AS INT), CAST(o_orderdate AS TIMESTAMP_NTZ))"
    spelled = t["orders"].selectExpr(k, "o_custkey", f"CAST({clock} AS STRING) AS c", f"{clock} AS ts").selectExpr(
        "*",
        "regexp_replace(c, '[-: ]', '') AS packed",
        "concat(CAST(extract(YEAROFWEEK FROM ts) AS STRING), '-W', lpad(CAST(weekofyear(ts) AS STRING), 2, '0')) AS week",
        "CAST(weekday(ts) + 1 AS STRING) AS weekday",
    )
    forms = [
        "regexp_replace(c, ' ', 'T')",
        "concat(substr(packed, 1, 8), 'T', substr(packed, 9))",
        "concat(week, '-', weekday, 'T', substr(c, 12))",
        "concat(replace(week, '-', ''), weekday, 'T', substr(packed, 9, 4))",
        "concat(substr(c, 1, 16), '+0700')",
        "substr(packed, 1, 8)",
        "week",
        "concat(c, ',25Z')",
        "concat(substr(packed, 1, 8), ' ', substr(packed, 9, 2), '-23:59')",
        "concat(substr(week, 1, 4), '-W54-', weekday)",
    ]
    text = f"element_at(array({', '.join(forms)}), CAST({k} % {len(forms)} + 1 AS INT))"
    return spelled.selectExpr(
        f"CAST({k} AS STRING) AS order_id",
        "concat('U', CAST(o_custkey AS STRING)) AS user_id",
        "CAST(NULL AS STRING) AS product_id",
        f"CAST({k} % 400 AS INT) AS quantity",
        "'Rp.60,000,000' AS amount",
        f"{_sql_pick(PAYMENT_CYCLE, f'{k} % 6')} AS payment_method",
        "'ID' AS country",
        f"{text} AS created_date",
    )


def raw_users(t: TableSet) -> DataFrame:
    """Operational user table: every customer."""
    return t["customer"].selectExpr(
        "concat('U', CAST(c_custkey AS STRING)) AS user_id",
        "c_name AS first_name",
        "c_mktsegment AS last_name",
        "lower(concat(c_name, '@gmail.com')) AS email",
        f"{_sql_pick(DEFAULT_PAYMENT_CYCLE, 'c_custkey % 3')} AS default_payment",
        f"timestampadd(HOUR, CAST(c_custkey % 720 AS INT), TIMESTAMP_NTZ {_sql_str(USER_CLOCK_START)}) AS created_date",
    )


def _product_version(p: DataFrame, price_scale: int, clock_start: str, key: str = "concat('P', CAST(p_partkey AS STRING))") -> DataFrame:
    return p.selectExpr(
        f"{key} AS product_id",
        "p_name AS product_name",
        "p_type AS category",
        f"CAST(floor(p_retailprice * {price_scale}) AS BIGINT) AS price",
        f"timestampadd(HOUR, CAST(p_partkey % 240 AS INT), TIMESTAMP_NTZ {_sql_str(clock_start)}) AS updated_at",
    )


def raw_products_versions(t: TableSet) -> tuple[DataFrame, DataFrame]:
    """(first price list, later repricing batch) of the product table.

    The first list has every part.  The batch reprices every twentieth part with a
    newer updated_at and adds as many new products.
    """
    p = t["part"]
    first = _product_version(p, 1000, PRODUCT_CLOCK_START)
    new = "concat(CASE WHEN p_partkey % 20 = 1 THEN 'P' ELSE 'PN' END, CAST(p_partkey AS STRING))"
    repriced = _product_version(p.filter("p_partkey % 10 = 1"), 1100, PRODUCT_REPRICE_START, new)
    return first, repriced


def raw_products(t: TableSet) -> DataFrame:
    """Warehouse product history: both versions appended (fan-out in marts)."""
    first, repriced = raw_products_versions(t)
    return first.unionByName(repriced)


# --- derived inputs of the merge and composition operators ---------------------
SIGNUP_EARLY_START = "2025-11-10 00:00:00"
SIGNUP_LATE_START = "2025-11-12 00:00:00"


def customer_profiles(t: TableSet) -> DataFrame:
    """Per customer: key, names, e-mail domain, digit and style choice."""
    from fraudlens.functions.text import EMAIL_DOMAINS

    key = F.col("c_custkey")
    return t["customer"].select(
        user_key(key).alias("user_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        _pick(EMAIL_DOMAINS, F.col("c_nationkey") % 3).alias("domain"),
        (key % 9 + 1).cast("int").alias("digit"),
        (key % 3 + 1).cast("int").alias("style"),
        _pick(PAYMENT_CYCLE, (key + 1) % 6).alias("default_payment"),
        (key % 48).cast("int").alias("_hour"),
    )


def user_signups(t: TableSet) -> DataFrame:
    """A user batch in which every customer signs up twice: first with a
    ``first.<digit>`` address, two days later with ``last_<initial>``.
    Every fifth signs up under a new key.  Inserting the batch keeps existing
    users and, per new key, the earlier row."""
    from fraudlens.operators.compose import with_email
    from fraudlens.schemas import USERS

    key = F.col("user_id")
    new = F.substring(key, 2, 20).cast("bigint") % 5 == 0
    p = customer_profiles(t).withColumn("user_id", F.when(new, F.concat(F.lit("N"), key)).otherwise(key))
    early = with_email(p, "first_digit", digit="digit").withColumn(
        "created_date", F.timestamp_add("HOUR", F.col("_hour"), _ntz(SIGNUP_EARLY_START))
    )
    late = with_email(p, "last_initial").withColumn(
        "created_date", F.timestamp_add("HOUR", F.col("_hour"), _ntz(SIGNUP_LATE_START))
    )
    cols = USERS.fieldNames()
    return early.select(*cols).unionByName(late.select(*cols))


def part_name_parts(t: TableSet) -> DataFrame:
    """Per part: product key, category and three parts of a name."""
    from fraudlens.functions.text import CATEGORIES

    key = F.col("p_partkey")
    return t["part"].select(
        product_key(key).alias("product_id"),
        _pick(CATEGORIES, key % 3).alias("category"),
        F.col("p_brand").alias("part_a"),
        F.col("p_type").alias("part_b"),
        F.col("p_name").alias("part_c"),
    )
