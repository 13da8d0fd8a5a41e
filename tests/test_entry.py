"""Driver contract and the oracle comparison of every registered query."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from fraudlens.plans.catalog import QUERIES
from fraudlens.sources.tables import INPUT_TABLES
from tests.conftest import SF_SMALL


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert df.columns == [
        "user_id", "first_name", "email", "total_orders", "total_purchasing",
        "fraud_orders_count", "total_fraud_loss", "blacklist_status",
    ]
    assert df.count() == 244


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) & set(E.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in INPUT_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}")
    if hasattr(v, "isoformat") and hasattr(v, "tzinfo") and v.tzinfo is not None:
        return v.replace(tzinfo=None)
    return v


def _bag(tbl):
    cols = sorted(tbl.column_names)
    data = [tbl.column(c).to_pylist() for c in cols]
    return cols, Counter(tuple(_norm(x) for x in r) for r in zip(*data))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF_SMALL).toArrow()
    want = duck.sql(E.oracle_sql()[name]).to_arrow_table()
    assert got.num_rows == want.num_rows
    assert _bag(got) == _bag(want)
