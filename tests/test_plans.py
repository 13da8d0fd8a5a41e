"""Structural guards on the physical plan of every registered query:
JVM-only expressions, no cross products, no per-key windows, pruned scans."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

FORBIDDEN = {
    "BatchEvalPython": "row-at-a-time Python UDF",
    "ArrowEvalPython": "Pandas UDF",
    "FlatMapGroupsInPandas": "grouped Pandas UDF",
    "MapInPandas": "Pandas partition UDF",
    "CartesianProduct": "cross join",
    "BroadcastNestedLoopJoin": "non-equi / cross join",
    "Window ": "window over a key (one task per hot key)",
}
NAMES = sorted(n for n in E.queries() if n != "stream_ingest_orders")


@pytest.mark.parametrize("name", NAMES)
def test_plan_is_jvm_only_and_pruned(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for token, what in FORBIDDEN.items():
        assert token not in plan, f"{name}: {what} in plan"
    # no scan of the wide fact table reads columns the pipeline never uses
    for unused in ("l_shipdate", "l_tax", "l_discount", "l_comment", "o_orderpriority", "c_acctbal"):
        assert unused not in plan, f"{name}: reads {unused}"
