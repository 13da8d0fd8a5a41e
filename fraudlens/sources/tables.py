"""Lazy readers of the given Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

INPUT_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


# Declared schemas of the inputs the pipeline reads: a declared schema skips
# the footer-reading job Spark otherwise runs per read (over every file of a
# large table), and a file whose types drifted fails loudly.
DECLARED = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
}


class TableSet:
    """``tables["orders"]`` -> DataFrame over ``<sf_dir>/orders.parquet``.

    Reads are lazy and created on first use; Catalyst prunes columns and
    pushes filters into each scan.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            reader = self.spark.read
            if name in DECLARED:
                reader = reader.schema(DECLARED[name])
            self._cache[name] = reader.parquet(self.path(name))
        return self._cache[name]


def load_tables(spark: SparkSession, sf_dir: str) -> TableSet:
    return TableSet(spark, sf_dir)
