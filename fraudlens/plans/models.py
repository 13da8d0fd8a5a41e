"""The model graph: sources -> staging (views) -> core (tables) -> marts (tables).

``build_models`` wires the layers lazily, so one query only computes what it
needs and Catalyst sees the whole plan.  ``run_models`` is the full refresh:
it writes each core table once, then builds every mart from the written core
tables.  Writing the core layer is what the models ask for (they are tables)
and it cuts lineage: five marts read one stored fact table instead of
re-running ingest and de-duplication five times, and a lost executor
re-reads Parquet instead of recomputing the shuffle chain.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from fraudlens.sources.versions import VersionLog
from fraudlens.operators import core, marts, staging

STAGING = ("stg_orders", "stg_users", "stg_products")
CORE = ("fct_orders", "dim_users", "dim_products")
MARTS = (
    "mart_payment_critical_time",
    "mart_users_blacklist",
    "mart_users_fraud_mostly",
    "mart_user_product_habit",
    "mart_product_payment",
)

# per-user order / fraud totals shared by the two user marts (not a model)
USER_FLAGS = "user_fraud_flags"


class Sources:
    """Warehouse source tables: ingested orders, users, products.

    Each may be given as a DataFrame or as a zero-argument factory; a
    factory runs on first use, so a model that needs only the orders never
    builds the user or product inputs.
    """

    def __init__(self, orders, users, products):
        self._given = {"orders": orders, "users": users, "products": products}
        self._built: dict[str, DataFrame] = {}

    def _get(self, name: str) -> DataFrame:
        if name not in self._built:
            v = self._given[name]
            self._built[name] = v() if callable(v) else v
        return self._built[name]

    @property
    def orders(self) -> DataFrame:
        return self._get("orders")

    @property
    def users(self) -> DataFrame:
        return self._get("users")

    @property
    def products(self) -> DataFrame:
        return self._get("products")


class ModelGraph(Mapping):
    """``graph[name]`` builds model ``name`` and only what it depends on.

    DataFrames are built once per graph, so two marts taken from one graph
    share the same fact and dimension plans.
    """

    def __init__(self, src: Sources | None = None, as_of=None, core: dict[str, DataFrame] | None = None,
                 ordered: bool = True):
        self.src = src
        self.as_of = as_of
        # apply the marts' ORDER BY (True for returned DataFrames; a graph
        # whose marts are written as tables skips the global sorts)
        self.ordered = ordered
        self._built: dict[str, DataFrame] = dict(core or {})

    def _make(self, name: str) -> DataFrame:
        g, a = self.__getitem__, self.as_of
        if name == "stg_orders":
            return staging.stg_orders(self.src.orders)
        if name == "stg_users":
            return staging.stg_users(self.src.users)
        if name == "stg_products":
            return staging.stg_products(self.src.products)
        if name == "fct_orders":
            return core.fct_orders(g("stg_orders"), a)
        if name == "dim_users":
            return core.dim_users(g("stg_users"), a)
        if name == "dim_products":
            return core.dim_products(g("stg_products"), a)
        o = self.ordered
        if name == "mart_payment_critical_time":
            return marts.mart_payment_critical_time(g("fct_orders"), ordered=o)
        if name == USER_FLAGS:
            return marts.user_fraud_flags(g("fct_orders"))
        if name == "mart_users_blacklist":
            return marts.mart_users_blacklist(g("fct_orders"), g("dim_users"), g(USER_FLAGS))
        if name == "mart_users_fraud_mostly":
            return marts.mart_users_fraud_mostly(g("fct_orders"), g("dim_users"), g(USER_FLAGS), ordered=o)
        if name == "mart_user_product_habit":
            return marts.mart_user_product_habit(g("fct_orders"), g("dim_products"), g("dim_users"), ordered=o)
        if name == "mart_product_payment":
            return marts.mart_product_payment(g("fct_orders"), g("dim_products"))
        raise KeyError(name)

    def provide(self, name: str, df: DataFrame) -> None:
        """Use ``df`` (e.g. a stored table) for node ``name`` from now on."""
        self._built[name] = df

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._make(name)
        return self._built[name]

    def __iter__(self):
        return iter(STAGING + CORE + MARTS)

    def __len__(self) -> int:
        return len(STAGING + CORE + MARTS)


def build_models(src: Sources, as_of=None) -> ModelGraph:
    """All eleven models, each built lazily on first access."""
    return ModelGraph(src, as_of)


def stored_graph(
    spark: SparkSession, core_paths: dict[str, str], broadcast_max_bytes: int | None = None, ordered: bool = True
) -> ModelGraph:
    """Model graph over written core tables.  Each dimension is broadcast to
    the mart joins when its measured bytes are within the bound (see
    ``operators.joins.checked_broadcast``); the fact table never is.
    ``ordered=False`` leaves out the marts' global sorts (for table writes)."""
    from fraudlens.operators.joins import BROADCAST_MAX_BYTES, checked_broadcast

    bound = BROADCAST_MAX_BYTES if broadcast_max_bytes is None else broadcast_max_bytes
    core_tables = {name: spark.read.parquet(core_paths[name]) for name in CORE}
    for dim in ("dim_users", "dim_products"):
        core_tables[dim] = checked_broadcast(core_tables[dim], bound)
    return ModelGraph(core=core_tables, ordered=ordered)


def run_models(spark: SparkSession, src: Sources, out_dir: str, as_of=None, select: tuple[str, ...] | None = None) -> dict[str, str]:
    """Full refresh: write core tables, then marts built on the written core.

    Each run writes to a folder of its own below ``out_dir`` and, when all its tables are
    there, publishes their paths as the next version (:func:`current_models`).  A run that
    fails leaves the version before it untouched, and no reader sees tables of two runs.
    Staging stays lazy (views).  Returns ``name -> path``.  ``select`` limits which marts
    run (the core layer is always built); the others stay those of the version before.
    """
    import uuid

    out_dir = out_dir.rstrip("/")
    log = VersionLog(spark, f"{out_dir}/versions")
    number = log.number()
    run_dir = f"{out_dir}/run-{uuid.uuid4().hex[:12]}"
    paths: dict[str, str] = {}
    graph = ModelGraph(src, as_of)
    for name in CORE:
        paths[name] = f"{run_dir}/{name}"
        graph[name].write.parquet(paths[name])
    # marts are written as tables, which keep no row order: no global sorts
    stored = stored_graph(spark, paths, ordered=False)
    wanted = [name for name in MARTS if select is None or name in select]
    if {"mart_users_blacklist", "mart_users_fraud_mostly"} <= set(wanted):
        # the per-user totals feed two marts: aggregate the fact table once
        flags_path = f"{run_dir}/_{USER_FLAGS}"
        stored[USER_FLAGS].write.parquet(flags_path)
        stored.provide(USER_FLAGS, spark.read.parquet(flags_path))
    for name in wanted:
        paths[name] = f"{run_dir}/{name}"
        stored[name].write.parquet(paths[name])
    log.publish(number + 1, {"tables": log.read(number).get("tables", {}) | paths})
    return paths


def current_models(spark: SparkSession, out_dir: str) -> dict[str, str]:
    """Paths of the tables of the last complete run, ``name -> path``; empty before one."""
    return VersionLog(spark, f"{out_dir.rstrip('/')}/versions").read().get("tables", {})
