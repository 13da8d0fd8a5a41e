"""SparkSession settings shared by tests, bench and the entry point.

On a cluster the session comes from the launcher and only the SQL settings
below that are still unset get a value; ``spark.checkpoint.dir`` is read from
the session and only filled in when nothing named it (local runs, tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# SQL settings the operators are designed around.  AQE re-plans joins at run
# time (broadcast when a shuffled side turns out small, split skewed
# partitions of sort-merge joins, coalesce small shuffle partitions).
SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    # Broadcast only what is measured small: plan-time size estimates are
    # guesses (a pruned fact-table scan can look small, a join output is
    # estimated as a product), so estimate-based broadcast is off and AQE
    # converts a sort-merge join to a broadcast join only from the real
    # size of a finished shuffle stage.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a task's hash tables and sort buffers take about ten times the shuffled bytes of its
    # partition (compressed text), so partitions are kept small
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    # a join whose smaller side was measured to have no partition beyond this hashes that
    # side and sorts neither (it must not be below the partition size above)
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "32m",
    # HotSpot doesn't compile methods beyond 8000 bytes of byte code; a stage whose fused
    # method is longer runs faster as one compiled method per operator
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # every table in this package uses wall-clock TIMESTAMP_NTZ columns;
    # a fixed session zone keeps TIMESTAMP (LTZ) helpers reproducible
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(
    master: str | None = None,
    app_name: str = "fraudlens",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    ``master`` is only applied when given: on a cluster the submitter sets it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        # local mode: no web UI (it would open a port), driver holds everything
        builder = builder.config("spark.ui.enabled", "false")
        builder = builder.config("spark.ui.showConsoleProgress", "false")
        # local runs read single-row-group files (one map task per table);
        # the local shuffle reader would then run a converted broadcast join
        # in one task, so read shuffles by partition instead
        builder = builder.config("spark.sql.adaptive.localShuffleReader.enabled", "false")
        builder = builder.config("spark.driver.memory", os.environ.get("FRAUDLENS_DRIVER_MEMORY", "8g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if master:
        spark.sparkContext.setLogLevel("ERROR")
    apply_sql_defaults(spark, SQL_DEFAULTS)
    return spark


# settings left to the caller's session: results never depend on them
_CALLER_OWNED = {"spark.sql.session.timeZone", "spark.sql.sources.partitionOverwriteMode"}


def apply_sql_defaults(spark: SparkSession, settings: dict[str, str] | None = None) -> None:
    """Give the SQL settings the operators are designed around to a session, where
    nobody has set them (they are all modifiable at run time)."""
    chosen = settings or {k: v for k, v in SQL_DEFAULTS.items() if k not in _CALLER_OWNED}
    explicit = spark.conf.getAll
    for k, v in chosen.items():
        if k not in explicit:
            spark.conf.set(k, v)


_LOCAL_CKPT: dict[int, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (HDFS / object store) folder there; it is used
    as-is.  Only in local mode, when the setting is absent (tests), a fresh
    folder under the system temp directory is created and registered with
    the context; a cluster without the setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        # a machine-local folder is not reachable from other executors
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store) for cluster runs")
    key = id(sc._jsc)
    if key not in _LOCAL_CKPT:
        local = tempfile.mkdtemp(prefix="fraudlens-ckpt-")
        sc.setCheckpointDir(local)
        _LOCAL_CKPT[key] = local
    return _LOCAL_CKPT[key]


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the checkpoint dir for intermediate tables."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
