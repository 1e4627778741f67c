"""Session defaults and the shared working folder.

The library never starts its own cluster; callers pass a ``SparkSession``.
``build_session`` exists for tests, the bench and local runs. On a cluster the
same settings belong in the job's submit configuration.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package relies on.
#  * UTC session zone: source timestamps are local wall-clock hours and must be
#    read as written (no zone shift on hour/day extraction).
#  * AQE: coalesces the many small post-aggregation partitions, converts a join
#    to broadcast only when the *measured* shuffle size of one side is small,
#    and splits skewed sort-merge-join partitions.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime broadcast threshold, checked against actual shuffle bytes.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    # Plan-time broadcast threshold, checked against size statistics.
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    # Rows of a batch sent to a Python worker: rows may hold whole documents.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "crowding",
    extra: dict | None = None,
) -> SparkSession:
    """A session with the package defaults; for tests, the bench and local use."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**CORE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_core_conf(spark)
    return spark


def ensure_core_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings above to an existing session."""
    for key, value in CORE_CONF.items():
        spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared working folder (``spark.checkpoint.dir``).

    Lake round trips, audit tables and lineage cuts go under it. On a cluster
    the setting must come from the job configuration; only a local session
    without one (tests) gets a private folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if current:
            sc.setCheckpointDir(current)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster job needs a shared folder"
            )
        current = tempfile.mkdtemp(prefix="crowding-shared-")
        sc.setCheckpointDir(current)
        current = sc.getCheckpointDir()
    return current.rstrip("/")


def scratch_root(spark: SparkSession) -> str:
    """The folder below the shared one that holds all this application stores by the way."""
    return f"{shared_dir(spark)}/crowding-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder for an intermediate table."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application.

    Results are lazy and read them: call it when the results are written. What
    a job that was cut off has left goes the same way, by its application's id.
    """
    at = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
