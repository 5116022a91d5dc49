"""Session settings the pipeline relies on, and the shared scratch root.

Everything here is a runtime SQL conf, so it can be applied to a session the
caller already owns (the driver's, a notebook's, a test fixture's).
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that change results must be pinned; the rest are scale defaults.
RESULT_CONFS = {
    # load stamps are rendered into version keys; render them zone-free
    "spark.sql.session.timeZone": "UTC",
}

SCALE_CONFS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # stored tables take about four times their files' size in memory; by the files' size alone a
    # table of millions of similar rows would be broadcast
    "spark.sql.sources.fileCompressionFactor": "4.0",
    # a table bucketed by one of several join keys is joined where it lies
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def configure_session(spark: SparkSession) -> SparkSession:
    for key, value in {**RESULT_CONFS, **SCALE_CONFS}.items():
        spark.conf.set(key, value)
    return spark


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is written in here drops the files that it shuffled as soon as it is written, not when the
    driver happens to collect its plan.  Only for writes: a DataFrame that is run twice would have to
    shuffle again."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def _checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            return current
    except Exception:  # no SparkContext handle (e.g. a Connect session)
        pass
    return spark.conf.get("spark.checkpoint.dir", None) or None


def _is_local(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext.master.startswith("local")
    except Exception:
        return (spark.conf.get("spark.master", "") or "").startswith("local")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written tables: the cluster's checkpoint directory.

    The cluster names it (``spark.checkpoint.dir`` or ``setCheckpointDir``).
    Only a local-mode session without one gets a private folder, because on
    a cluster a machine-local directory is not visible to the executors.
    """
    current = _checkpoint_dir(spark)
    if not current:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/S3/...) before building the warehouse on a cluster"
            )
        current = tempfile.mkdtemp(prefix="tessera-ckpt-")
        try:
            spark.sparkContext.setCheckpointDir(current)
            current = spark.sparkContext.getCheckpointDir() or current
        except Exception:
            pass
    return current.rstrip("/")


def application_id(spark: SparkSession) -> str:
    try:
        return spark.sparkContext.applicationId
    except Exception:
        return spark.conf.get("spark.app.id", "app")


def local_test_session(app: str = "tessera", cores: str = "*",
                       shuffle_partitions: int = 8,
                       advisory_partition_mb: int = 16) -> SparkSession:
    """Local session used by tests, tools and bench (UI off, UTC).

    Single-host profile: a smaller AQE advisory partition size than the
    cluster default keeps a handful of cores evenly busy on reduce stages."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", f"{advisory_partition_mb}m")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure_session(spark)
