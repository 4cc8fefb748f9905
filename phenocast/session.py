"""Session helpers for tests, the bench and the command line.

Library code never creates a session; it uses the one its DataFrames belong
to.  These helpers exist for entry points that must start one.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "phenocast", extra_conf: dict | None = None) -> SparkSession:
    """Local/test session: AQE on, UI off, UTC, Arrow on.

    ``extra_conf`` adds settings, e.g. an event log in a scratch folder for
    stage and task times (``spark.eventLog.enabled`` / ``spark.eventLog.dir``).
    """
    master = master or os.environ.get("PHENOCAST_MASTER", "local[8]")
    parts = shuffle_partitions or int(os.environ.get("PHENOCAST_SHUFFLE_PARTITIONS", "8"))
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # delete checkpoint files of iterative fits once their RDDs are gone
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("PHENOCAST_DRIVER_MEMORY", "16g"))
    )
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, setting a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3/...)
    and is honoured as is; if it is missing there, this raises instead of
    falling back to a machine-local folder.  Only a local-mode session (tests,
    laptop runs) without any setting gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (needed to cut "
                           "lineage of iterative jobs such as boosted trees)")
    scratch = tempfile.mkdtemp(prefix="phenocast-ckpt-")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir() or scratch


def shared_scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
