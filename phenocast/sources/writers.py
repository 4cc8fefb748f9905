"""Writers: CSV/Parquet sinks, per-key partitioned outputs, run-named folders."""

from __future__ import annotations

from datetime import datetime
from typing import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame

# Fixed value: run-name format of output files.
RUN_ID_FORMAT = "%Y-%m-%d_%H-%M-%S"


def run_id(now: datetime | None = None) -> str:
    return (now or datetime.now()).strftime(RUN_ID_FORMAT)


def run_output_path(base: str, rid: str | None = None) -> str:
    """Output folder named by the run time."""
    return f"{base.rstrip('/')}/{rid or run_id()}"


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = (),
              mode: str = "errorifexists") -> str:
    """CSV with header; optionally one folder per key value.

    Existing output is never overwritten unless ``mode`` says so.
    """
    w = df.write.mode(mode).option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)
    return path


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                  mode: str = "errorifexists") -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_representatives(clusters: DataFrame, reps: DataFrame, rows: DataFrame, base: str,
                          fmt: str = "csv", mode: str = "errorifexists",
                          group: Sequence[str] = ()) -> dict:
    """The three outputs of representative selection.

    They share one lineage, so the cluster assignment is persisted once and
    reused; the per-representative rows are partitioned by cluster.
    """
    clusters = clusters.persist(StorageLevel.MEMORY_AND_DISK)
    write = write_csv if fmt == "csv" else write_parquet
    base = base.rstrip("/")
    out = {
        "clusters": write(clusters, f"{base}/clusters", mode=mode),
        "location": write(reps, f"{base}/location", mode=mode),
        "validation": write(rows, f"{base}/validation", partition_by=[*group, "cluster"], mode=mode),
    }
    clusters.unpersist()
    return out
