"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from phenocast.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder, read back.

    Cuts the lineage: a lost executor only repeats tasks that read the table.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def few(df: DataFrame, rows: int, each: int = 1 << 15) -> DataFrame:
    """``df`` in no more tasks than so many rows are worth: with many shuffle partitions a small
    table would be as many files, and a local file system starts a process or more for each."""
    return df.coalesce(max(1, -(-rows // each)))


def slices(batch: pa.RecordBatch, at: int, size: int = 2 << 20):
    """``batch`` in slices of about ``size`` bytes of its column ``at``, a row at least."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False), dtype=np.int64) // size
    starts = np.flatnonzero(np.diff(upto, prepend=-1)).tolist()
    for lo, hi in zip(starts, [*starts[1:], len(batch)]):
        yield batch.slice(lo, hi - lo)


def give_back() -> None:
    """Free memory of this process, which its allocators keep, goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)     # of the GNU C library
    if trim is not None:
        trim(0)


def released(run):
    """``run``, a function of a task's batches, that gives free memory back at its end: Spark
    keeps the worker."""
    def task(batches):
        yield from run(batches)
        give_back()

    return task


def utf8(text: str | None) -> bytes:
    """UTF-8 bytes of a text, null read as empty."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")
