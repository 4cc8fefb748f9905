"""Readers: declared schemas, one multi-file scan per directory."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenocast.functions.dates import parse_mixed_date
from phenocast.functions.numeric import MISSING_SENTINEL, sentinel_to_null
from phenocast.sources import schemas as S


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             columns: Sequence[str] | None = None) -> DataFrame:
    """CSV with a header row and a declared schema.

    Columns are found by name: the file's header gives their order, the declared
    schema their types, and columns that are not declared are left out.  A
    byte-order mark in front of the header is dropped by the reader.  A missing
    path raises Spark's PATH_NOT_FOUND error (S4).  ``columns`` selects a subset,
    which the scan prunes; only these must be there.
    """
    return _by_name(spark, path, schema, columns).select(*(columns or schema.names))


def _by_name(spark: SparkSession, path: str, schema: T.StructType, columns: Sequence[str] | None) -> DataFrame:
    header = spark.read.option("header", True).csv(path).columns
    missing = [c for c in columns or schema.names if c not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    found = T.StructType([schema[c] if c in schema.names else T.StructField(c, T.StringType()) for c in header])
    return (spark.read.schema(found).option("header", True).option("mode", "PERMISSIVE")
            .option("enforceSchema", False).csv(path))


def read_dir(spark: SparkSession, directory: str, schema: T.StructType, pattern: str = "*.csv",
             key: str = "source_file", columns: Sequence[str] | None = None) -> DataFrame:
    """All files of a directory as one table, keeping each row's file name (S3).

    ``key`` holds the file name without its extension, the identity the
    per-file outputs are paired by (weather file <-> validation file).
    """
    df = _by_name(spark, f"{directory.rstrip('/')}/{pattern}", schema, columns)
    df = df.withColumn(key, F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", ""))
    return df.select(*(columns or schema.names), key)


def read_status_obs(spark: SparkSession, path: str) -> DataFrame:
    """Raw status observations: sentinel -9999 -> NULL, date parsed."""
    df = read_csv(spark, path, S.STATUS_OBS)
    df = sentinel_to_null(df, ["Latitude", "Longitude", "Elevation_in_Meters", "Day_of_Year",
                               "Phenophase_Status"], MISSING_SENTINEL)
    return df.withColumn("Observation_Date", parse_mixed_date("Observation_Date"))


def read_bloom(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """Bloom tables (file or directory glob); mixed date formats repaired by ``year``."""
    df = (read_dir(spark, path, S.BLOOM, key=key) if key else read_csv(spark, path, S.BLOOM))
    return df.withColumn("bloom_date", parse_mixed_date("bloom_date", "year"))


def read_weather_daily(spark: SparkSession, directory: str, key: str = "source_file") -> DataFrame:
    """Daily weather files of a directory, file identity kept (S3, P10)."""
    return read_dir(spark, directory, S.WEATHER_DAILY, key=key)
