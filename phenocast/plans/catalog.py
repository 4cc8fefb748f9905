"""All registered queries: importing this module fills the registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from phenocast.plans import modeling, relational, statistical  # noqa: F401  (register queries)
from phenocast.plans.pipeline import training_set
from phenocast.plans.registry import ORACLES, QUERIES


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_set(spark, sf_dir)


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(ORACLES)
