"""Model bundles: fitted pipeline + normalization table + feature list."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from phenocast.operators.boosting import BoostedModel
from phenocast.operators.models import FittedModel


def save_model_bundle(fitted: FittedModel, path: str) -> str:
    """Save under ``path``; refuses to overwrite an existing bundle."""
    base = path.rstrip("/")
    spark = fitted.params.sparkSession
    if isinstance(fitted.model, BoostedModel):
        fitted.model.save(spark, f"{base}/model")
    else:
        fitted.model.write().save(f"{base}/model")      # raises if it exists
    fitted.params.write.mode("errorifexists").parquet(f"{base}/normalization_params")
    spark.createDataFrame(list(enumerate(fitted.features)), "position int, feature string") \
        .write.mode("errorifexists").parquet(f"{base}/feature_list")
    return base


def load_model_bundle(spark: SparkSession, path: str) -> FittedModel:
    """Load lazily by path (nothing happens at import time)."""
    from pyspark.ml import PipelineModel
    base = path.rstrip("/")
    nodes = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/model/nodes")
    boosted = nodes.getFileSystem(spark._jsc.hadoopConfiguration()).exists(nodes)
    model = BoostedModel.load(spark, f"{base}/model") if boosted else PipelineModel.load(f"{base}/model")
    params = spark.read.parquet(f"{base}/normalization_params")
    # the feature list has one row per feature: bounded by the schema width
    feats = [r["feature"] for r in
             spark.read.parquet(f"{base}/feature_list").orderBy(F.col("position")).collect()]
    return FittedModel(model, params, feats)
