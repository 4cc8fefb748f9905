"""Checkpoint folder lookup: honour the session's setting, scratch only in local mode."""

from phenocast.session import ensure_checkpoint_dir, shared_scratch_path


def test_checkpoint_dir_is_set_and_reused(spark):
    first = ensure_checkpoint_dir(spark)
    assert first
    assert ensure_checkpoint_dir(spark) == first          # never replaced once set
    assert shared_scratch_path(spark, "x/y").startswith(first.rstrip("/"))


def test_iterative_fit_checkpoints_into_that_dir(spark):
    from pyspark.sql import functions as F

    from phenocast.operators import models
    df = spark.range(100).select(F.col("id").cast("double").alias("a"),
                                 (F.col("id") % 5).cast("double").alias("label"))
    fitted = models.fit_regressor(df, ["a"], "label", "gbt", settings={"maxIter": 12})
    assert fitted.model.stages[-1].getOrDefault("checkpointInterval") == 10
