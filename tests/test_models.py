"""Model invariants and quality bounds (M6-M11, M14, M16; section 5 layers 4-5)."""

import pytest
from pyspark.sql import functions as F

from phenocast.operators import models


@pytest.fixture(scope="module")
def synthetic(spark):
    # label depends on two of four features; the rest is noise
    df = spark.range(600).select(
        F.col("id"),
        (F.col("id") % 17).cast("double").alias("f1"),
        ((F.col("id") * 7) % 13).cast("double").alias("f2"),
        ((F.col("id") * 11) % 5).cast("double").alias("f3"),
        F.rand(3).alias("f4"))
    df = df.withColumn("label", 3 * F.col("f1") - 2 * F.col("f2") + 0.1 * F.col("f4"))
    return models.train_test(df, ["id"], 0.2, 42)


def test_gbt_beats_mean_predictor(synthetic):
    train, test = synthetic
    fitted = models.fit_regressor(train, ["f1", "f2", "f3", "f4"], "label", "gbt",
                                  settings={"maxIter": 30, "featureSubsetStrategy": "all"})
    r = models.evaluate(fitted, test, "label", rounded=False).first()
    assert r["r2"] > 0.9


def test_importances_sum_to_one_and_cutoff_minimal(synthetic):
    train, _ = synthetic
    fitted = models.fit_regressor(train, ["f1", "f2", "f3", "f4"], "label", "rf",
                                  settings={"numTrees": 20})
    imp = models.feature_importances(fitted)
    assert sum(r["score"] for r in imp.collect()) == pytest.approx(1.0)
    cut = models.importance_cutoff(models.importance_rank(imp), 0.9).orderBy("rank").collect()
    cums = [r["cum_score"] for r in cut]
    assert cums[-1] >= 0.9 - 1e-12 and (len(cums) == 1 or cums[-2] < 0.9)
    assert {r["feature"] for r in cut} >= {"f1"}


def test_linear_and_comparison_table(synthetic):
    train, test = synthetic
    table = models.model_comparison(train, test, ["f1", "f2", "f3", "f4"], "label",
                                    kinds=("linear",))
    r = table.first()
    assert r["model"] == "linear" and r["r2"] > 0.99


def test_cross_validation_table(synthetic):
    train, _ = synthetic
    settings = models.expand_grid({"n_estimators": [3], "max_depth": [2, 3]})
    table, best = models.cross_validate(train, ["f1", "f2"], "label", settings, folds=3, metric="r2")
    rows = table.collect()
    assert len(rows) == 2 and all(r["metric"] == r["metric"] for r in rows)
    assert best.transform(train).count() == train.count()


def test_grid_presets_sizes():
    assert len(models.expand_grid(models.GRID_PRESETS["base"])) == 2187
    assert len(models.expand_grid(models.GRID_PRESETS["combined"])) == 18000


def test_random_draw_is_seeded():
    a = models.draw_settings(models.RANDOM_SEARCH_SPACE, 3, seed=42)
    assert a == models.draw_settings(models.RANDOM_SEARCH_SPACE, 3, seed=42)
    assert all(50 <= s["n_estimators"] < 300 and 0.6 <= s["subsample"] <= 1.0 for s in a)
