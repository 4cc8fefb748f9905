"""Scaling, correlation, metrics, intervals, outliers, importance."""

import math
import statistics

import pytest
from pyspark.sql import functions as F

from phenocast.operators import models, stats


def test_constant_feature_scaler_vs_stored_params(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, c double")
    scaled = stats.standardize(df, ["a", "c"]).orderBy("a").collect()
    assert [r["a"] for r in scaled] == [-1.0, 1.0]          # population spread
    assert [r["c"] for r in scaled] == [0.0, 0.0]           # scaler form: constant -> 0
    params = stats.normalization_params(df, ["a", "c"])
    stored = stats.normalize_with_params(df, params, ["a", "c"]).collect()
    assert all(r["c"] is None for r in stored)              # stored form: 0 / 0 -> NULL


def test_normalize_requires_features(spark):
    df = spark.createDataFrame([(1.0,)], "a double")
    params = stats.normalization_params(df, ["a"])
    with pytest.raises(ValueError):
        stats.normalize_with_params(df, params, ["a", "b"])


def test_correlation_constant_and_pairwise(spark):
    df = spark.createDataFrame([(1.0, 2.0, 7.0), (2.0, 4.1, 7.0), (3.0, None, 7.0), (4.0, 8.0, 7.0)],
                               "a double, b double, c double")
    out = {(r["feature_a"], r["feature_b"]): r["corr"] for r in stats.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert out[("a", "c")] is None and out[("c", "c")] is None
    xs, ys = [1.0, 2.0, 4.0], [2.0, 4.1, 8.0]
    assert out[("a", "b")] == pytest.approx(statistics.correlation(xs, ys), abs=1e-12)
    assert out[("a", "b")] == out[("b", "a")]


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.0, 2.0)], "y double, p double")
    r = stats.regression_metrics(df, "y", "p").first()
    assert r["mse"] == pytest.approx(2 / 3) and r["r2"] == pytest.approx(1 - 2 / 2)


def test_normal_interval_published_predictions(spark):
    df = spark.createDataFrame([("washingtondc", 84.0), ("liestal", 80.0), ("kyoto", 96.0),
                                ("vancouver", 100.0), ("newyorkcity", 92.0)], "location string, p double")
    out = {r["location"]: (r["prediction"], r["lower"], r["upper"])
           for r in stats.final_predictions(df, "p", "prediction", 0.75).collect()}
    published = {"washingtondc": (84, 81, 86), "liestal": (80, 77, 82), "kyoto": (96, 94, 98),
                 "vancouver": (100, 97, 102), "newyorkcity": (92, 90, 95)}
    half = 0.31864 * statistics.pstdev([84, 80, 96, 100, 92])
    assert half == pytest.approx(2.364, abs=1e-3)
    for loc, (p, lo, hi) in published.items():
        assert out[loc][0] == p
        assert abs(out[loc][1] - lo) <= 1 and abs(out[loc][2] - hi) <= 1
        assert out[loc][1] <= out[loc][0] <= out[loc][2]


def test_batch_of_one_has_zero_width(spark):
    df = spark.createDataFrame([("abashiri", 108.2)], "location string, p double")
    r = stats.final_predictions(df, "p", "prediction", 0.75).first()
    assert (r["prediction"], r["lower"], r["upper"]) == (108, 108, 108)


def test_quantile_interval_index_rules(spark):
    df = spark.createDataFrame([(float(v),) for v in [5, 1, 4, 2, 3]], "p double")
    inner = stats.quantile_interval(df, "p", 0.99, "inner").first()
    assert (inner["lower"], inner["upper"]) == (1.0, 5.0)
    assert stats.interval_ranks(5, 0.99, "inner") == (0, 4)
    assert stats.interval_ranks(200, 0.5, "legacy") == (1, 199)      # coverage fixed at .99
    assert stats.interval_ranks(200, 0.5, "inner") == (49, 150)


def test_outlier_flags_at_most_contamination(spark):
    df = spark.range(1000).select((F.col("id") % 97).cast("double").alias("x"),
                                  F.when(F.col("id") == 3, 1e6).otherwise(1.0).alias("y"))
    out = stats.outlier_flags(df, ["x", "y"], 0.05)
    agg = out.agg(F.sum(F.col("x_outlier").cast("int")).alias("nx"),
                  F.sum(F.col("y_outlier").cast("int")).alias("ny")).first()
    assert 0 < agg["nx"] <= 50
    assert agg["ny"] == 1
    kept = stats.outlier_row_filter(out, ["x_outlier", "y_outlier"], 0.10)
    assert kept.count() == 1000 - out.where("x_outlier OR y_outlier").count()
    counts = stats.filter_counts(out, ["x_outlier", "y_outlier"]).first()
    assert counts["rows_before"] == 1000 and counts["rows_after"] == kept.count()


def test_importance_cutoff_prefix(spark):
    df = spark.createDataFrame([("a", 0.5), ("b", 0.4), ("c", 0.1)], "feature string, score double")
    cut = models.importance_cutoff(models.importance_rank(df), 0.9)
    assert [r["feature"] for r in cut.orderBy("rank").collect()] == ["a", "b"]
    cut95 = models.importance_cutoff(models.importance_rank(df), 0.95)
    assert cut95.count() == 3


def test_hash_split_exact_size(spark):
    df = spark.range(1001).withColumnRenamed("id", "k")
    out = models.hash_split(df, ["k"], 0.2, 42)
    assert out.where("split = 'test'").count() == math.ceil(0.2 * 1001)
    again = models.hash_split(df, ["k"], 0.2, 42)
    assert out.exceptAll(again).count() == 0


def test_scaled_columns_have_mean_zero_spread_one(spark):
    df = spark.range(500).select((F.col("id") % 37 * 1.5).alias("a"), (F.col("id") % 11).alias("b"))
    out = stats.standardize(df, ["a", "b"])
    r = out.agg(F.avg("a").alias("ma"), F.stddev_pop("a").alias("sa"),
                F.avg("b").alias("mb"), F.stddev_pop("b").alias("sb")).first()
    assert abs(r["ma"]) < 1e-12 and abs(r["mb"]) < 1e-12
    assert r["sa"] == pytest.approx(1.0) and r["sb"] == pytest.approx(1.0)


def test_minmax_range(spark):
    df = spark.range(50).select((F.col("id") * 3 - 7).alias("x"))
    r = stats.minmax_scale(df, ["x"]).agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    assert (r["lo"], r["hi"]) == (0.0, 1.0)


def test_wide_correlation_matches_pairwise(spark):
    df = spark.range(300).select((F.col("id") % 17).cast("double").alias("a"),
                                 ((F.col("id") * 7) % 23).cast("double").alias("b"),
                                 (F.col("id") % 17 * 2 + (F.col("id") % 3)).cast("double").alias("c"))
    pair = {(r["feature_a"], r["feature_b"]): r["corr"] for r in stats.correlation_matrix(df, ["a", "b", "c"]).collect()}
    wide = {(r["feature_a"], r["feature_b"]): r["corr"] for r in stats.correlation_matrix_wide(df, ["a", "b", "c"]).collect()}
    assert set(pair) == set(wide)
    for k in pair:
        assert wide[k] == pytest.approx(pair[k], abs=1e-9)
