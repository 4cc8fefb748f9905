"""Model operators on Spark MLlib.

Models see a feature table (one row per example, one column per feature,
a label column).  Scaling uses the population spread via expressions
(MLlib's ``StandardScaler`` uses the sample spread), the parameters are kept
as a long (feature, mean, std) table so new rows can be normalized the same
way, and the estimator runs inside a ``PipelineModel`` that can be saved.
"""

from __future__ import annotations

import math
import random
from dataclasses import dataclass
from itertools import product
from typing import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from phenocast.functions.numeric import half_even_int, hash64
from phenocast.functions.quantiles import kth_smallest_many
from phenocast.operators import boosting
from phenocast.operators.stats import normalization_params, params_dict, regression_metrics

# The final gradient-boosting settings of the source (sklearn names
# in comments), mapped to GBTRegressor parameters.
GBT_SETTINGS = {
    "maxIter": 200,                   # n_estimators
    "stepSize": 0.1,                  # learning_rate
    "maxDepth": 4,                    # max_depth
    "featureSubsetStrategy": "sqrt",  # max_features
    "subsamplingRate": 0.8,           # subsample
    "minInstancesPerNode": 5,         # min_samples_leaf 1, min_samples_split 10 (see sklearn_to_spark)
    "minInfoGain": 0.0,               # min_impurity_decrease
    "minWeightFractionPerNode": 0.0,  # min_weight_fraction_leaf
    "lossType": "squared",            # loss
}
RF_SETTINGS = {"numTrees": 100}

# Search grids of the source, in sklearn names.
GRID_PRESETS = {
    "base": {
        "n_estimators": [50, 100, 200],
        "learning_rate": [0.01, 0.1, 0.2],
        "max_depth": [3, 4, 5],
        "min_samples_split": [2, 5, 10],
        "min_samples_leaf": [1, 2, 4],
        "subsample": [0.8, 0.9, 1.0],
        "max_features": ["auto", "sqrt", "log2"],
    },
    "base_2": {
        "n_estimators": [50, 100, 200],
        "learning_rate": [0.01, 0.05, 0.1],
        "max_depth": [2, 3, 4],
        "min_samples_split": [2, 5, 10],
        "min_samples_leaf": [1, 2, 4],
        "subsample": [0.8, 0.9, 1.0],
        "max_features": ["auto", "sqrt", "log2"],
    },
    "expansive": {
        "n_estimators": [50, 100, 200, 300],
        "learning_rate": [0.01, 0.05, 0.1, 0.2],
        "max_depth": [3, 4, 5, 6],
        "min_samples_split": [2, 5, 10, 15],
        "min_samples_leaf": [1, 2, 4, 6],
        "subsample": [0.8, 0.9, 1.0],
        "max_features": [1.0, "sqrt", "log2", None],
        "loss": ["ls", "lad", "huber", "quantile"],
        "alpha": [0.5, 0.9],
        "criterion": ["friedman_mse", "mse", "mae"],
    },
    "combined": {
        "n_estimators": [50, 100, 200, 150, 250],
        "learning_rate": [0.01, 0.1, 0.2, 0.05, 0.15],
        "max_depth": [3, 4, 5, 2],
        "min_samples_split": [2, 5, 10, 8, 12],
        "min_samples_leaf": [1, 2, 4],
        "subsample": [0.8, 0.9, 1.0, 0.7],
        "max_features": ["auto", "sqrt", "log2"],
    },
}

# Random-search distributions of the source (low, high) per parameter.
RANDOM_SEARCH_SPACE = {
    "n_estimators": ("randint", 50, 300),
    "learning_rate": ("uniform", 0.01, 0.2),
    "max_depth": ("randint", 3, 10),
    "min_samples_split": ("randint", 2, 21),
    "min_samples_leaf": ("randint", 1, 11),
    "subsample": ("uniform", 0.6, 1.0),
    "max_features": ("choice", [1.0, "sqrt", "log2"]),
    "alpha": ("uniform", 0.0, 0.1),
    "tol": ("uniform", 1e-5, 1e-5 + 1e-3),
    "warm_start": ("choice", [True, False]),
}

# Settings that MLlib's boosting has no counterpart for: accepted and without effect.
# ``alpha`` only matters to the huber and quantile losses, which MLlib lacks as well.
IGNORED_SETTINGS = ("alpha", "ccp_alpha", "criterion", "init", "max_leaf_nodes", "random_state",
                    "verbose", "warm_start")


# --------------------------------------------------------------------------- split
def hash_split(df: DataFrame, keys: Sequence[str], test_fraction: float = 0.2, seed: int = 42,
               out: str = "split") -> DataFrame:
    """Exact-size deterministic split: the ceil(f * n) smallest key hashes are 'test' (M5).

    No row moves: the cut value is an exact order statistic of the hash
    (:func:`kth_smallest_many`), then each row compares its own hash with it.
    The size is exact when the key columns identify rows uniquely (rows with
    equal keys share a hash and land on the same side).
    """
    with_h = df.withColumn("_h", hash64(keys, seed))
    if test_fraction <= 0:
        return df.withColumn(out, F.lit("train"))
    (cut,) = kth_smallest_many(with_h, [("_h", lambda n: int(math.ceil(test_fraction * n)) - 1)])
    if cut is None:                     # no rows at all
        return df.withColumn(out, F.lit("train"))
    return (with_h.withColumn(out, F.when(F.col("_h") <= F.lit(cut), "test").otherwise("train"))
                  .drop("_h"))


def train_test(df: DataFrame, keys: Sequence[str], test_fraction: float = 0.2,
               seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """The two sides of :func:`hash_split`; persist ``df`` first when it is expensive."""
    labelled = hash_split(df, keys, test_fraction, seed)
    return (labelled.where(F.col("split") == "train").drop("split"),
            labelled.where(F.col("split") == "test").drop("split"))


# --------------------------------------------------------------------------- importance
def importance_rank(df: DataFrame, feature: str = "feature", score: str = "score",
                    out: str = "rank") -> DataFrame:
    """Rank features by importance, descending, ties by name.

    The table has one row per feature (bounded by the schema width), so a
    single ordered window is fine here.
    """
    w = Window.orderBy(F.desc(score), F.asc(feature))
    return df.withColumn(out, F.row_number().over(w).cast("int"))


def importance_cutoff(df: DataFrame, threshold: float = 0.9, feature: str = "feature",
                      score: str = "score", rank: str = "rank") -> DataFrame:
    """Shortest prefix of the ranking whose cumulative importance reaches ``threshold``.

    A row is kept when the cumulative importance *before* it is still below
    the threshold.
    """
    if rank not in df.columns:
        df = importance_rank(df, feature, score, rank)
    run = Window.orderBy(rank).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.orderBy(rank).rowsBetween(Window.unboundedPreceding, -1)
    return (df.withColumn("cum_score", F.sum(score).over(run))
              .withColumn("_before", F.coalesce(F.sum(score).over(before), F.lit(0.0)))
              .where(F.col("_before") < F.lit(threshold)).drop("_before"))


# --------------------------------------------------------------------------- fitting
@dataclass
class FittedModel:
    """A fitted pipeline with its normalization table and feature list."""
    model: object            # pyspark.ml.PipelineModel or boosting.BoostedModel
    params: DataFrame        # long (feature, mean, std)
    features: list

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        scaled = scale_with(df, self.params, self.features)
        pred = (self.model.transform(scaled, "_prediction") if isinstance(self.model, boosting.BoostedModel)
                else self.model.transform(scaled)).drop("_features", *[f"{c}__z" for c in self.features])
        return pred.withColumnRenamed("_prediction", out) if out != "_prediction" else pred

    def fill(self, df: DataFrame) -> DataFrame:
        """Gaps of the features filled with the stored training means.

        A row is filled alike alone and in any batch.
        """
        p = params_dict(self.params, self.features)
        return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(p[c][0]).cast("double"))
                               for c in self.features})


def scale_with(df: DataFrame, params: DataFrame, features: Sequence[str]) -> DataFrame:
    """Scaler form with stored parameters into ``__z`` columns (constant -> 0)."""
    p = params_dict(params, features)
    return df.withColumns({
        f"{c}__z": (F.col(c).cast("double") - F.lit(p[c][0]).cast("double"))
        / F.coalesce(F.nullif(F.lit(p[c][1]).cast("double"), F.lit(0.0)), F.lit(1.0))
        for c in features})


def make_estimator(kind: str = "gbt", label: str = "label", settings: dict | None = None,
                   seed: int = 42):
    from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
    common = dict(featuresCol="_features", labelCol=label, predictionCol="_prediction")
    # cut the lineage of the per-tree state every 10 trees (needs spark.checkpoint.dir)
    ckpt = {"checkpointInterval": 10}
    if kind == "gbt":
        return GBTRegressor(**common, seed=seed, **{**ckpt, **GBT_SETTINGS, **(settings or {})})
    if kind == "rf":
        return RandomForestRegressor(**common, seed=seed, **{**ckpt, **RF_SETTINGS, **(settings or {})})
    if kind == "linear":
        return LinearRegression(**common, solver="normal", **(settings or {}))
    raise ValueError(f"unknown model kind {kind!r}")


def _fitting_rows(train: DataFrame, features: list, label: str, partitions: int | None, extra: Sequence[str] = ()):
    """(normalization table, scaled rows with a label), the rows to be persisted by the caller.

    The table has one row per feature, so it is held as a local relation.
    ``partitions`` spreads the rows over that many partitions once, before the many
    passes of a tree learner; default: left as they are.  MLlib seeds its row samples
    per partition, so the fitted trees depend on it.
    """
    params = normalization_params(train, features)
    params = train.sparkSession.createDataFrame(params.collect(), params.schema)
    rows = train.where(F.col(label).isNotNull())
    if partitions:
        rows = rows.repartition(partitions)
    keep = [label, *extra, *([VALIDATION_COL] if VALIDATION_COL in train.columns else [])]
    return params, scale_with(rows, params, features).select(
        *keep, *[f"{c}__z" for c in features])


def boosting_setting(p: dict, n_features: int) -> boosting.Setting:
    """GBTRegressor parameters as a setting of :mod:`phenocast.operators.boosting`."""
    own = {"maxIter": "n_estimators", "stepSize": "learning_rate", "maxDepth": "max_depth", "minInstancesPerNode": "min_samples_leaf",
           "minWeightFractionPerNode": "min_weight_fraction_leaf", "subsamplingRate": "subsample"}
    rest = set(p) - set(own) - {"featureSubsetStrategy", "minInfoGain", "lossType"}
    if rest or p.get("minInfoGain", 0.0) != 0.0:
        raise ValueError(f"the histogram engine does not take {sorted(rest) or 'minInfoGain'}")
    some = p.get("featureSubsetStrategy", "auto")
    tried = {"auto": None, "all": None, "sqrt": math.ceil(math.sqrt(n_features)), "log2": max(1, math.ceil(math.log2(n_features))),
             "onethird": math.ceil(n_features / 3)}     # counted as MLlib does
    if some not in tried:
        raise ValueError(f"the histogram engine does not take featureSubsetStrategy {some!r}")
    return boosting.Setting.of({"loss": {"squared": "squared_error", "absolute": "absolute_error"}[p.get("lossType", "squared")],
                                "max_features": tried[some], **{own[k]: v for k, v in p.items() if k in own}})


def packed_rows(train: DataFrame, features: Sequence[str], label: str, seed: int = 42,
                keys: Sequence[str] | None = None) -> tuple[DataFrame, boosting.Rows]:
    """(normalization table, binned rows) that the histogram engine's fits on any of the features can share."""
    features = list(features)
    keys = list(keys) if keys else [f"{c}__z" for c in features] + [label]
    params, scaled = _fitting_rows(train, features, label, None, extra=[c for c in keys if c in train.columns and c != label])
    return params, boosting.prepare(scaled, [f"{c}__z" for c in features], label, keys, 1, seed, max_bins=32)


def _fit_histogram(train, features: list, label: str, settings: dict, seed: int, keys: Sequence[str] | None, packed) -> FittedModel:
    params, rows = packed or packed_rows(train, features, label, seed, keys)
    if packed:
        of = {r["feature"]: r for r in params.collect()}        # a row a feature
        params = train.sparkSession.createDataFrame([of[c] for c in features], params.schema)
    rows = rows.only([f"{c}__z" for c in features])
    return FittedModel(boosting.fit_many(rows, [(boosting_setting(settings, len(features)), -1)], seed)[0], params, features)


def fit_regressor(train: DataFrame, features: Sequence[str], label: str, kind: str = "gbt",
                  settings: dict | None = None, seed: int = 42, partitions: int | None = None,
                  engine: str = "mllib", keys: Sequence[str] | None = None, packed: tuple | None = None) -> FittedModel:
    """Scale (population spread, fitted on ``train``) -> assemble -> fit (M1, M6-M8).

    Only the label and the scaled features are persisted, and released after the fit.
    ``engine`` "histogram" trains "gbt" by :mod:`phenocast.operators.boosting`, in half of
    MLlib's time and less; its row samples follow from ``keys`` (features and label by
    default), not from the layout of the rows.  ``packed``: the :func:`packed_rows` of ``train``,
    of these features or more, so that several fits read and bin the rows once.
    """
    if engine == "histogram":
        if kind != "gbt":
            raise ValueError(f"the histogram engine does not fit {kind!r}")
        return _fit_histogram(train, list(features), label, {**GBT_SETTINGS, **(settings or {})}, seed, keys, packed)
    if engine != "mllib":
        raise ValueError(f"unknown engine {engine!r}")
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from phenocast.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(train.sparkSession)   # boosting cuts lineage every 10 trees
    features = list(features)
    params, scaled = _fitting_rows(train, features, label, partitions)
    scaled = scaled.persist(StorageLevel.MEMORY_AND_DISK)
    assembler = VectorAssembler(inputCols=[f"{c}__z" for c in features], outputCol="_features",
                                handleInvalid="keep")
    est = make_estimator(kind, label, settings, seed)
    try:
        return FittedModel(Pipeline(stages=[assembler, est]).fit(scaled), params, features)
    finally:
        scaled.unpersist()


def feature_importances(fitted: FittedModel) -> DataFrame:
    """Long table (feature, score) from a tree model; names come from the fitted frame (M9)."""
    if isinstance(fitted.model, boosting.BoostedModel):
        gains = [0.0] * len(fitted.features)        # as MLlib counts them: of all trees, then as shares
        for tree in fitted.model.trees:
            for f, g in zip(tree.feature, tree.gain):
                if f >= 0:
                    gains[f] += g
        scores = [g / (sum(gains) or 1.0) for g in gains]
    else:
        scores = fitted.model.stages[-1].featureImportances.toArray().tolist()
    spark = fitted.params.sparkSession
    return spark.createDataFrame(list(zip(fitted.features, [float(s) for s in scores])),
                                 "feature string, score double")


def evaluate(fitted: FittedModel, test: DataFrame, label: str, rounded: bool = True) -> DataFrame:
    """MSE and R^2 on held-out rows; predictions rounded half-even first."""
    pred = fitted.transform(test, "prediction")
    if rounded:
        pred = pred.withColumn("prediction", half_even_int("prediction"))
    return regression_metrics(pred, label, "prediction")


def two_stage_selection(train: DataFrame, test: DataFrame, features: Sequence[str], label: str,
                        threshold: float = 0.9, settings: dict | None = None, seed: int = 42):
    """Fit on all features -> importance cutoff -> refit on the selected.

    Returns (selected feature names in rank order, refitted model, cutoff table).
    The cutoff table has one row per feature, so collecting names is bounded.
    """
    first = fit_regressor(train, features, label, "gbt", settings, seed)
    cut = importance_cutoff(importance_rank(feature_importances(first)), threshold)
    selected = [r["feature"] for r in cut.orderBy("rank").select("feature").collect()]
    second = fit_regressor(train, selected, label, "gbt", settings, seed)
    return selected, second, cut


# --------------------------------------------------------------------------- search
VALIDATION_COL = "is_validation"
LOSSES = {"ls": "squared", "squared_error": "squared", "lad": "absolute", "absolute_error": "absolute"}
_MAPPED_SETTINGS = {"n_estimators", "learning_rate", "max_depth", "min_samples_leaf", "min_samples_split",
                    "subsample", "max_features", "loss", "tol", "n_iter_no_change",
                    "validation_fraction", "min_impurity_decrease", "min_weight_fraction_leaf"}


def sklearn_to_spark(p: dict) -> dict:
    """Map sklearn-named settings onto GBTRegressor parameters.

    Settings in ``IGNORED_SETTINGS`` have no counterpart and no effect; the huber and
    quantile losses raise (:func:`supported` tells them beforehand).  ``tol`` maps to
    ``validationTol``; it and ``n_iter_no_change`` take effect through
    :func:`validation_split`, which names MLlib's indicator column.
    """
    unknown = set(p) - set(IGNORED_SETTINGS) - _MAPPED_SETTINGS
    if unknown:
        raise ValueError(f"unknown settings: {sorted(unknown)}")
    out = {}
    if "tol" in p:
        out["validationTol"] = float(p["tol"])
    if p.get("n_iter_no_change") is not None:
        out["validationIndicatorCol"] = VALIDATION_COL
    if "min_impurity_decrease" in p:
        out["minInfoGain"] = float(p["min_impurity_decrease"])
    if "min_weight_fraction_leaf" in p:
        out["minWeightFractionPerNode"] = float(p["min_weight_fraction_leaf"])
    if "n_estimators" in p:
        out["maxIter"] = int(p["n_estimators"])
    if "learning_rate" in p:
        out["stepSize"] = float(p["learning_rate"])
    if "max_depth" in p:
        out["maxDepth"] = int(p["max_depth"])
    leaf = int(p.get("min_samples_leaf", 1))
    split = int(p.get("min_samples_split", 2))
    # no min_samples_split in MLlib: a split needs two children of >= leaf rows
    out["minInstancesPerNode"] = max(leaf, split // 2)
    if "subsample" in p:
        out["subsamplingRate"] = float(p["subsample"])
    if "max_features" in p:
        mf = p["max_features"]
        out["featureSubsetStrategy"] = {"auto": "all", None: "all", 1.0: "all"}.get(mf, str(mf))
    if "loss" in p:
        if not supported(p):
            raise ValueError(f"MLlib has no {p['loss']!r} loss")
        out["lossType"] = LOSSES[p["loss"]]
    return out


def supported(p: dict) -> bool:
    """Whether MLlib has the loss of a setting."""
    return p.get("loss", "squared_error") in LOSSES


def validation_split(df: DataFrame, keys: Sequence[str], fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """Rows marked for early stopping (``validation_fraction``), by key hash, for ``n_iter_no_change``."""
    return hash_split(df, keys, fraction, seed, "_side").withColumn(
        VALIDATION_COL, F.col("_side") == "test").drop("_side")


def draw_grid(grid: dict, n: int, seed: int = 42, ok=supported) -> list[dict]:
    """``n`` different settings of a grid, seeded; those that are not ``ok`` are left out, by
    default the losses that MLlib lacks (M10)."""
    settings = [s for s in expand_grid(grid) if ok(s)]
    return random.Random(seed).sample(settings, min(n, len(settings)))


def expand_grid(grid: dict) -> list[dict]:
    keys = list(grid)
    return [dict(zip(keys, vals)) for vals in product(*[grid[k] for k in keys])]


def draw_settings(space: dict, n: int, seed: int = 42) -> list[dict]:
    """Seeded draw of ``n`` settings from (randint/uniform/choice) distributions."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        s = {}
        for k, spec in space.items():
            if spec[0] == "randint":
                s[k] = rng.randrange(spec[1], spec[2])
            elif spec[0] == "uniform":
                s[k] = rng.uniform(spec[1], spec[2])
            else:
                s[k] = rng.choice(spec[1])
        out.append(s)
    return out


def cross_validate(*args, **kwargs):
    """k-fold scores of settings, the best refitted (M10, M11): :func:`phenocast.operators.search.cross_validate`."""
    from phenocast.operators import search
    return search.cross_validate(*args, **kwargs)


def model_comparison(train: DataFrame, test: DataFrame, features: Sequence[str], label: str,
                     kinds: Sequence[str] = ("rf", "gbt", "linear"), seed: int = 42) -> DataFrame:
    """MSE and R^2 of several model families on the same split."""
    from functools import reduce
    tables = []
    for kind in kinds:
        fitted = fit_regressor(train, features, label, kind, seed=seed)
        tables.append(evaluate(fitted, test, label).withColumn("model", F.lit(kind)))
    return reduce(lambda a, b: a.unionByName(b), tables).select("model", "n", "mse", "r2")
