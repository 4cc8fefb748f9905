"""Scaling, moments, correlation, metrics, intervals, outlier flags.

(A7-A12, A14, P16-P19, I1-I3, M1, M12.)  All global statistics are one-row
aggregates - partial per task, one row per task through the exchange.  Only
those scalars reach the driver; they return to the plan as literals, so
applying them is a narrow projection and no row ever moves for them.
"""

from __future__ import annotations

import math
import sys
from itertools import combinations_with_replacement
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenocast.functions.numeric import half_even_int, normal_z
from phenocast.functions.quantiles import kth_smallest_many

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # executors need no copy of it


# --------------------------------------------------------------------------- moments
def column_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: ``{c}__mean`` and population ``{c}__std`` for each column."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"{c}__mean"), F.stddev_pop(x).alias(f"{c}__std")]
    return df.agg(*aggs)


def normalization_params(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long table (feature, mean, std) with the population spread."""
    one = column_moments(df, cols)
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"{c}__mean").alias("mean"),
                              F.col(f"{c}__std").alias("std")) for c in cols])
    return one.select(F.inline(rows))


def params_dict(params: DataFrame, cols: Sequence[str]) -> dict:
    """Long (feature, mean, std) table -> {feature: (mean, std)} for the given features.

    The table has one row per feature, so fetching it is bounded by the
    number of features.
    """
    rows = params.where(F.col("feature").isin(list(cols))).select("feature", "mean", "std").collect()
    return {r["feature"]: (r["mean"], r["std"]) for r in rows}


def _lit_double(x) -> Column:
    return F.lit(x).cast("double")


def standardize(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None,
                suffix: str = "") -> DataFrame:
    """Scaler form: ``(x - mean) / std`` with population std; constant column -> 0 (M1).

    The moments are one global aggregate; the scalars go back as literals,
    so scaling is a narrow projection.
    """
    m = column_moments(fit_on if fit_on is not None else df, cols).first()
    return df.withColumns({
        f"{c}{suffix}": (F.col(c).cast("double") - _lit_double(m[f"{c}__mean"]))
        / F.coalesce(F.nullif(_lit_double(m[f"{c}__std"]), F.lit(0.0)), F.lit(1.0))
        for c in cols})


def normalize_with_params(df: DataFrame, params: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Stored-parameter form: ``try_divide(x - mean, std)``; std 0 -> NULL.

    ``params`` is the long (feature, mean, std) table.  A feature missing from
    the rows raises (schema check instead of a type guard).
    """
    missing = set(cols) - set(df.columns)
    if missing:
        raise ValueError(f"rows lack feature columns: {sorted(missing)}")
    p = params_dict(params, cols)
    absent = set(cols) - set(p)
    if absent:
        raise ValueError(f"no stored parameters for: {sorted(absent)}")
    return df.withColumns({
        c: F.try_divide(F.col(c).cast("double") - _lit_double(p[c][0]), _lit_double(p[c][1]))
        for c in cols})


def minmax_params(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long table (feature, min, max) in one aggregation pass."""
    one = df.agg(*[F.min(F.col(c).cast("double")).alias(f"{c}__min") for c in cols],
                 *[F.max(F.col(c).cast("double")).alias(f"{c}__max") for c in cols])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"{c}__min").alias("min"),
                              F.col(f"{c}__max").alias("max")) for c in cols])
    return one.select(F.inline(rows))


def minmax_scale(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """``(x - min) / (max - min)``; constant column -> NULL."""
    src = fit_on if fit_on is not None else df
    aggs = []
    for c in cols:
        aggs += [F.min(F.col(c).cast("double")).alias(f"{c}__min"),
                 F.max(F.col(c).cast("double")).alias(f"{c}__max")]
    r = src.agg(*aggs).first()
    return df.withColumns({
        c: F.try_divide(F.col(c).cast("double") - _lit_double(r[f"{c}__min"]),
                        _lit_double(r[f"{c}__max"]) - _lit_double(r[f"{c}__min"])) for c in cols})


# --------------------------------------------------------------------------- correlation
# covar_pop keeps 4 buffer fields, stddev_pop 3: 10 per pair.  Whole-stage
# codegen is switched off above spark.sql.codegen.maxFields (100), which made a
# single wide aggregate 2-3x slower, so the pairs are aggregated in chunks.
_PAIRS_PER_PASS = 9


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, pairwise-complete, long form (A10).

    ``covar_pop / (stddev_pop * stddev_pop)`` over the rows where both values
    are present; a constant column gives NULL instead of an error.  Pairs are
    aggregated in chunks that stay inside whole-stage codegen, over one
    persisted projection.  For hundreds of columns use
    :func:`correlation_matrix_wide`, one pass whatever their number.
    """
    cols = list(cols)
    pairs = list(combinations_with_replacement(range(len(cols)), 2))
    src = df.select(*[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(cols)])
    chunks = [pairs[i:i + _PAIRS_PER_PASS] for i in range(0, len(pairs), _PAIRS_PER_PASS)]
    if len(chunks) > 1:
        src = src.persist(StorageLevel.MEMORY_AND_DISK)
    parts = []
    for chunk in chunks:
        aggs = []
        for i, j in chunk:
            a, b = F.col(f"_x{i}"), F.col(f"_x{j}")
            a2 = F.when(b.isNotNull(), a)
            b2 = F.when(a.isNotNull(), b)
            aggs.append(F.try_divide(F.covar_pop(a2, b2),
                                     F.stddev_pop(a2) * F.stddev_pop(b2)).alias(f"_c{i}_{j}"))
        one = src.agg(*aggs)
        structs = []
        for i, j in chunk:
            structs.append(F.struct(F.lit(cols[i]).alias("feature_a"), F.lit(cols[j]).alias("feature_b"),
                                    F.col(f"_c{i}_{j}").alias("corr")))
            if i != j:
                structs.append(F.struct(F.lit(cols[j]).alias("feature_a"),
                                        F.lit(cols[i]).alias("feature_b"),
                                        F.col(f"_c{i}_{j}").alias("corr")))
        parts.append(one.select(F.inline(F.array(*structs))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def correlation_matrix_wide(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of many columns, pairwise-complete, long form (A10).

    One pass: a task adds up, over its rows, the masked block products of values and presence
    (counts, sums, squares and cross products of each pair over the rows that have both), so
    240 columns cost six 240 x 240 tables a task instead of 28,920 aggregates; the tables are
    added up by row of the result.  Values are taken relative to the means of a few rows, which
    only spares digits.  A missing value is NULL or NaN; a column that is constant where the
    other is present, or a pair that never meets, gives NULL.
    """
    cols = list(cols)
    k = len(cols)
    x = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    known = [F.when(~F.isnan(f"x{i}"), F.col(f"x{i}")) for i in range(k)]
    near = x.limit(1000).agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(known)]).first()     # one row
    shift = np.array([v if v is not None else 0.0 for v in near])
    names = ["n", "sx", "sy", "sxx", "syy", "sxy"]

    def products(batches):
        total = np.zeros((6, k, k))
        for batch in batches:
            v = np.stack([np.asarray(c.to_numpy(zero_copy_only=False), dtype=np.float64) for c in batch.columns], axis=1)
            there = ~np.isnan(v)
            m, z = there.astype(np.float64), np.where(there, v - shift, 0.0)
            s, q = z.T @ m, (z * z).T @ m
            total += np.stack([m.T @ m, s, s.T, q, q.T, z.T @ z])
        if total[0].any():
            yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), *[pa.array(list(t), pa.list_(pa.float64())) for t in total]], names=["i", *names])

    def added(batches):
        rows: dict = {}
        for batch in batches:
            tables = [np.stack(c.to_numpy(zero_copy_only=False)) for c in batch.columns[1:]]
            for j, i in enumerate(batch.column(0).to_pylist()):
                rows[i] = rows.get(i, 0) + np.stack([t[j] for t in tables])
        for i, t in rows.items():
            yield pa.RecordBatch.from_arrays([pa.array([i] * k, pa.int32()), pa.array(range(k), pa.int32()), *[pa.array(c) for c in t]], names=["i", "j", *names])

    sums = x.mapInArrow(products, "i int, " + ", ".join(f"{c} array<double>" for c in names))
    sums = sums.repartition(min(k, 64), "i").mapInArrow(added, "i int, j int, " + ", ".join(f"{c} double" for c in names))
    n = F.col("n")
    vx, vy = n * F.col("sxx") - F.col("sx") * F.col("sx"), n * F.col("syy") - F.col("sy") * F.col("sy")
    spread = (vx > 1e-12 * n * F.col("sxx")) & (vy > 1e-12 * n * F.col("syy"))      # else constant, up to rounding
    corr = F.when((n > 0) & spread, F.when(F.col("i") == F.col("j"), 1.0).otherwise((n * F.col("sxy") - F.col("sx") * F.col("sy")) / F.sqrt(vx * vy)))
    name = F.array(*[F.lit(c) for c in cols])
    every = df.sparkSession.range(k * k).select((F.col("id") / k).cast("int").alias("a"), (F.col("id") % k).cast("int").alias("b"))
    got = sums.select("i", "j", corr.alias("corr"))
    return every.join(got, (F.col("a") == F.col("i")) & (F.col("b") == F.col("j")), "left").select(
        F.element_at(name, F.col("a") + 1).alias("feature_a"), F.element_at(name, F.col("b") + 1).alias("feature_b"), "corr")


# --------------------------------------------------------------------------- metrics
def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: n, MSE and R^2 of ``prediction`` against ``label``."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    err2 = (y - p) * (y - p)
    return df.where(y.isNotNull() & p.isNotNull()).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(err2).alias("mse"),
        (F.lit(1.0) - F.try_divide(F.sum(err2), F.count(F.lit(1)) * F.var_pop(y))).alias("r2"),
    )


def rounded_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Held-out evaluation of predictions rounded half-to-even."""
    return regression_metrics(df.withColumn("_p_int", half_even_int(prediction)), label, "_p_int")


# --------------------------------------------------------------------------- intervals
def normal_interval(df: DataFrame, prediction: str, tail_alpha: float = 0.05,
                    lower: str = "lower", upper: str = "upper") -> DataFrame:
    """Bounds ``prediction -/+ z * stddev_pop(all predictions)``, rounded half-even.

    ``z = |Phi^-1(tail_alpha / 2)|`` (0.05 -> 1.96, 0.75 -> 0.3186).  The
    spread is that of the whole batch of predictions, so a batch of one has
    zero width.  Persist or checkpoint ``df`` first when it is expensive: the
    rows are read twice (global spread, then the rows).
    """
    z = normal_z(tail_alpha)
    spread = df.agg(F.stddev_pop(F.col(prediction).cast("double")).alias("s")).first()["s"]
    half = F.lit(z) * _lit_double(spread)
    p = F.col(prediction).cast("double")
    return df.withColumns({lower: half_even_int(p - half), upper: half_even_int(p + half)})


def final_predictions(df: DataFrame, prediction: str, out: str = "prediction",
                      tail_alpha: float = 0.75) -> DataFrame:
    """Rounded prediction with the normal interval at ``tail_alpha``."""
    with_bounds = normal_interval(df, prediction, tail_alpha)
    return with_bounds.withColumn(out, half_even_int(prediction))


def interval_ranks(n: int, coverage: float = 0.99, index_rule: str = "inner") -> tuple[int, int]:
    """0-based ranks of the empirical bounds (Q19).

    ``inner``: floor(q_lo (n-1)), ceil(q_hi (n-1)).  ``legacy``: floor(q_lo n),
    floor(q_hi n) with the coverage fixed at 0.99, as the older code did.
    """
    if index_rule == "legacy":
        coverage = 0.99
        q_lo, q_hi = (1 - coverage) / 2, (1 + coverage) / 2
        return int(math.floor(q_lo * n)), min(int(math.floor(q_hi * n)), n - 1)
    if index_rule != "inner":
        raise ValueError(f"unknown index rule {index_rule!r}")
    q_lo = (1 - coverage) / 2
    q_hi = 1 - q_lo
    return int(math.floor(q_lo * (n - 1))), int(math.ceil(q_hi * (n - 1)))


def quantile_interval(df: DataFrame, prediction: str, coverage: float = 0.99,
                      index_rule: str = "inner", lower: str = "lower",
                      upper: str = "upper") -> DataFrame:
    """Empirical interval: the same pair of order statistics on every row.

    The two ranks are found exactly with :func:`kth_smallest_many` (no global
    sort, no single-task window); the two scalars are attached as literals.
    """
    v_lo, v_hi = kth_smallest_many(df, [
        (prediction, lambda n: interval_ranks(n, coverage, index_rule)[0]),
        (prediction, lambda n: interval_ranks(n, coverage, index_rule)[1])])
    dtype = df.schema[prediction].dataType
    return df.withColumns({lower: F.lit(v_lo).cast(dtype), upper: F.lit(v_hi).cast(dtype)})


# --------------------------------------------------------------------------- outliers
def lower_median_rank(n: int) -> int:
    return (n - 1) // 2


def upper_quantile_rank(n: int, q: float) -> int:
    """Rank of the discrete ``q`` quantile: smallest value with cume_dist >= q."""
    return max(int(math.ceil(q * n)) - 1, 0)


def outlier_flags(df: DataFrame, cols: Sequence[str], contamination: float = 0.05,
                  suffix: str = "_outlier") -> DataFrame:
    """Per-feature anomaly flags (M12, re-aimed from per-feature isolation forests).

    score = |x - lower median|; a value is flagged when its score is strictly
    above the discrete ``1 - contamination`` quantile of the scores, so at
    most ``contamination`` of the non-null values are flagged and ties never
    split.  Medians and cut points are exact order statistics found with
    :func:`kth_smallest_many`; the flags are one narrow projection.  NULL -> False.
    """
    cols = list(cols)
    src = df.select(*cols).persist(StorageLevel.MEMORY_AND_DISK)
    kinds = {c: src.schema[c].dataType for c in cols}
    meds = kth_smallest_many(src, [(c, lower_median_rank) for c in cols])
    medians = {c: m for c, m in zip(cols, meds) if m is not None}
    present = list(medians)
    scores = src.select(*[F.abs(F.col(c) - F.lit(medians[c]).cast(kinds[c])).alias(c) for c in present])
    q = 1 - contamination
    cuts = dict(zip(present, kth_smallest_many(
        scores, [(c, lambda n, q=q: upper_quantile_rank(n, q)) for c in present])))
    src.unpersist()
    flags = {}
    for c in cols:
        if c not in medians:
            flags[c + suffix] = F.lit(False)
            continue
        score = F.abs(F.col(c) - F.lit(medians[c]).cast(kinds[c]))
        flag = score > F.lit(cuts[c]).cast(kinds[c])
        if isinstance(kinds[c], (T.DoubleType, T.FloatType)):
            flag = flag & ~F.isnan(c)
        flags[c + suffix] = F.coalesce(flag, F.lit(False))
    return df.withColumns(flags)


def flagged_share(flag_cols: Sequence[str]) -> Column:
    """Share of set flags per row (0 when there are no flag columns)."""
    if not flag_cols:
        return F.lit(0.0)
    total = sum((F.col(c).cast("int") for c in flag_cols), F.lit(0))
    return total / F.lit(len(flag_cols))


def outlier_row_filter(df: DataFrame, flag_cols: Sequence[str], max_share: float = 0.10,
                       keep_flags: bool = False) -> DataFrame:
    """Drop rows where more than ``max_share`` of the flags are set."""
    out = df.where(~(flagged_share(flag_cols) > F.lit(max_share)))
    return out if keep_flags else out.drop(*flag_cols)


def filter_counts(df: DataFrame, flag_cols: Sequence[str], max_share: float = 0.10) -> DataFrame:
    """Rows before and after the outlier filter in one pass."""
    removed = flagged_share(flag_cols) > F.lit(max_share)
    return df.agg(F.count(F.lit(1)).alias("rows_before"),
                  F.count_if(~removed).alias("rows_after"))
