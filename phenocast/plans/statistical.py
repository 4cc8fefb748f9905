"""Exact statistical and model-support queries (sections 2.4-2.6, 2.10 exact ids)."""

from __future__ import annotations

from pyspark.sql import functions as F

from phenocast.functions.numeric import normal_z, round_doubles
from phenocast.operators import assemble, isolation, models, spatial, stats
from phenocast.plans import standins as V
from phenocast.plans.registry import register
from phenocast.plans.standins import FEATURES, with_views

R6 = round_doubles
KEYS = ["l_orderkey", "l_linenumber"]


def _features(spark, d):
    return V.features(spark, d).drop("l_shipdate")


# ---------------------------------------------------------------- moments & scaling
@register("normalization_params", with_views("features") + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, {V.mean_sql(c)} AS mean, round(stddev_pop({c}), 6) AS std FROM features"
    for c in FEATURES))
def q_normalization_params(spark, d):
    params = stats.normalization_params(_features(spark, d), FEATURES)
    return params.withColumn("std", F.round("std", 6))


def _scaled_sql(form: str) -> str:
    if form == "scaler":
        cols = ", ".join(
            f"round((f.{c} - p.m_{c}) / COALESCE(NULLIF(p.s_{c}, 0), 1), 6) AS {c}" for c in FEATURES)
    else:
        cols = ", ".join(f"round((f.{c} - p.m_{c}) / NULLIF(p.s_{c}, 0), 6) AS {c}" for c in FEATURES)
    return cols


_PARAMS_SQL = ", ".join(f"{V.mean_sql(c)} AS m_{c}, stddev_pop({c}) AS s_{c}" for c in FEATURES)


@register("standardize", with_views("features") + f"""
SELECT f.l_orderkey, f.l_linenumber, {_scaled_sql("scaler")}
FROM features f CROSS JOIN (SELECT {_PARAMS_SQL} FROM features) p""")
def q_standardize(spark, d):
    f = _features(spark, d).select(*KEYS, *FEATURES)
    return R6(stats.standardize(f, FEATURES))


@register("normalize_new_rows", with_views("features") + f"""
SELECT f.l_orderkey, f.l_linenumber, {_scaled_sql("stored")}
FROM features f CROSS JOIN (SELECT {_PARAMS_SQL} FROM features WHERE year(l_shipdate) < 2000) p
WHERE year(f.l_shipdate) >= 2000""")
def q_normalize_new_rows(spark, d):
    f = V.features(spark, d)
    history = f.where(F.year("l_shipdate") < 2000)
    new = f.where(F.year("l_shipdate") >= 2000).select(*KEYS, *FEATURES)
    params = stats.normalization_params(history, FEATURES)
    return R6(stats.normalize_with_params(new, params, FEATURES))


@register("minmax_scale", with_views("features") + "SELECT f.l_orderkey, f.l_linenumber, " + ", ".join(
    f"CAST(f.{c} - p.lo_{c} AS DOUBLE) / NULLIF(CAST(p.hi_{c} - p.lo_{c} AS DOUBLE), 0) AS {c}"
    for c in FEATURES) + " FROM features f CROSS JOIN (SELECT " + ", ".join(
    f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in FEATURES) + " FROM features) p")
def q_minmax_scale(spark, d):
    f = _features(spark, d).select(*KEYS, *FEATURES)
    return stats.minmax_scale(f, FEATURES)


@register("fill_with_means", with_views("sentinels") + """
SELECT l_orderkey, l_linenumber,
       COALESCE(CAST(quantity AS DOUBLE),
                CAST(sum(quantity) OVER () AS DOUBLE) / CAST(count(quantity) OVER () AS DOUBLE)) AS quantity,
       COALESCE(CAST(NULLIF(discount_pct, 0) AS DOUBLE),
                CAST(sum(NULLIF(discount_pct, 0)) OVER () AS DOUBLE)
                / CAST(count(NULLIF(discount_pct, 0)) OVER () AS DOUBLE)) AS discount_pct,
       COALESCE(CAST(NULLIF(tax_pct, 0) AS DOUBLE),
                CAST(sum(NULLIF(tax_pct, 0)) OVER () AS DOUBLE)
                / CAST(count(NULLIF(tax_pct, 0)) OVER () AS DOUBLE)) AS tax_pct
FROM sentinels""")
def q_fill_with_means(spark, d):
    from phenocast.functions.numeric import sentinel_to_null
    s = sentinel_to_null(V.sentinels(spark, d), ["discount_pct", "tax_pct"], value=0)
    return assemble.fill_with_means(s, ["quantity", "discount_pct", "tax_pct"])


# ---------------------------------------------------------------- correlation, metrics
def _corr_sql() -> str:
    parts = []
    for i, a in enumerate(FEATURES):
        for b in FEATURES:
            parts.append(
                f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(covar_pop(a2, b2) / "
                f"NULLIF(stddev_pop(a2) * stddev_pop(b2), 0), 6) AS corr FROM "
                f"(SELECT CASE WHEN {b} IS NOT NULL THEN {a} END AS a2, "
                f"CASE WHEN {a} IS NOT NULL THEN {b} END AS b2 FROM features) t")
    return "\nUNION ALL\n".join(parts)


@register("correlation_matrix", with_views("features") + _corr_sql())
def q_correlation_matrix(spark, d):
    return R6(stats.correlation_matrix(_features(spark, d), FEATURES))


_WIDE = [f"{m}_{k:02d}" for m in V.MEASURES for k in range(1, 13)]


@register("correlation_gapped", with_views("weather_wide").rstrip() + ",\nlong AS (" + " UNION ALL ".join(
    f"SELECT location, year, '{c}' AS feature, {c} AS x FROM weather_wide" for c in _WIDE) + """)
SELECT feature_a, feature_b, CASE WHEN corr = 0 THEN 0.0 ELSE corr END AS corr FROM (
  SELECT a.feature AS feature_a, b.feature AS feature_b,
         CASE WHEN var_pop(a.x) FILTER (WHERE b.x IS NOT NULL) > 0 AND var_pop(b.x) FILTER (WHERE a.x IS NOT NULL) > 0
              THEN round(covar_pop(a.x, b.x) / (stddev_pop(a.x) FILTER (WHERE b.x IS NOT NULL) * stddev_pop(b.x) FILTER (WHERE a.x IS NOT NULL)), 6) END AS corr
  FROM long a JOIN long b ON a.location = b.location AND a.year = b.year GROUP BY a.feature, b.feature) t""")
def q_correlation_gapped(spark, d):
    """Pairwise-complete correlation of all monthly features, months without data among them (A10)."""
    out = stats.correlation_matrix_wide(V.weather_wide(spark, d), _WIDE)
    return out.withColumn("corr", F.round("corr", 6) + F.lit(0.0))


@register("regression_metrics", with_views("scores") + """
SELECT count(*) AS n, round(avg((y - prediction) * (y - prediction)), 6) AS mse,
       round(1 - sum((y - prediction) * (y - prediction)) / (count(*) * var_pop(y)), 6) AS r2
FROM scores""")
def q_regression_metrics(spark, d):
    return R6(stats.regression_metrics(V.scores(spark, d), "y", "prediction"))


# ---------------------------------------------------------------- intervals
_Z05, _Z75 = normal_z(0.05), normal_z(0.75)


@register("normal_interval", with_views("scores") + f"""
SELECT o_orderkey, prediction,
       CAST(round_even(prediction - {_Z05!r} * sd, 0) AS INTEGER) AS lower,
       CAST(round_even(prediction + {_Z05!r} * sd, 0) AS INTEGER) AS upper
FROM scores CROSS JOIN (SELECT stddev_pop(prediction) AS sd FROM scores) s""")
def q_normal_interval(spark, d):
    s = V.scores(spark, d).select("o_orderkey", "prediction")
    return stats.normal_interval(s, "prediction", tail_alpha=0.05)


@register("final_predictions", with_views("scores") + f"""
SELECT o_orderkey, CAST(round_even(prediction, 0) AS INTEGER) AS prediction,
       CAST(round_even(prediction - {_Z75!r} * sd, 0) AS INTEGER) AS lower,
       CAST(round_even(prediction + {_Z75!r} * sd, 0) AS INTEGER) AS upper
FROM scores CROSS JOIN (SELECT stddev_pop(prediction) AS sd FROM scores) s""")
def q_final_predictions(spark, d):
    s = V.scores(spark, d).select("o_orderkey", "prediction")
    return stats.final_predictions(s, "prediction", "prediction", tail_alpha=0.75) \
        .select("o_orderkey", "prediction", "lower", "upper")


@register("quantile_interval", with_views("scores") + """
SELECT s.o_orderkey, s.prediction, b.lower, b.upper
FROM scores s CROSS JOIN (
  SELECT max(CASE WHEN rn = CAST(floor((1 - CAST(0.99 AS DOUBLE)) / 2 * (n - 1)) AS BIGINT) + 1
                  THEN prediction END) AS lower,
         max(CASE WHEN rn = CAST(ceil((1 - (1 - CAST(0.99 AS DOUBLE)) / 2) * (n - 1)) AS BIGINT) + 1
                  THEN prediction END) AS upper
  FROM (SELECT prediction, row_number() OVER (ORDER BY prediction) AS rn, count(*) OVER () AS n
        FROM scores) r) b""")
def q_quantile_interval(spark, d):
    s = V.scores(spark, d).select("o_orderkey", "prediction")
    return stats.quantile_interval(s, "prediction", coverage=0.99, index_rule="inner")


# ---------------------------------------------------------------- outliers
def _outlier_ctes() -> str:
    parts = []
    for c in FEATURES:
        parts.append(f"""med_{c} AS (
  SELECT max(CASE WHEN rn = (n - 1) // 2 + 1 THEN v END) AS med
  FROM (SELECT {c} AS v, row_number() OVER (ORDER BY {c}) AS rn, count(*) OVER () AS n
        FROM features WHERE {c} IS NOT NULL) t),
cut_{c} AS (
  SELECT max(CASE WHEN rn = CAST(ceil(CAST(0.95 AS DOUBLE) * n) AS BIGINT) THEN s END) AS cut
  FROM (SELECT abs({c} - (SELECT med FROM med_{c})) AS s,
               row_number() OVER (ORDER BY abs({c} - (SELECT med FROM med_{c}))) AS rn,
               count(*) OVER () AS n
        FROM features WHERE {c} IS NOT NULL) t)""")
    return ",\n".join(parts)


_FLAGS_SQL = ", ".join(
    f"COALESCE(abs({c} - (SELECT med FROM med_{c})) > (SELECT cut FROM cut_{c}), false) AS {c}_outlier"
    for c in FEATURES)


@register("outlier_flags", with_views("features").rstrip() + ",\n" + _outlier_ctes() + f"""
SELECT l_orderkey, l_linenumber, {_FLAGS_SQL} FROM features""")
def q_outlier_flags(spark, d):
    f = _features(spark, d).select(*KEYS, *FEATURES)
    return stats.outlier_flags(f, FEATURES).drop(*FEATURES)


@register("outlier_row_filter", with_views("features").rstrip() + ",\n" + _outlier_ctes() + f""",
flags AS (SELECT l_orderkey, l_linenumber, {", ".join(FEATURES)}, {_FLAGS_SQL} FROM features)
SELECT l_orderkey, l_linenumber, {", ".join(FEATURES)} FROM flags
WHERE NOT ((""" + " + ".join(f"CAST({c}_outlier AS INTEGER)" for c in FEATURES)
          + f") / {len(FEATURES)} > 0.1)")
def q_outlier_row_filter(spark, d):
    f = _features(spark, d).select(*KEYS, *FEATURES)
    flagged = stats.outlier_flags(f, FEATURES)
    return stats.outlier_row_filter(flagged, [c + "_outlier" for c in FEATURES], 0.10)


_ISOLATED = with_views("features").rstrip() + ",\n" + isolation.oracle_sql("features", FEATURES, KEYS)


@register("isolation_flags", _ISOLATED + """
SELECT * FROM flags""")
def q_isolation_flags(spark, d):
    """A forest per feature: paths and flags of every row."""
    f = _features(spark, d).select(*KEYS, *FEATURES)
    return isolation.isolation_flags(f, FEATURES, KEYS, keep_paths=True).drop(*FEATURES)


@register("isolation_row_filter", _ISOLATED + """
SELECT l_orderkey, l_linenumber FROM flags WHERE NOT ((""" + " + ".join(f"CAST({c}_outlier AS INTEGER)" for c in FEATURES) + f") / {len(FEATURES)} > 0.1)")
def q_isolation_row_filter(spark, d):
    """Rows with at most a tenth of isolated features (P19 over M12)."""
    flagged = isolation.isolation_flags(_features(spark, d).select(*KEYS, *FEATURES), FEATURES, KEYS)
    return stats.outlier_row_filter(flagged, [c + "_outlier" for c in FEATURES], 0.10).select(*KEYS)


# ---------------------------------------------------------------- importance ranking
@register("importance_rank", with_views("importances") + """
SELECT feature, score, CAST(row_number() OVER (ORDER BY score DESC, feature) AS INTEGER) AS rank
FROM importances""")
def q_importance_rank(spark, d):
    return models.importance_rank(V.importances(spark, d))


@register("importance_cutoff", with_views("importances") + """
SELECT feature, score, rank, round(cum_score, 6) AS cum_score FROM (
  SELECT feature, score, rank,
         sum(score) OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_score,
         COALESCE(sum(score) OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
           AS before
  FROM (SELECT feature, score,
               CAST(row_number() OVER (ORDER BY score DESC, feature) AS INTEGER) AS rank
        FROM importances) r) t
WHERE before < 0.9""")
def q_importance_cutoff(spark, d):
    cut = models.importance_cutoff(models.importance_rank(V.importances(spark, d)), 0.9)
    return cut.withColumn("cum_score", F.round("cum_score", 6))


# ---------------------------------------------------------------- split, centres, linear fit
@register("hash_split", with_views("features") + """
SELECT l_orderkey, l_linenumber,
       CASE WHEN rn <= ceil(CAST(0.2 AS DOUBLE) * n) THEN 'test' ELSE 'train' END AS split
FROM (SELECT l_orderkey, l_linenumber,
             row_number() OVER (ORDER BY CAST('0x' || substr(md5(concat_ws('|',
                 CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), '42')), 1, 15) AS BIGINT))
               AS rn,
             count(*) OVER () AS n
      FROM features) t""")
def q_hash_split(spark, d):
    f = V.table(spark, d, "lineitem").select(*KEYS)     # a lineitem has one part: no join needed
    return models.hash_split(f, KEYS, 0.2, 42)


@register("nearest_centre", with_views("points") + """,
centres AS (SELECT label AS centre_id, i, avg(x) AS c FROM points GROUP BY label, i),
dists AS (SELECT p.vec_id, p.label, c.centre_id, sum((p.x - c.c) * (p.x - c.c)) AS d2
          FROM points p JOIN centres c ON p.i = c.i GROUP BY p.vec_id, p.label, c.centre_id)
SELECT vec_id, label, centre_id AS centre, round(d2, 6) AS dist2
FROM dists QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY round(d2, 9), centre_id) = 1""")
def q_nearest_centre(spark, d):
    p = V.points(spark, d)
    centres = p.groupBy(F.col("label").alias("centre_id")).agg(*[F.avg(c).alias(c) for c in V.POINT_COORDS])
    out = spatial.nearest_centre(p, centres, V.POINT_COORDS, "centre_id", "centre", "dist2")
    return out.select("vec_id", "label", "centre", F.round("dist2", 6).alias("dist2"))


@register("linear_regression", with_views("features") + """
SELECT round(regr_slope(label, quantity), 4) AS slope,
       round(regr_intercept(label, quantity), 4) AS intercept,
       count(*) AS n
FROM features""")
def q_linear_regression(spark, d):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    f = _features(spark, d).select("quantity", "label")
    vec = VectorAssembler(inputCols=["quantity"], outputCol="_x").transform(f)
    m = LinearRegression(featuresCol="_x", labelCol="label", solver="normal", regParam=0.0).fit(vec)
    return spark.createDataFrame(
        [(round(float(m.coefficients[0]), 4), round(float(m.intercept), 4), int(m.summary.numInstances))],
        "slope double, intercept double, n bigint")


# ---------------------------------------------------------------- more exact checks
@register("filter_counts", with_views("features").rstrip() + ",\n" + _outlier_ctes() + f""",
flags AS (SELECT {_FLAGS_SQL} FROM features)
SELECT count(*) AS rows_before,
       CAST(count_if(NOT ((""" + " + ".join(f"CAST({c}_outlier AS INTEGER)" for c in FEATURES)
          + f") / {len(FEATURES)} > 0.1)) AS BIGINT) AS rows_after FROM flags")
def q_filter_counts(spark, d):
    f = _features(spark, d).select(*KEYS, *FEATURES)
    flagged = stats.outlier_flags(f, FEATURES)
    return stats.filter_counts(flagged, [c + "_outlier" for c in FEATURES], 0.10)


@register("rounded_metrics", with_views("scores") + """
SELECT count(*) AS n,
       round(avg((y - round_even(prediction, 0)) * (y - round_even(prediction, 0))), 6) AS mse,
       round(1 - sum((y - round_even(prediction, 0)) * (y - round_even(prediction, 0)))
                 / (count(*) * var_pop(y)), 6) AS r2
FROM scores""")
def q_rounded_metrics(spark, d):
    return R6(stats.rounded_metrics(V.scores(spark, d), "y", "prediction"))


@register("quantile_interval_legacy", with_views("scores") + """
SELECT s.o_orderkey, s.prediction, b.lower, b.upper
FROM scores s CROSS JOIN (
  SELECT max(CASE WHEN rn = CAST(floor((1 - CAST(0.99 AS DOUBLE)) / 2 * n) AS BIGINT) + 1
                  THEN prediction END) AS lower,
         max(CASE WHEN rn = LEAST(CAST(floor((1 + CAST(0.99 AS DOUBLE)) / 2 * n) AS BIGINT), n - 1) + 1
                  THEN prediction END) AS upper
  FROM (SELECT prediction, row_number() OVER (ORDER BY prediction) AS rn, count(*) OVER () AS n
        FROM scores) r) b""")
def q_quantile_interval_legacy(spark, d):
    s = V.scores(spark, d).select("o_orderkey", "prediction")
    return stats.quantile_interval(s, "prediction", coverage=0.5, index_rule="legacy")


@register("minmax_params", with_views("features") + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max "
    f"FROM features" for c in FEATURES))
def q_minmax_params(spark, d):
    return stats.minmax_params(_features(spark, d), FEATURES)
