"""Exact relational queries (sections 2.1-2.8 of the operator inventory)."""

from __future__ import annotations

from pyspark.sql import functions as F

from phenocast.functions.dates import calendar_parts, parse_mixed_date
from phenocast.functions.numeric import half_even_int, hash64, round_doubles, sentinel_to_null
from phenocast.operators import assemble, phenology, spatial, weather
from phenocast.plans import standins as V
from phenocast.plans.registry import register
from phenocast.plans.standins import MEASURES, with_views

R6 = round_doubles

_FIRST_BLOOM_SQL = """SELECT species_id, site_id, year, day_of_year, obs_date, obs_id, location FROM (
  SELECT *, CAST(year(obs_date) AS INTEGER) AS year, CAST(site_id AS VARCHAR) AS location,
         row_number() OVER (PARTITION BY species_id, site_id, year(obs_date)
                            ORDER BY day_of_year, obs_date, obs_id) AS rn
  FROM {src} WHERE status = 1) t WHERE rn = 1"""


def _first_bloom(df):
    out = phenology.first_bloom(df, species="species_id", site="site_id", date="obs_date",
                                doy="day_of_year", status_col="status", tie_break=["obs_id"])
    return out.select("species_id", "site_id", "year", "day_of_year", "obs_date", "obs_id", "location")


# ---------------------------------------------------------------- scans / predicates
@register("sentinel_to_null", with_views("sentinels") + """
SELECT l_orderkey, l_linenumber, quantity, nullif(discount_pct, 0) AS discount_pct,
       nullif(tax_pct, 0) AS tax_pct
FROM sentinels""")
def q_sentinel_to_null(spark, d):
    return sentinel_to_null(V.sentinels(spark, d), ["discount_pct", "tax_pct"], value=0)


_P1 = "species_id = (SELECT p_species FROM split_pair) AND site_id = (SELECT p_site FROM split_pair)"
_NOT_P1 = ("NOT (species_id IS NOT DISTINCT FROM (SELECT p_species FROM split_pair) "
           "AND site_id IS NOT DISTINCT FROM (SELECT p_site FROM split_pair))")


@register("site_species_filter", with_views("status_obs", "split_pair") + f"""
SELECT * FROM status_obs WHERE {_P1}""")
def q_site_species_filter(spark, d):
    return phenology.site_species_filter(V.status_obs(spark, d), V.split_pair(spark, d))


@register("site_species_complement", with_views("status_obs", "split_pair") + f"""
SELECT * FROM status_obs WHERE {_NOT_P1}""")
def q_site_species_complement(spark, d):
    return phenology.site_species_complement(V.status_obs(spark, d), V.split_pair(spark, d))


@register("constant_location", with_views("weather_daily") + """
SELECT n.n_name AS location, CAST(year(w.datetime) AS INTEGER) AS year,
       CAST(sum(w.quantity) AS DOUBLE) / CAST(count(w.quantity) AS DOUBLE) AS quantity,
       CAST(sum(w.tax_pct) AS DOUBLE) / CAST(count(w.tax_pct) AS DOUBLE) AS tax_pct
FROM weather_daily w JOIN nation n ON CAST(n.n_nationkey AS VARCHAR) = w.location
GROUP BY n.n_name, year(w.datetime)""")
def q_constant_location(spark, d):
    n = V.table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("file"),
                                           F.col("n_name").alias("name"))
    daily = V.weather_daily(spark, d).withColumnRenamed("location", "file").join(n, "file")
    return weather.yearly_means_named(daily, "file", "name", "datetime", ["quantity", "tax_pct"],
                                      order=["datetime", "quantity"])


@register("mixed_date_parse", with_views("mixed_dates") + """
SELECT o_orderkey, date_text, year,
       COALESCE(try_strptime(date_text, '%Y-%m-%d'),
                try_strptime(regexp_replace(date_text, '/[0-9]{2}$', '/' || CAST(year AS VARCHAR)), '%m/%d/%Y')
       )::DATE AS parsed_date
FROM mixed_dates""")
def q_mixed_date_parse(spark, d):
    m = V.mixed_dates(spark, d)
    return m.withColumn("parsed_date", parse_mixed_date("date_text", "year"))


@register("day_length_seconds", with_views("sun") + """
SELECT l_orderkey, l_linenumber,
       CAST(date_diff('second', strptime(sunrise, '%Y-%m-%dT%H:%M:%S'),
                                strptime(sunset, '%Y-%m-%dT%H:%M:%S')) AS DOUBLE) AS day_length
FROM sun""")
def q_day_length_seconds(spark, d):
    return weather.add_day_length(V.sun(spark, d)).select("l_orderkey", "l_linenumber", "day_length")


@register("calendar_parts", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
FROM orders""")
def q_calendar_parts(spark, d):
    o = V.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return calendar_parts(o, "o_orderdate").drop("o_orderdate")


@register("bloom_doy_check", with_views("bloom") + """
SELECT location, year, bloom_doy, CAST(dayofyear(bloom_date) AS INTEGER) AS date_doy,
       bloom_doy = CAST(dayofyear(bloom_date) AS INTEGER) AS doy_matches
FROM bloom""")
def q_bloom_doy_check(spark, d):
    b = V.bloom(spark, d).select("location", "year", "bloom_doy", "bloom_date")
    return phenology.day_of_year_check(b, "bloom_date", "bloom_doy").drop("bloom_date")


@register("round_half_even", """
SELECT l_orderkey, l_linenumber, l_quantity / 2 AS half_qty,
       CAST(round_even(l_quantity / 2, 0) AS INTEGER) AS rounded
FROM lineitem""")
def q_round_half_even(spark, d):
    l = V.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber",
                                              (F.col("l_quantity") / 2).alias("half_qty"))
    return l.withColumn("rounded", half_even_int("half_qty"))


@register("location_alias", with_views("training") + """
SELECT COALESCE(n.n_name, t.location) AS location, t.year, t.bloom_doy
FROM training t LEFT JOIN nation n ON CAST(n.n_nationkey AS VARCHAR) = t.location""")
def q_location_alias(spark, d):
    from phenocast.plans.pipeline import training_set
    aliases = V.table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("key"),
                                                 F.col("n_name").alias("alias"))
    t = training_set(spark, d).select("location", "year", "bloom_doy")
    return assemble.alias_locations(t, aliases, "location").select("location", "year", "bloom_doy")


# ---------------------------------------------------------------- joins
@register("lag_year_join", with_views("training") + "SELECT * FROM training")
def q_lag_year_join(spark, d):
    from phenocast.plans.pipeline import training_set
    return training_set(spark, d)


@register("representative_counts", with_views("sites") + """
SELECT r.cluster, r.location, r.lat, r.long, c.num_obs FROM (
  SELECT cluster, CAST(max(CAST(location AS BIGINT)) AS VARCHAR) AS location,
         round(max(lat), 6) AS lat, round(max(long), 6) AS long
  FROM sites GROUP BY cluster) r
LEFT JOIN (SELECT CAST(o_custkey AS VARCHAR) AS location, count(*) AS num_obs
           FROM orders GROUP BY o_custkey) c ON r.location = c.location""")
def q_representative_counts(spark, d):
    s = V.sites(spark, d)
    reps = spatial.cluster_columnwise_max(s, "cluster", ["location", "lat", "long"])
    counts = spatial.obs_per_location(V.observations(spark, d), "location")
    return R6(spatial.representative_counts(reps, counts, "location")
              .select("cluster", "location", "lat", "long", "num_obs"))


@register("representative_rows", with_views("sites", "observations") + """
SELECT r.cluster, o.location, o.obs_id, o.obs_date, o.status
FROM observations o JOIN (
  SELECT cluster, CAST(max(CAST(location AS BIGINT)) AS VARCHAR) AS location
  FROM sites GROUP BY cluster) r ON o.location = r.location""")
def q_representative_rows(spark, d):
    reps = spatial.cluster_columnwise_max(V.sites(spark, d), "cluster", ["location"])
    rows = spatial.representative_rows(V.observations(spark, d), reps, "location", "cluster")
    return rows.select("cluster", "location", "obs_id", "obs_date", "status")


@register("yearly_monthly_align", with_views("weather_daily") + f"""
SELECT COALESCE(y.location, m.location) AS location, COALESCE(y.year, m.year) AS year,
       y.discount_pct, y.tax_pct, m.* EXCLUDE (location, year)
FROM (SELECT location, CAST(year(datetime) AS INTEGER) AS year,
             CAST(sum(discount_pct) AS DOUBLE) / CAST(count(discount_pct) AS DOUBLE) AS discount_pct,
             CAST(sum(tax_pct) AS DOUBLE) / CAST(count(tax_pct) AS DOUBLE) AS tax_pct
      FROM weather_daily GROUP BY location, year(datetime)) y
FULL OUTER JOIN ({V._pivot_sql("weather_daily", ["quantity", "price_cents"])}) m
ON y.location = m.location AND y.year = m.year""")
def q_yearly_monthly_align(spark, d):
    w = V.weather_daily(spark, d)
    return weather.weather_features(w, "location", "datetime", ["quantity", "price_cents"],
                                    yearly_extra=["discount_pct", "tax_pct"])


# ---------------------------------------------------------------- aggregations
@register("yearly_means", with_views("weather_daily") + "SELECT location, CAST(year(datetime) AS INTEGER) AS year, "
          + ", ".join(f"{V.mean_sql(m)} AS {m}" for m in MEASURES)
          + " FROM weather_daily GROUP BY location, year(datetime)")
def q_yearly_means(spark, d):
    return (weather.yearly_means(V.weather_daily(spark, d), ["location"], "datetime", MEASURES))


@register("monthly_means", with_views("weather_daily") + "SELECT location, CAST(year(datetime) AS INTEGER) AS year, "
          "CAST(month(datetime) AS INTEGER) AS month, "
          + ", ".join(f"{V.mean_sql(m)} AS {m}" for m in MEASURES)
          + " FROM weather_daily GROUP BY location, year(datetime), month(datetime)")
def q_monthly_means(spark, d):
    return (weather.monthly_means(V.weather_daily(spark, d), ["location"], "datetime", MEASURES))


@register("monthly_pivot", with_views("weather_wide") + "SELECT * FROM weather_wide")
def q_monthly_pivot(spark, d):
    return V.weather_wide(spark, d)


@register("obs_per_location", """
SELECT CAST(o_custkey AS VARCHAR) AS location, count(*) AS num_obs
FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey""")
def q_obs_per_location(spark, d):
    return spatial.obs_per_location(V.observations(spark, d), "location")


@register("cluster_columnwise_max", with_views("sites") + """
SELECT cluster, CAST(max(CAST(location AS BIGINT)) AS VARCHAR) AS location,
       round(max(lat), 6) AS lat, round(max(long), 6) AS long
FROM sites GROUP BY cluster""")
def q_cluster_columnwise_max(spark, d):
    return R6(spatial.cluster_columnwise_max(V.sites(spark, d), "cluster", ["location", "lat", "long"]))


@register("cluster_most_observed", with_views("sites") + """
SELECT cluster, location, lat, long, num_obs FROM (
  SELECT s.cluster, s.location, round(s.lat, 6) AS lat, round(s.long, 6) AS long, c.num_obs,
         row_number() OVER (PARTITION BY s.cluster
                            ORDER BY COALESCE(c.num_obs, 0) DESC, CAST(s.location AS BIGINT) DESC) AS rn
  FROM sites s LEFT JOIN (SELECT CAST(o_custkey AS VARCHAR) AS location, count(*) AS num_obs
                          FROM orders GROUP BY o_custkey) c ON s.location = c.location) t
WHERE rn = 1""")
def q_cluster_most_observed(spark, d):
    counts = spatial.obs_per_location(V.observations(spark, d), "location")
    out = spatial.cluster_most_observed(V.sites(spark, d), counts, "cluster", "location", ["lat", "long"])
    return R6(out.select("cluster", "location", "lat", "long", "num_obs"))


@register("value_counts", with_views("status_obs") + f"""
SELECT location, count(*) AS n FROM ({_FIRST_BLOOM_SQL.format(src="status_obs")}) f
GROUP BY location""")
def q_value_counts(spark, d):
    return assemble.value_counts(_first_bloom(V.status_obs(spark, d)), "location", "n")


@register("training_summary", with_views("training") + """
SELECT count(*) AS n_rows, count(DISTINCT location) AS n_locations FROM training""")
def q_training_summary(spark, d):
    from phenocast.plans.pipeline import training_set
    return assemble.training_summary(training_set(spark, d), "location")


@register("location_points", with_views("training") + """
SELECT lat, long, count(*) AS n_rows FROM training GROUP BY lat, long""")
def q_location_points(spark, d):
    from phenocast.plans.pipeline import training_set
    return assemble.location_points(training_set(spark, d), "lat", "long")


# ---------------------------------------------------------------- windows
@register("first_bloom", with_views("status_obs") + _FIRST_BLOOM_SQL.format(src="status_obs"))
def q_first_bloom(spark, d):
    return _first_bloom(V.status_obs(spark, d))


@register("dedupe_points", with_views("status_obs") + """
SELECT lat, long, location, obs_date, obs_id FROM (
  SELECT c.c_acctbal / 100 AS lat, CAST(c.c_custkey % 360 - 180 AS DOUBLE) AS long,
         CAST(s.site_id AS VARCHAR) AS location, s.obs_date, s.obs_id,
         row_number() OVER (PARTITION BY c.c_acctbal / 100, CAST(c.c_custkey % 360 - 180 AS DOUBLE)
                            ORDER BY s.obs_date, s.obs_id) AS rn
  FROM status_obs s JOIN customer c ON s.site_id = c.c_custkey WHERE s.status = 1) t
WHERE rn = 1""")
def q_dedupe_points(spark, d):
    c = V.table(spark, d, "customer")
    obs = V.status_obs(spark, d).where(F.col("status") == 1)
    # a site has one point: keep its first observation before the join (exact,
    # the same order decides both steps) so the join moves one row per site
    per_site = phenology.first_per_group(obs, ["site_id"], ["obs_date", "obs_id"], carry=[])
    yes = per_site.join(c, F.col("site_id") == c.c_custkey).select(
        (F.col("c_acctbal") / 100).alias("lat"),
        (F.col("c_custkey") % 360 - 180).cast("double").alias("long"),
        F.col("site_id").cast("string").alias("location"), "obs_date", "obs_id")
    return phenology.dedupe_points(yes, ["lat", "long"], ["obs_date", "obs_id"]) \
        .select("lat", "long", "location", "obs_date", "obs_id")


# ---------------------------------------------------------------- sorts, limits, sets
@register("head_rows", with_views("status_obs") + f"""
SELECT * FROM ({_FIRST_BLOOM_SQL.format(src="status_obs")}) f ORDER BY obs_id LIMIT 10""")
def q_head_rows(spark, d):
    return _first_bloom(V.status_obs(spark, d)).orderBy("obs_id").limit(10)


@register("hash_sample", with_views("sites") + """
SELECT location, cluster, lat, long FROM sites
ORDER BY CAST('0x' || substr(md5(concat_ws('|', location, '42')), 1, 15) AS BIGINT), location
LIMIT 20""")
def q_hash_sample(spark, d):
    s = V.sites(spark, d)
    return (s.withColumn("_h", hash64(["location"], 42)).orderBy("_h", "location")
             .limit(20).drop("_h"))


@register("union_locations", with_views("status_obs", "split_pair") + f"""
SELECT species_id, site_id, year, day_of_year, obs_date, obs_id, 'split' AS location
FROM ({_FIRST_BLOOM_SQL.format(src="status_obs")}) a WHERE {_P1}
UNION ALL
SELECT * FROM ({_FIRST_BLOOM_SQL.format(src="status_obs")}) b WHERE {_NOT_P1}""")
def q_union_locations(spark, d):
    obs = V.status_obs(spark, d)
    keys = V.split_pair(spark, d)
    # site and species are grouping keys of the first bloom, so the two sides of the union
    # are told apart after one pass (assemble.union_locations unions separate tables)
    match = F.lit(True)
    for k, v in keys.items():
        match = match & F.col(k).eqNullSafe(F.lit(v))
    return _first_bloom(obs).withColumn("location", F.when(match, "split").otherwise(F.col("location")))


@register("distinct_pairs", with_views("status_obs") + """
SELECT DISTINCT species_id, site_id FROM status_obs""")
def q_distinct_pairs(spark, d):
    return phenology.distinct_pairs(V.status_obs(spark, d), ["species_id", "site_id"])


@register("bloom_year_check", with_views("bloom") + """
SELECT count(*) AS n_rows,
       CAST(count_if(bloom_date IS NOT NULL AND CAST(year(bloom_date) AS INTEGER) <> year) AS BIGINT)
         AS n_mismatch,
       CAST(count_if(bloom_date IS NULL) AS BIGINT) AS n_missing_date
FROM bloom""")
def q_bloom_year_check(spark, d):
    return assemble.year_consistency(V.bloom(spark, d), "year", "bloom_date")
