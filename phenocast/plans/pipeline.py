"""End-to-end plans built from the operators.

``training_set`` is the flagship: first event per (location, year), the
previous year's monthly feature table, and the lag join between them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from phenocast.operators.assemble import lag_year_join
from phenocast.plans import standins as V


def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bloom rows beside the previous year's monthly means (W1 + A2/A3 + J1)."""
    return lag_year_join(V.bloom(spark, sf_dir), V.weather_wide(spark, sf_dir),
                         location="location", year="year", lag=1, date_col="bloom_date")


# ----------------------------------------------------------------------------
# The same pipeline over the raw table shapes (status observations, bloom
# files, daily weather files), used by the command line and the tests.
# ----------------------------------------------------------------------------
from pyspark.sql import functions as F  # noqa: E402

from phenocast.functions.dates import parse_mixed_date  # noqa: E402
from phenocast.operators import assemble, phenology, stats, weather  # noqa: E402
from phenocast.sources.schemas import FEATURE_MEASURES, WIDE_FEATURES  # noqa: E402

# Location aliases between training ids, input names and the
# names used in the submitted predictions.
LOCATION_ALIASES = [("32789", "newyorkcity"), ("nyc", "newyorkcity")]


def bloom_from_status(status: DataFrame) -> DataFrame:
    """Status observations -> bloom table: first 'yes' per (species, site, year) (step 0)."""
    first = phenology.first_bloom(
        status, species="Species_ID", site="Site_ID", date="Observation_Date",
        doy="Day_of_Year", status_col="Phenophase_Status",
        tie_break=["Latitude", "Longitude", "Elevation_in_Meters"])
    return first.select("location", F.col("Latitude").alias("lat"),
                        F.col("Longitude").alias("long"),
                        F.col("Elevation_in_Meters").alias("alt"), "year",
                        F.col("Observation_Date").alias("bloom_date"),
                        F.col("Day_of_Year").alias("bloom_doy"))


def weather_feature_table(daily: DataFrame, key: str = "source_file",
                          measures=FEATURE_MEASURES) -> DataFrame:
    """Daily weather rows (text dates) -> one row per (file, year) with monthly means (step 2).

    The location of a weather row is its file's identity, which is how the
    files are paired with the bloom files; the file's own name column is not
    used for pairing.
    """
    d = weather.add_day_length(daily, "sunrise", "sunset", "day_length", parse=True)
    d = d.withColumn("datetime", parse_mixed_date("datetime"))
    wide = weather.monthly_pivot(d, [key], "datetime", list(measures))
    return wide.withColumnRenamed(key, "location")


def training_from_tables(bloom: DataFrame, weather_wide: DataFrame, fill: bool = True) -> DataFrame:
    """Bloom rows beside previous-year weather, gaps filled with column means (step 3)."""
    t = lag_year_join(bloom, weather_wide, "location", "year", 1, "bloom_date",
                      event_cols=assemble.BLOOM_COLUMNS)
    if not fill:
        return t
    feats = [c for c in t.columns if c not in assemble.BLOOM_COLUMNS]
    return assemble.fill_with_means(t, feats)


def aliases_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LOCATION_ALIASES, "key string, alias string")


def predictions_table(fitted, new_rows: DataFrame, location: str = "location",
                      alias: bool = True, scored: DataFrame | None = None) -> DataFrame:
    """Score new feature rows: rounded prediction with its interval (step 5).

    Rows keep their own location (no positional re-attachment).  The
    interval needs a global spread over the predictions and then the rows
    again, so pass ``scored`` (the persisted or checkpointed output of
    ``fitted.transform(new_rows, "_raw")``) to avoid scoring twice.
    """
    pred = scored if scored is not None else fitted.transform(new_rows, "_raw")
    out = stats.final_predictions(pred, "_raw", "prediction", tail_alpha=0.75)
    out = out.select(location, "prediction", "lower", "upper")
    if alias:
        out = assemble.alias_locations(out, aliases_table(new_rows.sparkSession), location)
    return out


__all__ = ["training_set", "bloom_from_status", "weather_feature_table", "training_from_tables",
           "predictions_table", "LOCATION_ALIASES", "WIDE_FEATURES"]
