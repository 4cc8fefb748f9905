"""Declared schemas of the pipeline's tables (no inference on read)."""

from __future__ import annotations

from pyspark.sql import types as T

# The daily weather measures, in the order of the source files,
# followed by the derived day length; each becomes 12 monthly columns.
WEATHER_MEASURES = [
    "tempmax", "tempmin", "temp", "dew", "humidity", "precip", "precipprob",
    "precipcover", "snowdepth", "windgust", "windspeed", "windspeedmax",
    "windspeedmean", "windspeedmin", "sealevelpressure", "cloudcover",
    "solarradiation", "solarenergy", "uvindex",
]
FEATURE_MEASURES = WEATHER_MEASURES + ["day_length"]
MONTHS = list(range(1, 13))
WIDE_FEATURES = [f"{m}_{mo:02d}" for m in FEATURE_MEASURES for mo in MONTHS]

STATUS_OBS = T.StructType([
    T.StructField("Species_ID", T.IntegerType()),
    T.StructField("Site_ID", T.IntegerType()),
    T.StructField("Latitude", T.DoubleType()),
    T.StructField("Longitude", T.DoubleType()),
    T.StructField("Elevation_in_Meters", T.DoubleType()),
    T.StructField("Observation_Date", T.StringType()),
    T.StructField("Day_of_Year", T.IntegerType()),
    T.StructField("Phenophase_Status", T.IntegerType()),
])

BLOOM = T.StructType([
    T.StructField("location", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("long", T.DoubleType()),
    T.StructField("alt", T.DoubleType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("bloom_date", T.StringType()),
    T.StructField("bloom_doy", T.IntegerType()),
])

WEATHER_DAILY = T.StructType(
    [T.StructField("name", T.StringType()),
     T.StructField("datetime", T.StringType()),
     T.StructField("sunrise", T.StringType()),
     T.StructField("sunset", T.StringType())]
    + [T.StructField(m, T.DoubleType()) for m in WEATHER_MEASURES])

WEATHER_WIDE = T.StructType(
    [T.StructField("location", T.StringType()), T.StructField("year", T.IntegerType())]
    + [T.StructField(f, T.DoubleType()) for f in WIDE_FEATURES])

# new rows to score: like WEATHER_WIDE, the year column may be absent
SCORING_INPUT = T.StructType(
    [T.StructField("location", T.StringType())]
    + [T.StructField(f, T.DoubleType()) for f in WIDE_FEATURES])

TRAINING = T.StructType(
    [T.StructField("location", T.StringType()),
     T.StructField("year", T.IntegerType()),
     T.StructField("bloom_doy", T.IntegerType()),
     T.StructField("lat", T.DoubleType()),
     T.StructField("long", T.DoubleType()),
     T.StructField("bloom_date", T.DateType()),
     T.StructField("alt", T.DoubleType())]
    + [T.StructField(f, T.DoubleType()) for f in WIDE_FEATURES])

CLUSTERS = T.StructType([
    T.StructField("cluster", T.IntegerType()),
    T.StructField("location", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("long", T.DoubleType()),
])

REPRESENTATIVES = T.StructType(CLUSTERS.fields + [T.StructField("num_obs", T.LongType())])

PREDICTIONS = T.StructType([
    T.StructField("location", T.StringType()),
    T.StructField("prediction", T.IntegerType()),
    T.StructField("lower", T.IntegerType()),
    T.StructField("upper", T.IntegerType()),
])
