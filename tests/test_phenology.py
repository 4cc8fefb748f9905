"""First event per group, filters, dates."""

import datetime as dt

from pyspark.sql import functions as F

from phenocast.functions.dates import parse_mixed_date
from phenocast.operators import phenology

SCHEMA = ("Species_ID int, Site_ID int, Observation_Date date, Day_of_Year int, "
          "Phenophase_Status int, Latitude double")


def status(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def first(df):
    return phenology.first_bloom(df, tie_break=["Latitude"])


def test_first_yes_tie_uses_total_order(spark):
    d = dt.date(2020, 3, 30)
    df = status(spark, [(1, 5, d, 90, 1, 2.0), (1, 5, d, 90, 1, 1.0), (1, 5, dt.date(2020, 4, 2), 93, 1, 0.5)])
    out = first(df).collect()
    assert len(out) == 1
    assert out[0]["Day_of_Year"] == 90 and out[0]["Latitude"] == 1.0


def test_only_no_and_unsure_gives_no_row(spark):
    df = status(spark, [(1, 5, dt.date(2020, 3, 1), 61, 0, 1.0), (1, 5, dt.date(2020, 3, 2), 62, -1, 1.0)])
    assert first(df).count() == 0


def test_two_species_one_site_keeps_both(spark):
    df = status(spark, [(1, 5, dt.date(2020, 3, 1), 61, 1, 1.0), (2, 5, dt.date(2020, 3, 5), 65, 1, 1.0)])
    out = first(df).collect()
    assert sorted(r["Species_ID"] for r in out) == [1, 2]
    assert {r["location"] for r in out} == {"5"}


def test_first_per_year(spark):
    df = status(spark, [(1, 5, dt.date(2020, 3, 9), 69, 1, 1.0), (1, 5, dt.date(2020, 3, 1), 61, 1, 1.0),
                        (1, 5, dt.date(2021, 4, 1), 91, 1, 1.0), (1, 5, dt.date(2021, 3, 1), 60, 0, 1.0)])
    out = {r["year"]: r["Day_of_Year"] for r in first(df).collect()}
    assert out == {2020: 61, 2021: 91}


def test_complement_keeps_null_keys(spark):
    df = spark.createDataFrame([(1, 228), (None, 228), (2, 5), (1, None)], "Site_ID int, Species_ID int")
    keys = {"Site_ID": 1, "Species_ID": 228}
    hit, rest = phenology.split_by_keys(df, keys)
    assert hit.count() == 1
    assert rest.count() == 3          # the NULL-keyed rows go to the rest
    assert hit.count() + rest.count() == df.count()


def test_dedupe_points_keeps_first_by_order(spark):
    df = spark.createDataFrame([(1.0, 2.0, "b", 2), (1.0, 2.0, "a", 1), (3.0, 4.0, "c", 5)],
                               "lat double, long double, location string, year int")
    out = phenology.dedupe_points(df, ["lat", "long"], ["year", "location"])
    assert sorted((r["location"], r["year"]) for r in out.collect()) == [("a", 1), ("c", 5)]


def test_mixed_dates_with_year_column(spark):
    df = spark.createDataFrame([("2/10/92", 1992), ("4/15/51", 1951), ("1894-04-16", 1894),
                                ("3/17/20", 2020), ("junk", 2000), (None, 2000)],
                               "t string, year int")
    out = [r["d"] for r in df.select(parse_mixed_date("t", "year").alias("d")).collect()]
    assert out == [dt.date(1992, 2, 10), dt.date(1951, 4, 15), dt.date(1894, 4, 16),
                   dt.date(2020, 3, 17), None, None]


def test_mixed_dates_pivot_without_year(spark):
    df = spark.createDataFrame([("2/10/92",), ("3/17/20",)], "t string")
    out = [r["d"] for r in df.select(parse_mixed_date("t").alias("d")).collect()]
    assert out == [dt.date(1992, 2, 10), dt.date(2020, 3, 17)]


def test_day_of_year_check(spark):
    df = spark.createDataFrame([(dt.date(2020, 3, 1), 61), (dt.date(2021, 3, 1), 61)], "d date, doy int")
    out = [r["doy_matches"] for r in phenology.day_of_year_check(df, "d", "doy").orderBy("d").collect()]
    assert out == [True, False]      # 2020 is a leap year


def test_hot_key_first_event_is_exact(spark):
    # one group holds a third of all rows, spread over every input partition
    df = spark.range(0, 30000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise((F.col("id") % 1000).cast("int")).alias("Species_ID"),
        F.lit(7).alias("Site_ID"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") * 7919 % 300).cast("int")).alias("Observation_Date"),
        F.lit(0).alias("Day_of_Year"),
        F.lit(1).alias("Phenophase_Status"),
        (F.col("id") * 1.0).alias("Latitude"))
    df = df.withColumn("Day_of_Year", F.dayofyear("Observation_Date"))
    got = {r["Species_ID"]: (r["Day_of_Year"], r["Latitude"]) for r in first(df).collect()}
    rows = df.collect()
    want = {}
    for r in rows:
        key = (r["Day_of_Year"], r["Observation_Date"], r["Latitude"])
        if r["Species_ID"] not in want or key < want[r["Species_ID"]]:
            want[r["Species_ID"]] = key
    assert got == {k: (v[0], v[2]) for k, v in want.items()}
