"""Monthly/yearly features, day length, lag join."""

import datetime as dt

from phenocast.operators import assemble, weather
from phenocast.plans.pipeline import training_from_tables, weather_feature_table
from phenocast.sources.schemas import FEATURE_MEASURES, WIDE_FEATURES, WEATHER_MEASURES
from tests.golden_data import SCORING_INPUT_HEADER


def daily(spark, data):
    return spark.createDataFrame(data, "loc string, d date, t double, h double")


def test_pivot_names_order_and_missing_month(spark):
    df = daily(spark, [("a", dt.date(2000, 1, 5), 1.0, 10.0), ("a", dt.date(2000, 1, 6), 3.0, None),
                       ("a", dt.date(2000, 3, 1), 5.0, 20.0)])
    wide = weather.monthly_pivot(df, ["loc"], "d", ["t", "h"])
    assert wide.columns[:4] == ["loc", "year", "t_01", "t_02"]
    assert wide.columns[-1] == "h_12"
    r = wide.first()
    assert r["t_01"] == 2.0 and r["h_01"] == 10.0      # NULL skipped by the mean
    assert r["t_02"] is None and r["t_03"] == 5.0      # missing month -> NULL, not 0


def test_single_measure_pivot_names(spark):
    df = daily(spark, [("a", dt.date(2000, 1, 5), 1.0, 10.0)])
    wide = weather.monthly_pivot(df, ["loc"], "d", ["t"])
    assert wide.columns == ["loc", "year"] + [f"t_{m:02d}" for m in range(1, 13)]


def test_yearly_extras_align_outer(spark):
    df = daily(spark, [("a", dt.date(2000, 1, 5), 1.0, 10.0), ("a", dt.date(2001, 2, 5), 3.0, 30.0)])
    out = weather.weather_features(df, "loc", "d", ["t"], yearly_extra=["h"])
    got = {r["year"]: (r["h"], r["t_01"], r["t_02"]) for r in out.collect()}
    assert got == {2000: (10.0, 1.0, None), 2001: (30.0, None, 3.0)}


def test_day_length_text_timestamps(spark):
    df = spark.createDataFrame([("2024-03-01T06:30:00", "2024-03-01T18:00:30")], "sunrise string, sunset string")
    assert weather.add_day_length(df).first()["day_length"] == 41430.0


def test_feature_header_matches_scoring_input():
    header = SCORING_INPUT_HEADER.split(",")
    assert header[0] == "location"
    assert header[1:] == WIDE_FEATURES and len(WIDE_FEATURES) == 240
    assert FEATURE_MEASURES[-1] == "day_length" and len(WEATHER_MEASURES) == 19


def test_lag_join_previous_year_only(spark):
    bloom = spark.createDataFrame(
        [("x", 2001, 90, 1.0, 2.0, dt.date(2001, 3, 31), 5.0),
         ("x", 2000, 88, 1.0, 2.0, dt.date(2000, 3, 28), 5.0)],
        "location string, year int, bloom_doy int, lat double, long double, bloom_date date, alt double")
    wide = spark.createDataFrame([("x", 2000, 7.0), ("x", 2001, 9.0)], "location string, year int, f_01 double")
    out = assemble.lag_year_join(bloom, wide).collect()
    got = {(r["year"], r["f_01"]) for r in out}
    assert got == {(2001, 7.0), (2000, None)} - {(2000, None)}   # 2000 has no 1999 weather


def test_fill_int_column_with_fractional_mean(spark):
    df = spark.createDataFrame([(1,), (None,), (4,)], "x int")
    out = [r["x"] for r in assemble.fill_with_means(df, ["x"]).collect()]
    assert out == [1.0, 2.5, 4.0]


def test_weather_files_to_training_table(spark, scratch):
    import os
    os.makedirs(f"{scratch}/weather")
    head = "name,datetime,sunrise,sunset," + ",".join(WEATHER_MEASURES)
    vals = ",".join(["1.0"] * len(WEATHER_MEASURES))
    with open(f"{scratch}/weather/liestal.csv", "w") as f:
        f.write(head + "\n")
        f.write(f"Liestal,2019-01-15,2019-01-15T08:00:00,2019-01-15T17:00:00,{vals}\n")
        f.write(f"Liestal,2019-02-15,2019-02-15T07:30:00,2019-02-15T17:45:00,{vals}\n")
    from phenocast.sources.readers import read_weather_daily
    wide = weather_feature_table(read_weather_daily(spark, f"{scratch}/weather"))
    assert wide.columns == ["location", "year"] + WIDE_FEATURES
    r = wide.first()
    assert r["location"] == "liestal" and r["day_length_01"] == 32400.0 and r["tempmax_03"] is None
    bloom = spark.createDataFrame([("liestal", 2020, 77, 47.48, 7.73, dt.date(2020, 3, 17), 350.0)],
                                  "location string, year int, bloom_doy int, lat double, long double, "
                                  "bloom_date date, alt double")
    t = training_from_tables(bloom, wide).first()
    assert t["year"] == 2020 and t["tempmax_01"] == 1.0
    assert t["tempmax_03"] is None     # the column has no value anywhere: its mean is NULL too


def test_yearly_monthly_align_is_outer(spark):
    y = spark.createDataFrame([("a", 2000, 1.0), ("a", 2001, 2.0)], "loc string, year int, h double")
    m = spark.createDataFrame([("a", 2001, 5.0), ("a", 2002, 6.0)], "loc string, year int, t_01 double")
    out = {r["year"]: (r["h"], r["t_01"]) for r in weather.yearly_monthly_align(y, m, ["loc", "year"]).collect()}
    assert out == {2000: (1.0, None), 2001: (2.0, 5.0), 2002: (None, 6.0)}
