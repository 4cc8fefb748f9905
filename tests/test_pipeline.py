"""Raw-shape pipeline: status file -> bloom table; CLI steps on small files."""

import datetime as dt
import os

from phenocast.plans import pipeline
from phenocast.sources import readers


def _status_csv(path):
    with open(path, "w") as f:
        f.write("Species_ID,Site_ID,Latitude,Longitude,Elevation_in_Meters,Observation_Date,Day_of_Year,Phenophase_Status\n")
        f.write("228,32789,40.7,-74.0,10,2019-04-05,95,1\n")
        f.write("228,32789,40.7,-74.0,10,2019-04-01,91,0\n")
        f.write("228,32789,40.7,-74.0,10,2019-04-03,93,1\n")
        f.write("12,500,38.9,-77.0,-9999,2019-03-30,89,1\n")
        f.write("12,500,38.9,-77.0,-9999,2020-03-25,85,-1\n")


def test_bloom_from_status(spark, scratch):
    p = f"{scratch}/obs.csv"
    _status_csv(p)
    bloom = pipeline.bloom_from_status(readers.read_status_obs(spark, p))
    assert bloom.columns == ["location", "lat", "long", "alt", "year", "bloom_date", "bloom_doy"]
    got = sorted((r["location"], r["year"], r["bloom_doy"], r["bloom_date"], r["alt"]) for r in bloom.collect())
    assert got == [("32789", 2019, 93, dt.date(2019, 4, 3), 10.0), ("500", 2019, 89, dt.date(2019, 3, 30), None)]


def test_cli_bloom_split(spark, scratch):
    from phenocast.__main__ import main
    p = f"{scratch}/obs.csv"
    _status_csv(p)
    assert main(["bloom", p, f"{scratch}/bloom", "--site", "32789", "--species", "228"]) == 0
    sel = spark.read.option("header", True).csv(f"{scratch}/bloom/selected")
    rest = spark.read.option("header", True).csv(f"{scratch}/bloom/rest")
    assert [r["location"] for r in sel.collect()] == ["32789"]
    assert [r["location"] for r in rest.collect()] == ["500"]
    assert os.path.isdir(f"{scratch}/bloom/rest")


def test_cli_features_training_score(spark, scratch):
    from pyspark.sql import functions as F

    from phenocast.__main__ import main
    from phenocast.operators import models
    from phenocast.sources.model_store import save_model_bundle
    from phenocast.sources.schemas import WEATHER_MEASURES, WIDE_FEATURES

    os.makedirs(f"{scratch}/weather")
    os.makedirs(f"{scratch}/bloom")
    head = "name,datetime,sunrise,sunset," + ",".join(WEATHER_MEASURES)
    with open(f"{scratch}/weather/kyoto.csv", "w") as f:
        f.write(head + "\n")
        for m in range(1, 13):
            vals = ",".join([str(float(m))] * len(WEATHER_MEASURES))
            f.write(f"Kyoto,2019-{m:02d}-10,2019-{m:02d}-10T06:00:00,2019-{m:02d}-10T18:00:00,{vals}\n")
    with open(f"{scratch}/bloom/kyoto.csv", "w") as f:
        f.write("location,lat,long,alt,year,bloom_date,bloom_doy\n")
        f.write("kyoto,35.0,135.7,44,2020,4/1/20,92\n")
        f.write("kyoto,35.0,135.7,44,2021,2021-03-26,85\n")
    assert main(["features", f"{scratch}/weather", f"{scratch}/features"]) == 0
    assert main(["training", f"{scratch}/bloom", f"{scratch}/features", f"{scratch}/training"]) == 0
    t = spark.read.option("header", True).csv(f"{scratch}/training").collect()
    assert len(t) == 1 and t[0]["year"] == "2020" and t[0]["bloom_doy"] == "92"
    assert float(t[0]["day_length_03"]) == 43200.0

    train = spark.range(60).select(*[(F.col("id") % 7).cast("double").alias(c) for c in WIDE_FEATURES],
                                   (F.col("id") % 9 + 85).cast("double").alias("bloom_doy"))
    fitted = models.fit_regressor(train, WIDE_FEATURES, "bloom_doy", "rf", settings={"numTrees": 3})
    save_model_bundle(fitted, f"{scratch}/model")
    with open(f"{scratch}/input.csv", "w") as f:
        f.write(",".join(["location"] + WIDE_FEATURES) + "\n")
        f.write(",".join(["nyc"] + ["1.0"] * 240) + "\n")
        f.write(",".join(["kyoto"] + ["3.0"] * 240) + "\n")
    assert main(["score", f"{scratch}/model", f"{scratch}/input.csv", f"{scratch}/out"]) == 0
    (run,) = os.listdir(f"{scratch}/out")
    out = spark.read.option("header", True).csv(f"{scratch}/out/{run}").collect()
    assert sorted(r["location"] for r in out) == ["kyoto", "newyorkcity"]


def test_cli_representatives_by_file(spark, scratch):
    from phenocast.__main__ import main
    from tests.golden_data import USA_BLOOM_CSV
    os.makedirs(f"{scratch}/bloom")
    lines = USA_BLOOM_CSV.strip().splitlines()
    for name, chunk in [("usa_a", lines[1:60]), ("usa_b", lines[60:])]:
        with open(f"{scratch}/bloom/{name}.csv", "w") as f:
            f.write(lines[0] + "\n" + "\n".join(chunk) + "\n")
    assert main(["representatives", f"{scratch}/bloom", f"{scratch}/rep", "--by-file", "--restarts", "1"]) == 0
    assert sorted(os.listdir(f"{scratch}/rep/validation"))[-2:] == ["source_file=usa_a", "source_file=usa_b"]
    reps = spark.read.option("header", True).csv(f"{scratch}/rep/location")
    assert {r["source_file"] for r in reps.collect()} == {"usa_a", "usa_b"}
