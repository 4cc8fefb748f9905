"""Sources and sinks: CSV with BOM, directory scans, partitioned writes, model bundles."""

import os

import pytest
from pyspark.sql import functions as F

from phenocast.sources import readers, schemas, writers
from phenocast.sources.model_store import load_model_bundle, save_model_bundle


def test_bom_header_and_declared_schema(spark, scratch):
    p = f"{scratch}/in.csv"
    with open(p, "w", encoding="utf-8-sig") as f:
        f.write("location,lat,long,alt,year,bloom_date,bloom_doy\n")
        f.write("liestal,47.48,7.73,350,2020,3/17/20,77\n")
        f.write("liestal,47.48,7.73,350,1894,1894-04-16,106\n")
    df = readers.read_bloom(spark, p)
    assert df.columns == [f.name for f in schemas.BLOOM.fields]
    got = sorted((r["year"], str(r["bloom_date"])) for r in df.collect())
    assert got == [(1894, "1894-04-16"), (2020, "2020-03-17")]


def test_status_sentinels(spark, scratch):
    p = f"{scratch}/obs.csv"
    with open(p, "w") as f:
        f.write("Species_ID,Site_ID,Latitude,Longitude,Elevation_in_Meters,Observation_Date,Day_of_Year,Phenophase_Status\n")
        f.write("228,32789,-9999,-74.0,-9999.0,2019-04-05,95,1\n")
    r = readers.read_status_obs(spark, p).first()
    assert r["Latitude"] is None and r["Elevation_in_Meters"] is None and r["Longitude"] == -74.0
    assert str(r["Observation_Date"]) == "2019-04-05"


def test_directory_scan_keeps_file_identity(spark, scratch):
    os.makedirs(f"{scratch}/v")
    for name, year in [("japan_1", 2001), ("korea_2", 2002)]:
        with open(f"{scratch}/v/{name}.csv", "w") as f:
            f.write("location,lat,long,alt,year,bloom_date,bloom_doy\n")
            f.write(f"X,1,2,3,{year},{year}-04-01,91\n")
    df = readers.read_bloom(spark, f"{scratch}/v", key="source_file")
    assert sorted((r["source_file"], r["year"]) for r in df.collect()) == [("japan_1", 2001), ("korea_2", 2002)]


def test_missing_path_raises(spark, scratch):
    with pytest.raises(Exception):
        readers.read_csv(spark, f"{scratch}/nope.csv", schemas.BLOOM).collect()


def test_partitioned_csv_round_trip_and_no_overwrite(spark, scratch):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "location string, v int")
    out = writers.run_output_path(f"{scratch}/out", "2024-02-19_22-21-14")
    writers.write_csv(df, out, partition_by=["location"])
    back = spark.read.option("header", True).schema("v int, location string").csv(out)
    assert sorted((r["location"], r["v"]) for r in back.collect()) == [("a", 1), ("a", 3), ("b", 2)]
    assert sorted(os.listdir(out))[:2] == ["._SUCCESS.crc", "_SUCCESS"] or "location=a" in os.listdir(out)
    with pytest.raises(Exception):
        writers.write_csv(df, out)


def test_run_id_format():
    import datetime as dt
    assert writers.run_id(dt.datetime(2024, 2, 19, 22, 21, 14)) == "2024-02-19_22-21-14"


def test_model_bundle_round_trip(spark, scratch):
    from phenocast.operators import models
    df = spark.range(200).select(F.col("id").cast("double").alias("a"),
                                 (F.col("id") % 7).cast("double").alias("b"),
                                 (F.col("id") * 2 + 1).cast("double").alias("label"))
    fitted = models.fit_regressor(df, ["a", "b"], "label", "gbt", settings={"maxIter": 5})
    path = save_model_bundle(fitted, f"{scratch}/model")
    with pytest.raises(Exception):
        save_model_bundle(fitted, f"{scratch}/model")        # never overwrites
    loaded = load_model_bundle(spark, path)
    assert loaded.features == ["a", "b"]
    p1 = sorted(r["prediction"] for r in fitted.transform(df).collect())
    p2 = sorted(r["prediction"] for r in loaded.transform(df).collect())
    assert p1 == p2


def test_representative_outputs_written_once(spark, scratch):
    from phenocast.operators.assemble import rename_positional
    clusters = spark.createDataFrame([(0, "a", 1.0, 2.0), (1, "b", 3.0, 4.0)],
                                     "c int, l string, x double, y double")
    clusters = rename_positional(clusters, ["cluster", "location", "lat", "long"])
    reps = clusters.withColumn("num_obs", F.lit(1).cast("long"))
    rows = clusters.select("cluster", "location")
    out = writers.write_representatives(clusters, reps, rows, f"{scratch}/rep")
    assert set(out) == {"clusters", "location", "validation"}
    assert sorted(os.listdir(out["validation"]))[-2:] == ["cluster=0", "cluster=1"]
