"""Representative locations on the published USA data (G1-G4; A4-A6, J2, J3, M2, M3, W2)."""

import io

import pandas as pd
from pyspark.sql import functions as F

from phenocast.operators import spatial
from phenocast.operators.phenology import dedupe_points
from tests.golden_data import USA_BLOOM_CSV, USA_CLUSTERS_CSV, USA_REPRESENTATIVES_CSV


def frame(spark, text, schema):
    pdf = pd.read_csv(io.StringIO(text), dtype=str)
    return spark.createDataFrame(pdf).selectExpr(*[f"CAST({c} AS {t}) AS {c}" for c, t in schema])


BLOOM = [("location", "string"), ("lat", "double"), ("long", "double"), ("alt", "double"),
         ("year", "int"), ("bloom_date", "string"), ("bloom_doy", "int")]
CLUSTERS = [("cluster", "int"), ("location", "string"), ("lat", "double"), ("long", "double")]
REPS = CLUSTERS + [("num_obs", "bigint")]


def test_g1_columnwise_max_matches_published(spark):
    clusters = frame(spark, USA_CLUSTERS_CSV, CLUSTERS)
    got = spatial.cluster_columnwise_max(clusters, "cluster", ["location", "lat", "long"])
    want = frame(spark, USA_REPRESENTATIVES_CSV, REPS).drop("num_obs")
    assert sorted(got.collect()) == sorted(want.select(*got.columns).collect())


def test_g2_counts_and_points(spark):
    bloom = frame(spark, USA_BLOOM_CSV, BLOOM)
    assert bloom.count() == 150
    counts = spatial.obs_per_location(bloom)
    assert counts.count() == 95
    points = dedupe_points(bloom, ["lat", "long"], ["year", "location"])
    assert points.count() == 92
    reps = frame(spark, USA_REPRESENTATIVES_CSV, REPS).drop("num_obs")
    joined = spatial.representative_counts(reps, counts).orderBy("cluster")
    assert [r["num_obs"] for r in joined.collect()] == [1, 1, 1, 1, 1]


def test_g3_most_observed(spark):
    bloom = frame(spark, USA_BLOOM_CSV, BLOOM)
    clusters = frame(spark, USA_CLUSTERS_CSV, CLUSTERS)
    counts = spatial.obs_per_location(bloom)
    best = spatial.cluster_most_observed(clusters, counts, "cluster", "location", ["lat", "long"])
    got = {r["cluster"]: (r["location"], r["num_obs"]) for r in best.collect()}
    assert got == {0: ("29890", 4), 1: ("8901", 6), 2: ("43756", 1), 3: ("8861", 7), 4: ("18536", 8)}


def test_g4_rows_of_representatives(spark):
    bloom = frame(spark, USA_BLOOM_CSV, BLOOM)
    reps = frame(spark, USA_REPRESENTATIVES_CSV, REPS)
    rows = spatial.representative_rows(bloom, reps, "location", "cluster")
    assert sorted(r["cluster"] for r in rows.collect()) == [0, 1, 2, 3, 4]


def test_kmeans_end_to_end_shapes(spark):
    bloom = frame(spark, USA_BLOOM_CSV, BLOOM)
    clusters, reps, rows = spatial.representative_locations(bloom, restarts=2)
    assert clusters.count() == 92
    assert clusters.select("cluster").distinct().count() == 5
    assert reps.count() == 5 and set(reps.columns) == {"cluster", "location", "lat", "long", "num_obs"}
    assert rows.count() >= 5


def test_nearest_centre_brute_force(spark):
    pts = spark.createDataFrame([(i, float(i % 7), float(i % 5)) for i in range(60)], "id int, x double, y double")
    cents = spark.createDataFrame([(0, 0.0, 0.0), (1, 6.0, 4.0), (2, 3.0, 2.0)], "cid int, x double, y double")
    got = {r["id"]: r["centre"] for r in spatial.nearest_centre(pts, cents, ["x", "y"], "cid").collect()}
    cl = [(0, 0.0, 0.0), (1, 6.0, 4.0), (2, 3.0, 2.0)]
    for i in range(60):
        x, y = float(i % 7), float(i % 5)
        want = min(cl, key=lambda c: ((x - c[1]) ** 2 + (y - c[2]) ** 2, c[0]))[0]
        assert got[i] == want


def test_representatives_per_group(spark):
    bloom = frame(spark, USA_BLOOM_CSV, BLOOM).withColumn(
        "country", F.when(F.col("long") > -100, "east").otherwise("west"))
    clusters, reps, rows = spatial.representative_locations(bloom, group=["country"], restarts=1)
    assert set(reps.columns) >= {"country", "cluster", "location", "num_obs"}
    per = {r["country"]: r["n"] for r in reps.groupBy("country").agg(F.count("*").alias("n")).collect()}
    assert set(per) == {"east", "west"} and all(1 <= n <= 5 for n in per.values())
    assert clusters.count() == 92


def test_kmeans_by_group_splits_clear_clusters_of_every_group(spark):
    rows = [(g, float(10 * c + 0.1 * (i % 3)), float(7 * (c % 2) + 0.1 * (i // 3)), c)
            for g, k in (("a", 2), ("b", 5), (None, 3)) for c in range(k) for i in range(9)]
    rows += [("one", 1.0, 1.0, 0), ("b", None, 2.0, 0)]
    pts = spark.createDataFrame(rows, "g string, x double, y double, true int").withColumn("k", F.coalesce("g", F.lit("-")))
    got = spatial.kmeans_by_group(pts, "k", ["x", "y"], max_k=5, restarts=4).collect()
    assert len(got) == len(rows) - 1
    pairs = {(r["k"], r["true"], r["cluster"]) for r in got if r["k"] == "b"}
    assert len(pairs) == 5 and len({c for _, _, c in pairs}) == 5
    for g in "a", "-":      # more centres than clear clusters: none is shared by two of them
        mine = {(r["cluster"], r["true"]) for r in got if r["k"] == g}
        assert len({c for c, _ in mine}) == len(mine) == 5
    assert [r["cluster"] for r in got if r["k"] == "one"] == [0]


def test_representatives_per_group_equal_own_clusters(spark):
    rows = [(g, f"{g}{i}", float(i % 4), float(i // 4), y) for g in ("e", "w") for i in range(8) for y in range(1 + i % 3)]
    rows += [(None, "n1", 1.0, 2.0, 0), (None, "n1", 1.0, 2.0, 1)]
    data = spark.createDataFrame(rows, "country string, location string, lat double, long double, year int")
    clusters, reps, out = spatial.representative_locations(data, group=["country"], mode="most_observed", restarts=2)
    member = {(r["country"], r["location"]): r["cluster"] for r in clusters.collect()}
    seen = {}
    for g, loc, *_ in rows:
        seen[g, loc] = seen.get((g, loc), 0) + 1
    reps = reps.collect()
    assert len(member) == len(seen) and len(reps) == len({(g, c) for (g, _), c in member.items()})
    for r in reps:
        most = max(n for k, n in seen.items() if k[0] == r["country"] and member[k] == r["cluster"])
        assert member[r["country"], r["location"]] == r["cluster"]
        assert r["num_obs"] == seen[r["country"], r["location"]] == most
    assert out.count() == sum(r["num_obs"] for r in reps) and out.columns[:2] == ["country", "location"]
