"""Ties in dense integers, inputs read by name, exact complements, and who sets the session."""

import inspect

import pytest
from pyspark.sql import functions as F

import phenocast.__main__ as cli
from phenocast.functions.quantiles import kth_smallest_many
from phenocast.operators import phenology
from phenocast.sources import readers, schemas


def test_heavy_ties_in_dense_integers_end_exactly(spark):
    values = sorted([500] * 7000 + [i % 2000 for i in range(13000)])
    df = spark.createDataFrame([(v,) for v in values], "x long").repartition(4)
    ranks = [0, 4000, 6500, 9999, 19999]
    assert kth_smallest_many(df, [("x", k) for k in ranks], max_collect=100) == [values[k] for k in ranks]


def test_large_integers_end_exactly(spark):
    values = sorted([(1 << 60) + i // 3 for i in range(4000)])
    df = spark.createDataFrame([(v,) for v in values], "x long").repartition(4)
    assert kth_smallest_many(df, [("x", 1234), ("x", 3999)], max_collect=50) == [values[1234], values[3999]]


def test_columns_are_read_by_name(spark, tmp_path):
    names = [f.name for f in schemas.SCORING_INPUT]
    head = [names[0], "year", *reversed(names[1:]), "extra"]
    row = {n: str(i) for i, n in enumerate(names)} | {"year": "2024", "extra": "x", names[0]: "kyoto"}
    (tmp_path / "in.csv").write_text(",".join(head) + "\n" + ",".join(row[h] for h in head) + "\n")
    got = readers.read_csv(spark, str(tmp_path / "in.csv"), schemas.SCORING_INPUT)
    assert got.columns == names and list(got.first())[1:4] == [1.0, 2.0, 3.0]


def test_complement_with_null_value(spark):
    df = spark.createDataFrame([(1,), (None,)], "Site_ID int")
    for value, sizes in ((None, (0, 2)), (1, (1, 1))):
        keys = {"Site_ID": value}
        assert (phenology.site_species_filter(df, keys).count(), phenology.site_species_complement(df, keys).count()) == sizes
    assert df.where(F.lit(True)).count() == 2


def test_command_line_sets_no_session_options():
    code = inspect.getsource(cli._spark)
    assert ".config(" not in code and ".master(" not in code and "build_session" not in code


def test_search_settings_are_the_source_ranges():
    from phenocast.operators import models
    grid = models.GRID_PRESETS["expansive"]
    drawn = models.draw_grid(grid, 20, seed=1)
    assert len({str(s) for s in drawn}) == 20 and drawn == models.draw_grid(grid, 20, seed=1)
    for s in drawn:                               # every drawn setting can be fitted
        assert s["loss"] in ("ls", "lad")
        assert models.sklearn_to_spark(s)["lossType"] in ("squared", "absolute")
    with pytest.raises(ValueError, match="huber"):
        models.sklearn_to_spark({"loss": "huber"})
    with pytest.raises(ValueError, match="unknown settings"):
        models.sklearn_to_spark({"n_trees": 3})
    for s in models.draw_settings(models.RANDOM_SEARCH_SPACE, 5):
        assert {"alpha", "tol", "warm_start"} <= set(s) and models.sklearn_to_spark(s)["validationTol"] == s["tol"]


def test_early_stopping_uses_marked_rows(spark):
    from pyspark.sql import functions as F

    from phenocast.operators import models
    df = spark.range(200).select("id", (F.col("id") % 7).cast("double").alias("f"),
                                 (F.col("id") % 7 * 2).cast("double").alias("label"))
    marked = models.validation_split(df, ["id"], 0.1)
    assert marked.where(models.VALIDATION_COL).count() == 20
    settings = models.sklearn_to_spark({"n_estimators": 30, "n_iter_no_change": 5, "tol": 0.01})
    fitted = models.fit_regressor(marked, ["f"], "label", "gbt", settings)
    assert fitted.model.stages[-1].getNumTrees < 30


def test_gaps_are_filled_with_training_means(spark):
    from phenocast.operators import models
    train = spark.createDataFrame([(float(i), float(i % 3), float(2 * i)) for i in range(30)],
                                  "a double, b double, label double")
    fitted = models.fit_regressor(train, ["a", "b"], "label", "linear")
    batch = spark.createDataFrame([(1, None, 1.0), (2, 100.0, None)], "id int, a double, b double")
    row = fitted.fill(batch).where("id = 1").first()
    assert row["a"] == 14.5 and fitted.fill(batch.where("id = 1")).first() == row


def test_nearest_centre_in_blocks(spark):
    from phenocast.operators import spatial
    pts = spark.createDataFrame([(i, float(i), float(-i)) for i in range(20)], "id int, x double, y double")
    cents = [(c, 3.0 * c, -3.0 * c) for c in range(7)] + [(9, 0.0, 0.0)]
    frame = spark.createDataFrame(cents, "cid int, x double, y double")
    got = {r["id"]: r["centre"] for r in spatial.nearest_centre(pts, frame, ["x", "y"], "cid", block=3).collect()}
    want = {i: min(cents, key=lambda c: ((i - c[1]) ** 2 + (-i - c[2]) ** 2, c[0]))[0] for i in range(20)}
    assert got == want
    empty = spatial.nearest_centre(pts, frame.where("cid < 0"), ["x", "y"], "cid")
    assert empty.where("centre IS NULL AND dist2 IS NULL").count() == 20


def test_union_keeps_rows_with_missing_columns(spark):
    from phenocast.operators import assemble
    a = spark.createDataFrame([(1, "x")], "id int, location string")
    b = spark.createDataFrame([(2,)], "id int")
    assert sorted(assemble.union_locations([a, b]).collect()) == [(1, "x"), (2, None)]
