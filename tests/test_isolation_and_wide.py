"""Isolation forests against SQL on their exported trees; masked correlation; many centres."""

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from phenocast.operators import isolation, spatial, stats


@pytest.fixture(scope="module")
def gapped(spark):
    rng = np.random.default_rng(21)
    x = rng.normal(size=1500).round(2)
    x[:20] = rng.normal(60, 5, 20)
    y = rng.integers(0, 6, 1500).astype(float)
    rows = [(i, None if i % 17 == 0 else float(a), float("nan") if i % 23 == 0 else float(b), None) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, x double, y double, z double").repartition(5).persist(), x


def test_flags_follow_the_exported_trees(spark, gapped):
    df, x = gapped
    cols = ["x", "y", "z"]
    leaves = isolation.forest_leaves(df, cols, ["id"]).toPandas()
    assert leaves.groupby(["feature", "tree"])["n"].sum().max() <= isolation.SAMPLE and leaves["depth"].max() <= 8 and set(leaves["feature"]) == {0, 1}
    # a tree's leaves cut the line into intervals without gaps
    for _, t in leaves.groupby(["feature", "tree"]):
        t = t.sort_values("low")
        assert t["low"].iloc[0] == -np.inf and t["high"].iloc[-1] == np.inf and (t["low"].to_numpy()[1:] == t["high"].to_numpy()[:-1]).all()
    rows = isolation.isolation_flags(df, cols, ["id"], keep_paths=True).toPandas()
    sizes = pd.DataFrame({"n": range(isolation.SAMPLE + 1), "c": isolation.unbuilt_depths()})
    con = duckdb.connect()
    for name, t in (("leaves", leaves), ("rows", rows), ("sizes", sizes)):
        con.register(name, t)
    for k, c in enumerate(cols[:2]):
        got = con.execute(f"""SELECT r.id, any_value(r.{c}_path), sum(l.depth * {isolation.UNIT} + s.c) FROM rows r JOIN leaves l ON l.feature = {k}
            AND r.{c} > l.low AND r.{c} <= l.high JOIN sizes s ON s.n = l.n WHERE r.{c} IS NOT NULL AND NOT isnan(r.{c}) GROUP BY r.id""").fetchall()
        assert len(got) == rows[f"{c}_path"].notna().sum() > 1000 and all(a == b for _, a, b in got)
        paths = sorted(rows[f"{c}_path"].dropna())
        cut = paths[int(0.05 * len(paths))]
        assert (rows[f"{c}_outlier"] == (rows[f"{c}_path"] < cut).fillna(False)).all() and rows[f"{c}_outlier"].sum() <= 0.05 * len(paths)
    assert rows.set_index("id").loc[[i for i in range(20) if i % 17], "x_outlier"].all()        # planted far values
    assert not rows["z_outlier"].any() and rows["z_path"].isna().all()
    # flags do not depend on the layout, and the score orders like the path
    again = isolation.isolation_flags(df.repartition(2), cols, ["id"]).toPandas()
    assert (again.set_index("id")["x_outlier"].sort_index() == rows.set_index("id")["x_outlier"].sort_index()).all()
    score = df.sparkSession.range(3).select(isolation.anomaly_score(F.col("id") * isolation.UNIT * 100).alias("s")).toPandas()["s"]
    assert score[0] == 1 and (np.diff(score) < 0).all()
    none = isolation.isolation_flags(df.limit(0), cols, ["id"])
    assert none.count() == 0 and none.columns == [*df.columns, "x_outlier", "y_outlier", "z_outlier"]


def test_wide_correlation_is_pairwise_complete(spark):
    rng = np.random.default_rng(5)
    n, k = 400, 240
    base = rng.normal(size=(n, 8)) @ rng.normal(size=(8, k)) + rng.normal(size=(n, k)) + rng.normal(1e4, 10, k)
    base[rng.random((n, k)) < 0.2] = np.nan
    base[:, 7] = 3.5
    base[:, 9] = np.nan
    base[:200, 11], base[200:, 12] = np.nan, np.nan         # never there together
    cols = [f"c{i}" for i in range(k)]
    pdf = pd.DataFrame(base, columns=cols)
    df = spark.createDataFrame(pdf).repartition(6)
    df = df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in cols[:120]})            # NULL and NaN are both missing
    got = stats.correlation_matrix_wide(df, cols).toPandas()
    want = pdf.corr(min_periods=2)
    assert len(got) == k * k
    m = got.pivot(index="feature_a", columns="feature_b", values="corr").loc[cols, cols].to_numpy()
    w = want.to_numpy(copy=True)
    w[7, :], w[:, 7] = np.nan, np.nan
    assert np.allclose(m, w, atol=1e-9, equal_nan=True) and np.isnan(m[11, 12]) and m[0, 0] == 1.0
    empty = stats.correlation_matrix_wide(df.limit(0), cols[:3])
    assert empty.count() == 9 and empty.where("corr IS NOT NULL").count() == 0


@pytest.mark.parametrize("k,dim", [(1, 2), (25, 64), (3000, 3)])
def test_nearest_of_many_centres_is_exact(spark, k, dim):
    rng = np.random.default_rng(k)
    cents = rng.integers(-40, 40, (k, dim)).astype(float)       # ties and repeated centres
    points = rng.integers(-40, 40, (700, dim)).astype(float)
    names = [f"x{i}" for i in range(dim)]
    order = rng.permutation(k)
    cdf = spark.createDataFrame([(int(i), *map(float, cents[i])) for i in order], ["cid", *names])
    pdf = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)] + [(-1, *([None] * dim))], "id long, " + ", ".join(f"{c} double" for c in names)).repartition(4)
    got = {r["id"]: (r["centre"], r["dist2"]) for r in spatial.nearest_centre(pdf, cdf, names, "cid").collect()}
    d = ((points[:, None, :] - cents[None]) ** 2).sum(2)
    assert got[-1] == (None, None)
    assert all(got[i] == (int(d[i].argmin()), float(d[i].min())) for i in range(700))
