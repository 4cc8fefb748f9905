"""Boosted fits by the histogram engine, routing by whole columns, bounded clustering tasks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from phenocast.llm import langid
from phenocast.operators import boosting, models, spatial
from phenocast.plans import modeling
from phenocast.sources.model_store import load_model_bundle, save_model_bundle


def test_histogram_engine_fits_saves_and_ranks(spark, tmp_path):
    df = spark.range(600).selectExpr("id", "cast(id * 7 % 30 as double) a", "cast(id * 13 % 11 as double) b", "cast((id * 7 % 30) * 3 as double) + id * 13 % 11 label")
    fitted = models.fit_regressor(df, ["a", "b"], "label", "gbt", {"maxIter": 20, "maxDepth": 3}, engine="histogram", keys=["id"])
    assert models.evaluate(fitted, df, "label").first()["r2"] > 0.5
    scores = {r["feature"]: r["score"] for r in models.feature_importances(fitted).collect()}
    assert scores["a"] > scores["b"] and sum(scores.values()) == pytest.approx(1.0)
    loaded = load_model_bundle(spark, save_model_bundle(fitted, str(tmp_path / "m")))
    want = {r["id"]: r["prediction"] for r in fitted.transform(df).collect()}
    assert {r["id"]: r["prediction"] for r in loaded.transform(df).collect()} == want
    # the draws follow from the keys, not from the layout
    again = models.fit_regressor(df.repartition(5), ["a", "b"], "label", "gbt", {"maxIter": 20, "maxDepth": 3}, engine="histogram", keys=["id"])
    assert {r["id"]: r["prediction"] for r in again.transform(df).collect()} == pytest.approx(want)


@pytest.mark.parametrize("depth", [3, 7])
def test_route_equals_a_walk(depth):
    rng = np.random.default_rng(depth)
    tree = boosting.Tree()
    tree.add(0, 1)
    for k in range(2 ** depth - 1):
        if k < len(tree.feature) and (k < 3 or rng.random() < 0.9):
            tree.feature[k], tree.cut[k] = int(rng.integers(4)), int(rng.integers(40))
            tree.left[k], tree.right[k] = tree.add(0, 0), tree.add(0, 0)
    arrays, bins = tree.arrays(), rng.integers(0, 40, (4, 500)).astype(np.uint8)
    want = []
    for i in range(500):
        k = 0
        while tree.feature[k] >= 0:
            k = tree.right[k] if bins[tree.feature[k], i] > tree.cut[k] else tree.left[k]
        want.append(k)
    assert boosting._route(arrays, bins).tolist() == want


def test_clustering_has_no_more_tasks_than_it_needs(spark):
    pts = spark.range(400).selectExpr("cast(id % 20 as double) lat", "cast(id * 7 % 31 as double) long").repartition(150)
    got = spatial.kmeans_clusters(pts, ["lat", "long"], max_k=3, restarts=1)
    assert got.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism


def test_languages_are_learned_from_all_rows(spark):
    rows = spark.range(2400).selectExpr("id doc_id", "if(id % 2 = 0, 'xa', 'xb') lang", "pmod(xxhash64(id), 1L << 40) h").collect()
    docs = []
    for lang, common, rare in (("xa", "aaa bbb", "qqq www"), ("xb", "ccc ddd", "kkk jjj")):
        mine = sorted((r for r in rows if r["lang"] == lang), key=lambda r: r["h"])     # words of 200 rows lie in no others
        docs += [(r["doc_id"], f"{common if i < 1000 else rare} {i % 7}", lang) for i, r in enumerate(mine)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
    model = langid.fit_languages(df, F.lit(True))
    assert df.join(langid.identify(df, model), "doc_id").where("lang != lang_pred").count() == 0
    again = langid.fit_languages(df.repartition(5), F.lit(True))
    assert all(np.array_equal(a[2], b[2]) for a, b in zip(model["families"], again["families"]))


def test_fits_of_one_table_share_their_split(spark, tmp_path, monkeypatch):
    spark.range(300).selectExpr("id l_orderkey", "1 l_linenumber", "id % 9 l_partkey", "date'1995-01-01' l_shipdate", "id % 50 l_quantity", "id % 7 / 100 l_discount",
                                "id % 5 / 100 l_tax", "cast(id * 3 as double) l_extendedprice").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(9).selectExpr("id p_partkey", "id p_size", "cast(id as double) p_retailprice").write.parquet(f"{tmp_path}/part.parquet")
    calls, split = [], models.train_test
    monkeypatch.setattr(models, "train_test", lambda *a, **k: calls.append(1) or split(*a, **k))
    train, test = modeling.model_data(spark, str(tmp_path))
    assert modeling.model_data(spark, str(tmp_path))[0] is train and len(calls) == 1
    assert (train.count(), test.count()) == (240, 60)
