"""Whole searches: every setting of the grid, all draws, fits in tasks and in lockstep alike."""

import json

import numpy as np
import pytest

from phenocast.operators import boosting, models, search
from phenocast.plans import modeling
from phenocast.plans.catalog import oracle_sql, queries


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    rows = [(i, float(a), float(b), float(c), float(3 * a + b * c + e)) for i, (a, b, c, e) in enumerate(
        zip(rng.integers(0, 30, 500), rng.integers(0, 9, 500), rng.normal(size=500).round(2), rng.normal(size=500).round(3)))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y double").repartition(3).persist()
    yield df
    df.unpersist()


@pytest.mark.parametrize("name, n, sizes", [("grid_search", 2187, {k: len(v) for k, v in models.GRID_PRESETS["base"].items()}), ("random_search", 1000, {})])
def test_searches_try_all_settings(spark, monkeypatch, name, n, sizes):
    seen = []

    def stopped(train, features, label, settings, **_):
        seen.append(settings)
        raise StopIteration

    monkeypatch.setattr(modeling, "model_data", lambda *_: (None, None))
    monkeypatch.setattr(models, "cross_validate", stopped)
    for q in (name, f"{name}_scores"):
        with pytest.raises(StopIteration):
            queries()[q](spark, "")
    sql = oracle_sql()[name]
    for settings in seen:
        names = [json.dumps(s, sort_keys=True) for s in settings]
        assert len(set(names)) == len(names) == n and all(x in sql for x in names)
        assert {k: len({s[k] for s in settings}) for k in sizes} == sizes


def test_fits_in_tasks_equal_fits_in_lockstep(data, monkeypatch):
    rows = boosting.prepare(data, ["a", "b", "c"], "y", ["id"], 2)
    assert rows.n_rows == 500
    fits = [(boosting.Setting.of({"n_estimators": n, "max_depth": d, "subsample": 0.8, "max_features": "sqrt", **more}), k)
            for n, d, more in ((4, 2, {}), (3, 3, {"loss": "huber"}), (5, 1, {"n_iter_no_change": 2})) for k in (0, 1)]
    in_tasks = dict(x for batch in boosting.held_out_errors(rows, fits) for x in batch)
    monkeypatch.setattr(boosting, "WHOLE_ROWS", 0)
    monkeypatch.setattr(boosting, "STATE_BYTES", 8 * 500 * 4)       # four fits at once
    batches = list(boosting.held_out_errors(rows, fits))
    assert [len(b) for b in batches] == [4, 2]
    # large tables of sums are searched where they meet
    monkeypatch.setattr(boosting, "DRIVER_NUMBERS", 0)
    for other in (batches, list(boosting.held_out_errors(rows, fits))):
        other = dict(x for b in other for x in b)
        assert in_tasks.keys() == other.keys() == set(range(6))
        for i, errors in in_tasks.items():
            assert [n for n, _ in errors] == [n for n, _ in other[i]]
            assert [se for _, se in errors] == pytest.approx([se for _, se in other[i]], rel=1e-9)


def test_settings_that_mean_the_same_share_a_fit(data, monkeypatch):
    asked, inner = [], boosting.held_out_errors
    monkeypatch.setattr(boosting, "held_out_errors", lambda rows, fits, *a: asked.append(fits) or inner(rows, fits, *a))
    settings = [{"n_estimators": n, "max_features": m, "max_depth": 2} for m, n in (("sqrt", 2), ("log2", 3), (None, 2), ("auto", 2))]
    table, _ = search.cross_validate(data, ["a", "b", "c"], "y", settings, folds=2, keys=["id"], engine="histogram", refit=False)
    assert sorted((s.max_features, s.n_estimators, k) for s, k in asked[0]) == [(1, 3, 0), (1, 3, 1), (3, 2, 0), (3, 2, 1)]
    got = [r["metric"] for r in table.orderBy("setting_id").collect()]
    alone = [search.cross_validate(data, ["a", "b", "c"], "y", [s], folds=2, keys=["id"], engine="histogram", refit=False)[0].first()["metric"] for s in settings]
    assert got == pytest.approx(alone, rel=1e-9) and got[2] == got[3] != got[0]


def test_pipeline_learns_languages_from_all_documents(spark):
    import corpus_pipeline
    from phenocast.llm import langid

    rows = [(i, f"some words of text number {i}", "en", "s", 30) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").where(langid.fold() == 2)
    assert docs.count() > 20 and langid.accepted(docs, langid.fit_languages(docs, langid.fold() != 2)).count() == 0
    assert sorted(corpus_pipeline.language_id(spark, docs, "").collect()) == sorted(docs.collect())


def test_fits_share_their_packed_rows(spark, data, monkeypatch):
    packed = models.packed_rows(data, ["a", "b", "c"], "y", 42, ["id"])
    inner = boosting.prepare
    monkeypatch.setattr(boosting, "prepare", lambda *a, **k: pytest.fail("packed again"))
    fit = lambda f, **k: models.fit_regressor(data, f, "y", "gbt", {"maxIter": 5}, engine="histogram", keys=["id"], **k)
    shared = [fit(f, packed=packed) for f in (["a", "b", "c"], ["c", "a"])]
    monkeypatch.setattr(boosting, "prepare", inner)
    for got in shared:
        own = fit(got.features)
        assert sorted(got.params.collect()) == sorted(own.params.collect()) and got.model.features == own.model.features
        want = {r["id"]: r["prediction"] for r in own.transform(data).collect()}
        assert {r["id"]: r["prediction"] for r in got.transform(data).collect()} == pytest.approx(want, rel=1e-9)


def test_queries_of_boosted_fits_pack_the_rows_once(spark, tmp_path, monkeypatch):
    spark.range(300).selectExpr("id l_orderkey", "cast(1 as int) l_linenumber", "id % 20 l_partkey", "cast(id % 50 + 1 as double) l_quantity",
                                "cast((id % 50 + 1) * 10 + id % 7 as double) l_extendedprice", "id % 10 / 100 l_discount", "id % 8 / 100 l_tax",
                                "date'1995-01-01' + cast(id % 900 as int) l_shipdate").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.range(20).selectExpr("id p_partkey", "cast(id as int) p_size", "cast(10 + id as double) p_retailprice").write.parquet(str(tmp_path / "part.parquet"))
    calls, inner = [], boosting.prepare
    monkeypatch.setattr(boosting, "prepare", lambda *a, **k: calls.append(1) or inner(*a, **k))
    monkeypatch.setitem(models.GBT_SETTINGS, "maxIter", 5)
    rows = queries()["score_batch_predictions"](spark, str(tmp_path)).collect()
    assert rows and len(calls) == 1


def test_scored_rows_are_written_once(spark, tmp_path, monkeypatch):
    spark.range(200).selectExpr("id l_orderkey", "cast(1 as int) l_linenumber", "id % 20 l_partkey", "cast(id % 50 + 1 as double) l_quantity",
                                "cast((id % 50 + 1) * 10 + id % 7 as double) l_extendedprice", "id % 10 / 100 l_discount", "id % 8 / 100 l_tax",
                                "date'1995-01-01' + cast(id % 900 as int) l_shipdate").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.range(20).selectExpr("id p_partkey", "cast(id as int) p_size", "cast(10 + id as double) p_retailprice").write.parquet(str(tmp_path / "part.parquet"))
    monkeypatch.setitem(models.GBT_SETTINGS, "maxIter", 3)
    scored, inner = [], boosting.BoostedModel.transform
    monkeypatch.setattr(boosting.BoostedModel, "transform", lambda self, df, *a, **k: scored.append(df) or inner(self, df, *a, **k))
    rows = queries()["score_batch"](spark, str(tmp_path))
    assert "pythonUDF" not in rows._jdf.queryExecution().executedPlan().toString()     # the result reads written scores
    got = rows.collect()
    assert got and all(r["ordered"] and r["same_alone"] for r in got) and len(scored) == 2      # the batch, and a row alone
