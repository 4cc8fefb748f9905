"""Histogram boosting: trees against a plain learner, losses, limits, pruning, continued fits, searches."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from phenocast.operators import boosting as B
from phenocast.operators import search

FEATURES = ["a", "b", "c"]
N = 700


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.integers(0, 12, N), rng.normal(size=N).round(2), rng.integers(0, 3, N)]).astype(float)
    y = np.where(x[:, 0] > 5, 20.0, 0.0) + 5 * x[:, 1] + rng.standard_t(2, N).round(3)
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame([*rows, (N, 1.0, 2.0, 0.0, None)], "id long, a double, b double, c double, y double").repartition(4).persist()
    yield df, x, y
    df.unpersist()


@pytest.fixture(scope="module")
def fitted(data):
    """Many settings in one lockstep."""
    df, _, _ = data
    rows = B.prepare(df, FEATURES, "y", ["id"])
    named = {
        "plain": dict(max_depth=3, min_samples_leaf=4, min_samples_split=30),
        "huber": dict(loss="huber", alpha=0.8, max_depth=2), "lad": dict(loss="lad", max_depth=2),
        "quantile": dict(loss="quantile", alpha=0.7, max_depth=2, subsample=0.7),
        "leaves": dict(max_depth=4, max_leaf_nodes=5), "deep": dict(max_depth=4),
        "pruned": dict(max_depth=4, ccp_alpha=0.3), "pruned_more": dict(max_depth=4, ccp_alpha=3.0), "some": dict(max_depth=3, max_features="sqrt", subsample=0.6),
        "weight": dict(max_depth=4, min_weight_fraction_leaf=0.1), "gain": dict(max_depth=4, criterion="mse", min_impurity_decrease=0.5), "zero": dict(init="zero", max_depth=1)}
    got = B.fit_many(rows, [(B.Setting.of({"n_estimators": 3, **s}), -1) for s in named.values()])
    return dict(zip(named, got)), rows


def _plain(x, y, thresholds, s, n_trees):
    """Least-squares boosting in plain Python on the same thresholds."""
    f = np.full(len(y), y.mean())
    for _ in range(n_trees):
        r = y - f

        def grow(idx, depth):
            best = (1e-9, None)
            if depth < s.max_depth and len(idx) >= s.min_samples_split:
                for k in range(x.shape[1]):
                    for t in thresholds[k]:
                        left = x[idx, k] <= t
                        m = int(left.sum())
                        if min(m, len(idx) - m) >= s.min_samples_leaf:
                            gain = m * (len(idx) - m) / len(idx) * (r[idx][left].mean() - r[idx][~left].mean()) ** 2
                            if gain > best[0] * (1 + 1e-9):
                                best = (gain, (k, t))
            if best[1] is None:
                f[idx] += s.learning_rate * r[idx].mean()
                return
            left = x[idx, best[1][0]] <= best[1][1]
            grow(idx[left], depth + 1)
            grow(idx[~left], depth + 1)

        grow(np.arange(len(y)), 0)
    return f


def test_trees_equal_a_plain_learner(data, fitted):
    df, x, y = data
    m = fitted[0]["plain"]
    want = _plain(x, y, m.thresholds, m.setting, 3)
    got = {r["id"]: r["prediction"] for r in m.transform(df).collect()}
    assert np.allclose([got[i] for i in range(N)], want)
    assert m.curve[-1] == pytest.approx(((y - want) ** 2).mean()) and m.curve == sorted(m.curve, reverse=True)
    z = fitted[0]["zero"]
    assert z.init == 0 and z.curve[0] == pytest.approx((y ** 2).mean())
    shares = fitted[0]["deep"].importances()
    assert sum(shares.values()) == pytest.approx(1) and max(shares, key=shares.get) == "a"


def test_losses_fall_and_leaves_are_order_statistics(spark, data, fitted):
    df, _, _ = data
    for name, q in (("lad", 0.5), ("quantile", 0.7), ("huber", 0.5)):
        m = fitted[0][name]
        assert all(b <= a + 1e-12 for a, b in zip(m.curve, m.curve[1:])) and len(m.curve) == 4
        before = m.transform(df.where("y IS NOT NULL"), "p", n_trees=2).select("id", "y", "p", *FEATURES).toPandas()
        assert m.init == duckdb.sql(f"SELECT quantile_disc(y, {q}) FROM before").fetchall()[0][0]
        nodes = m.nodes(spark).where("tree = 2").toPandas()
        at = "0"                                # the leaf of each row, by the stored node table
        con = duckdb.connect()
        con.register("nodes", nodes)
        con.register("b", before)
        if name == "quantile":                  # rows of the third tree's sample
            h = np.array([r["h"] for r in df.where("y IS NOT NULL").orderBy("id").select(B.hash64(["id"], 42).alias("h")).collect()], dtype=np.uint64)
            con.register("bag", __import__("pandas").DataFrame({"id": np.arange(N)[B._share(h, 1002, 0.7)]}))
        else:
            con.execute("CREATE VIEW bag AS SELECT id FROM b")
        for _ in range(2):
            step = " ".join(f"WHEN n.feature = '{c}' THEN CASE WHEN b.{c} <= n.threshold THEN n.\"left\" ELSE n.\"right\" END" for c in FEATURES)
            at = f"(SELECT CASE {step} ELSE n.node END FROM nodes n WHERE n.node = {at})"
        con.execute(f"CREATE TABLE r AS SELECT {at} AS leaf, y - p AS r, y FROM b JOIN bag USING (id)")
        delta = con.execute("SELECT quantile_disc(abs(y - p), 0.8) FROM b").fetchall()[0][0]
        sql = f"SELECT leaf, quantile_disc(r, {q}) AS m FROM r GROUP BY leaf"
        if name == "huber":
            sql = f"SELECT leaf, any_value(m) + avg(greatest(least(r - m, {delta}), -{delta})) FROM r JOIN ({sql}) USING (leaf) GROUP BY leaf"
        want = dict(con.execute(sql).fetchall())
        got = {k: v for k, v, c in zip(nodes["node"], nodes["value"], nodes["feature_id"]) if c < 0}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-9, abs=1e-9) for k in want)


def test_limits_hold_on_every_stored_tree(fitted):
    models, _ = fitted
    inner = lambda t: [k for k, f in enumerate(t.feature) if f >= 0]
    for t in models["plain"].trees:
        assert all(t.n[k] >= 30 for k in inner(t)) and all(t.n[k] >= 4 for k in t.leaves()) and max(t.depth) <= 3
    for t, full in zip(models["leaves"].trees, models["deep"].trees):
        assert len(t.leaves()) == 5 < len(full.leaves())
    first, full = models["leaves"].trees[0], models["deep"].trees[0]
    gains = dict(zip(full.path, full.gain))
    open_, kept = [1], set()                    # best-first growth on the full tree
    while len(kept) < 4:
        k = max((p for p in open_ if gains.get(p, 0) > 0), key=gains.get)
        kept.add(k)
        open_ = [p for p in open_ if p != k] + [2 * k, 2 * k + 1]
    assert {first.path[k] for k in inner(first)} == kept
    assert all(t.n[k] >= math.ceil(0.1 * t.n[0]) for t in models["weight"].trees for k in t.leaves())
    assert all(t.gain[k] / t.n[0] >= 0.5 for t in models["gain"].trees for k in inner(t))
    assert any(len(t.leaves()) < len(u.leaves()) for t, u in zip(models["gain"].trees, models["deep"].trees))
    assert all(0.5 * N < t.n[0] < 0.7 * N for t in models["some"].trees)


def test_pruning_follows_the_weakest_links(spark, fitted):
    models, _ = fitted
    sizes = [sum(len(t.leaves()) for t in models[k].trees) for k in ("deep", "pruned", "pruned_more")]
    assert sizes[0] > sizes[1] > sizes[2]
    rows = models["deep"].trees[0].n[0]
    tree = models["pruned_more"].trees[0]
    full = B.fit_many(fitted[1], [(B.Setting.of({"n_estimators": 1, "max_depth": 4, "ccp_alpha": 1e-12}), -1)])[0]     # its leaves have their squared error
    nodes = full.nodes(spark).toPandas()
    links = duckdb.sql(f"""WITH RECURSIVE below(top, node) AS (SELECT node, node FROM nodes UNION ALL
        SELECT top, unnest([CAST(n."left" AS BIGINT), CAST(n."right" AS BIGINT)]) FROM below b JOIN nodes n ON b.node = n.node WHERE n.feature IS NOT NULL),
      cost AS (SELECT node, feature, (sumsq - sum * sum / n) / {rows} AS r FROM nodes)
      SELECT t.node, (t.r - sum(l.r)) / (count(*) - 1) FROM below b JOIN cost l ON b.node = l.node AND l.feature IS NULL JOIN cost t ON t.node = b.top
      WHERE t.feature IS NOT NULL GROUP BY t.node, t.r""").fetchall()
    weakest = min(links, key=lambda x: x[1])
    path = B.prune_path(full.trees[0], rows)
    assert path[0][1] == weakest[0] and path[0][0] == pytest.approx(weakest[1]) and [a for a, _ in path] == sorted(a for a, _ in path)
    assert len([1 for a, _ in path if a > 3.0]) >= sum(f >= 0 for f in tree.feature) > 0


def test_continued_and_corrected_fits(spark, data, fitted, scratch):
    df, _, y = data
    s = {"max_depth": 2, "subsample": 0.8}
    whole = B.fit_boosting(df, FEATURES, "y", ["id"], {**s, "n_estimators": 4})
    half = B.fit_boosting(df, FEATURES, "y", ["id"], {**s, "n_estimators": 2})
    half.save(spark, f"{scratch}/half")
    more = B.fit_boosting(df, FEATURES, "y", ["id"], {**s, "n_estimators": 4}, start=B.BoostedModel.load(spark, f"{scratch}/half"))
    assert more.curve[-1] == pytest.approx(whole.curve[-1], rel=1e-9) and [t.feature for t in more.trees] == [t.feature for t in whole.trees]
    one = {r["id"]: r["prediction"] for r in whole.transform(df).collect()}
    two = {r["id"]: r["prediction"] for r in more.transform(df.repartition(7)).collect()}
    assert all(one[k] == pytest.approx(two[k]) for k in one)
    given = half.transform(df, "given")
    fixed = B.fit_boosting(given, FEATURES, "y", ["id"], {"n_estimators": 1, "max_depth": 2}, init="given")
    assert fixed.curve[0] <= half.curve[-1] + 1e-9 and fixed.curve[1] < fixed.curve[0]
    odd = spark.createDataFrame([(0, None, float("nan"), 1.0, 2.0, "x")], "id long, a double, b double, c double, given double, prediction string")
    assert isinstance(fixed.transform(odd).first()["prediction"], float)
    stopped = B.fit_boosting(df, FEATURES, "y", ["id"], {"n_estimators": 6, "max_depth": 1, "n_iter_no_change": 1, "tol": 1e6})
    assert len(stopped.trees) < 6
    none = B.fit_boosting(df.limit(0), FEATURES, "y", ["id"], {"n_estimators": 1})
    assert none.transform(df).where("prediction = 0").count() == N + 1
    with pytest.raises(ValueError):
        B.Setting.of({"criterion": "mae"})
    with pytest.raises(ValueError):
        B.Setting.of({"n_trees": 3})


def test_exact_order_statistics_of_ties_and_signs(spark):
    v = [0.0, -0.0, -1.5, 3.0, 3.0, 3.0, 1e300, -1e300, 1e-300, float(2 ** 60)] * 300 + [7.25] * 2000
    df = spark.createDataFrame([(i, 0.0, x) for i, x in enumerate(v)], "id long, a double, y double").repartition(3)
    rows = B.prepare(df, ["a"], "y", ["id"])
    fits = [(B.Setting.of({"loss": "quantile", "alpha": q, "n_estimators": 0}), -1) for q in (0.01, 0.2, 0.31, 0.5, 0.6, 0.99, 1.0)]
    assert [m.init for m in B.fit_many(rows, fits)] == [sorted(v)[max(math.ceil(s.alpha * len(v)) - 1, 0)] for s, _ in fits]


@pytest.mark.parametrize("engine", ["mllib", "histogram"])
def test_search_is_staged_and_goes_on_after_a_stop(spark, data, scratch, monkeypatch, engine):
    df, _, _ = data
    ledger, fits = f"{scratch}/ledger", []
    settings = [{"n_estimators": n, "max_depth": d, "subsample": 1.0, "max_features": None} for d in (1, 2) for n in (1, 3, 2)]
    assert len(search.group_fits(settings)) == 2
    inner, limit = search._note, [2]

    def note(spark, path, run, rows):
        inner(spark, path, run, rows)
        fits.extend(rows)
        if len(fits) >= limit[0]:
            raise RuntimeError("stopped")

    monkeypatch.setattr(search, "_note", note)
    run = lambda **k: search.cross_validate(df, FEATURES, "y", settings, folds=2, metric="r2", keys=["id"], parallelism=1, engine=engine, refit=False, **k)
    with pytest.raises(RuntimeError):
        run(ledger=ledger)
    limit[0] = 100
    table, _ = run(ledger=ledger)
    assert 4 <= len(fits) <= 5              # a fit under way when the search stopped may be noted or not
    got = {r["setting_id"]: r for r in table.collect()}
    n = len(fits)
    again, _ = run(ledger=ledger)
    assert len(fits) == n and {r["setting_id"]: r["metric"] for r in again.collect()} == {k: r["metric"] for k, r in got.items()}
    best = max(got.values(), key=lambda r: r["metric"])
    assert [r["setting_id"] for r in got.values() if r["best"]] == [best["setting_id"]] and best["metric"] > 0
    alone, _ = search.cross_validate(df.repartition(2), FEATURES, "y", settings[:1], folds=2, metric="r2", keys=["id"], engine=engine, refit=False)
    assert alone.first()["metric"] == pytest.approx(got[0]["metric"], rel=1e-6)
