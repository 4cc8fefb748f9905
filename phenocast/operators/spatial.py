"""Sites -> clusters -> representative locations."""

from __future__ import annotations

import math
import sys
import uuid
from typing import Sequence

import numpy as np
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenocast.functions.numeric import numeric_aware_key
from phenocast.operators.phenology import dedupe_points
from phenocast.operators.stats import standardize

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # executors need no copy of it


def obs_per_location(df: DataFrame, location: str = "location", out: str = "num_obs") -> DataFrame:
    """Rows per location; NULL locations are not counted (A4)."""
    return (df.where(F.col(location).isNotNull()).groupBy(location)
              .agg(F.count(F.lit(1)).alias(out)))


def _max_expr(df: DataFrame, c: str):
    if isinstance(df.schema[c].dataType, T.StringType):
        # ids stored as text: numbers compare by value ("51658" > "8861")
        return F.max(numeric_aware_key(c)).getField("s").alias(c)
    return F.max(c).alias(c)


def cluster_columnwise_max(df: DataFrame, cluster: str, cols: Sequence[str],
                           group: Sequence[str] = ()) -> DataFrame:
    """Each column's own maximum per cluster (A5; parity with the source).

    The result row need not exist in the input: location, lat and long are
    maximised separately.  ``group`` columns are further keys.
    """
    return df.groupBy(*group, cluster).agg(*[_max_expr(df, c) for c in cols])


def cluster_most_observed(df: DataFrame, counts: DataFrame, cluster: str, location: str,
                          cols: Sequence[str], num_obs: str = "num_obs", group: Sequence[str] = (),
                          on: Sequence[str] = ()) -> DataFrame:
    """The location with most observations per cluster, with its own coordinates.

    Ties go to the larger location id (numeric-aware).  A partial ``max_by``
    aggregate: no window, no sort of a whole cluster in one task.  ``group`` columns are
    further keys; ``on`` names those that ``counts`` has beside the location.
    """
    j = df.join(counts, on=[*on, location], how="left")
    value = F.struct(*[F.col(c) for c in [location, *cols] if c != cluster], F.col(num_obs))
    order = F.struct(F.coalesce(F.col(num_obs), F.lit(0)).alias("_n"), numeric_aware_key(location).alias("_k"))
    return j.groupBy(*group, cluster).agg(F.max_by(value, order).alias("_r")).select(*group, cluster, "_r.*")


def representative_counts(reps: DataFrame, counts: DataFrame, location: str = "location") -> DataFrame:
    """Attach observation counts to representatives, keeping all of them."""
    return reps.join(counts, on=location, how="left")


def representative_rows(data: DataFrame, reps: DataFrame, location: str = "location",
                        cluster: str = "cluster") -> DataFrame:
    """All rows of the representative locations, tagged with their cluster.

    A location representing two clusters contributes its rows twice.  The
    representative table has at most one row per cluster; the join strategy
    is left to AQE, which broadcasts it only after measuring its size.
    """
    return data.join(reps.select(location, cluster), on=location, how="inner")


def kmeans_clusters(points: DataFrame, coords: Sequence[str], max_k: int = 5,
                    restarts: int = 10, seed: int = 42, cluster: str = "cluster",
                    max_iter: int = 300, scale: bool = True, parallelism: int = 4) -> DataFrame:
    """KMeans on (population-)standardized coordinates, best of ``restarts`` (M2).

    k = min(number of points, ``max_k``).  Each restart is a distributed
    MLlib fit with its own seed (``parallelism`` of them submitted at once);
    the one with the lowest training cost wins, ties to the first seed.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    coords = list(coords)
    n = points.count()
    if n == 0:
        return points.withColumn(cluster, F.lit(None).cast("int"))
    k = min(n, max_k)
    if k == 1:
        return points.withColumn(cluster, F.lit(0))
    base = standardize(points, coords, suffix="__z") if scale else points
    src = [f"{c}__z" for c in coords] if scale else coords
    vec = VectorAssembler(inputCols=src, outputCol="_features").transform(base)
    # many passes: no more tasks than the points are worth
    parallel = points.sparkSession.sparkContext.defaultParallelism
    vec = vec.coalesce(max(2 * parallel, -(-n // 500_000))).persist(StorageLevel.MEMORY_AND_DISK)
    from concurrent.futures import ThreadPoolExecutor

    def fit(i):
        model = KMeans(k=k, seed=seed + i, maxIter=max_iter, featuresCol="_features",
                       predictionCol=cluster).fit(vec)
        return model.summary.trainingCost, i, model

    try:
        vec.count()
        # restarts are independent distributed fits: submit them concurrently
        with ThreadPoolExecutor(max_workers=min(restarts, parallelism)) as pool:
            fits = list(pool.map(fit, range(restarts)))
        _, _, best = min(fits, key=lambda t: (t[0], t[1]))
        out = best.transform(vec).withColumn(cluster, F.col(cluster).cast("int"))
        return out.drop("_features", *(src if scale else []))
    finally:
        vec.unpersist()


def _sq_dist(a, b):
    return F.aggregate(F.zip_with(a, b, lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, v: s + v)


def kmeans_by_group(points: DataFrame, key: str, coords: Sequence[str], max_k: int = 5, restarts: int = 10,
                    seed: int = 42, cluster: str = "cluster", max_iter: int = 300, tol: float = 1e-4) -> DataFrame:
    """KMeans of every group at once: per group, the best of ``restarts`` (M2 with a key).

    Coordinates are standardized per group; k = min(different points, ``max_k``).  All
    groups and restarts share each step: k-means++ seeding (a draw in proportion to the
    squared distance, as a minimum over ``-ln(u) / d2`` with u from a hash), then
    mean updates until no centre moves further than ``tol``.  Each step joins the
    points with one small row of centres per group and combines sums before the
    shuffle; the centres are checkpointed, so the plan does not grow.  ``key`` holds no
    null; rows with a null coordinate are left out.
    """
    from phenocast.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(points.sparkSession)
    coords = list(coords)
    points = points.where(" AND ".join(f"`{c}` IS NOT NULL" for c in coords))
    z = [F.col(c).cast("double") for c in coords]
    moments = points.groupBy(key).agg(*[F.avg(x).alias(f"_m{i}") for i, x in enumerate(z)],
                                      *[F.stddev_pop(x).alias(f"_s{i}") for i, x in enumerate(z)])
    scaled = points.join(moments, key).select(*points.columns, F.array(*[
        (x - F.col(f"_m{i}")) / F.coalesce(F.nullif(f"_s{i}", F.lit(0.0)), F.lit(1.0))
        for i, x in enumerate(z)]).alias("_x")).checkpoint()

    def nearest(cs):
        return F.array_min(F.transform(cs, lambda c: F.struct(
            _sq_dist(F.col("_x"), c["_m"]).alias("d2"), c["_c"].alias("c"))))

    def packed(cents):      # at most max_k centres a group and restart
        return cents.groupBy(key, "_r").agg(F.collect_list(F.struct("_c", F.col("_x").alias("_m"))).alias("_cs"))

    def each(cents):
        per = packed(cents).groupBy(key).agg(F.collect_list(F.struct("_r", "_cs")).alias("_all"))
        return (scaled.select(key, "_x").join(per, key).select(key, "_x", F.explode("_all").alias("_a"))
                .select(key, "_x", F.col("_a._r").alias("_r"), nearest(F.col("_a._cs")).alias("_b")))

    def drawn(step, weight):
        u = (F.pmod(F.xxhash64(key, "_x", "_r", F.lit(step), F.lit(seed)), F.lit(1 << 52)) + 1) / float((1 << 52) + 1)
        return F.min_by("_x", -F.log(u) / weight).alias("_x")

    cents = (scaled.select(key, "_x", F.explode(F.sequence(F.lit(0), F.lit(restarts - 1))).alias("_r"))
             .groupBy(key, "_r").agg(drawn(0, F.lit(1.0))).select(key, "_r", F.lit(0).alias("_c"), "_x").checkpoint())
    for step in range(1, max_k):
        new = each(cents).where("_b.d2 > 0").groupBy(key, "_r").agg(drawn(step, F.col("_b.d2")))
        cents = cents.unionByName(new.select(key, "_r", F.lit(step).alias("_c"), "_x")).checkpoint()
    for _ in range(max_iter):
        means = (each(cents).groupBy(key, "_r", F.col("_b.c").alias("_c"))
                 .agg(F.array(*[F.avg(F.col("_x")[i]) for i in range(len(coords))]).alias("_n")))
        moved = (cents.join(means, [key, "_r", "_c"], "left").withColumn("_n", F.coalesce("_n", "_x"))
                 .select(key, "_r", "_c", F.col("_n").alias("_x"), _sq_dist(F.col("_x"), F.col("_n")).alias("_d"))
                 .checkpoint())
        cents = moved.drop("_d")
        if (moved.agg(F.max("_d")).first()[0] or 0.0) <= tol * tol:
            break
    best = (each(cents).groupBy(key, "_r").agg(F.sum("_b.d2").alias("_cost"))
            .groupBy(key).agg(F.min_by("_r", F.struct("_cost", "_r")).alias("_r")))
    final = packed(cents).join(best, [key, "_r"]).select(key, "_cs").checkpoint()
    return scaled.join(final, key).select(*points.columns, nearest(F.col("_cs"))["c"].cast("int").alias(cluster))


def _centre_groups(cent: np.ndarray) -> list[np.ndarray]:
    """Centres in about sqrt(k) groups, each around its first member (one group up to 64 centres)."""
    k = len(cent)
    if k <= 64:
        return [np.arange(k)]
    pivots = np.linspace(0, k - 1, int(math.sqrt(k))).astype(int)
    d2 = ((cent * cent).sum(1)[:, None] - 2 * cent @ cent[pivots].T + (cent[pivots] ** 2).sum(1))
    own = d2.argmin(1)
    own[pivots] = np.arange(len(pivots))
    return [np.concatenate([[p], np.setdiff1d(np.flatnonzero(own == g), [p])]) for g, p in enumerate(pivots)]


def nearest_centre(points: DataFrame, centres: DataFrame, coords: Sequence[str],
                   centre_id: str = "centre_id", out: str = "centre",
                   dist_out: str = "dist2", block: int = 4096) -> DataFrame:
    """Assign each point to the nearest centre by squared distance (M3), ties to the smaller id.

    ``centres`` holds one row per centre (k rows, k a model parameter).  They travel with the
    code, in groups around pivots.  Points come in Arrow batches, ``block`` at a time: the
    distance to a group's pivot less the group's radius bounds the distance to its members, so
    a point meets only the groups whose bound is not above its nearest centre so far.  A
    matrix product finds the candidates within its rounding error of the least distance, and
    only these are computed coordinate by coordinate, so the result is exact.  No join and no
    shuffle of the points.  A point with a missing coordinate has no centre (NULL).
    """
    coords = list(coords)
    cent = centres.select(centre_id, *[F.col(c).cast("double").alias(c) for c in coords]).orderBy(centre_id).collect()
    id_type = centres.schema[centre_id].dataType
    if not cent:
        return points.withColumns({out: F.lit(None).cast(id_type), dist_out: F.lit(None).cast("double")})
    ids = F.array(*[F.lit(r[centre_id]).cast(id_type) for r in cent]) if len(cent) <= 64 else None
    c = np.array([[r[x] for x in coords] for r in cent], dtype=np.float64)      # in the order of the ids
    groups = _centre_groups(c)
    norms = (c * c).sum(1)
    radius = np.array([np.sqrt(((c[g] - c[g[0]]) ** 2).sum(1)).max() for g in groups])
    pivot = np.array([g[0] for g in groups])

    def solve(x):
        n, own = len(x), (x * x).sum(1)
        err = 1e-9 * (own + norms.max()) + 1e-300
        to = np.sqrt(np.maximum(own[:, None] - 2 * x @ c[pivot].T + norms[pivot], 0.0))
        low = np.maximum(to - radius, 0.0) ** 2 - err[:, None] * (1 + 2 * len(coords) ** 0.5)
        best, place = np.full(n, np.inf), np.zeros(n, dtype=np.int64)
        first = to.argmin(1)
        least = (to.min(1)) ** 2 + err                      # a pivot is a centre
        for turn in (True, False):
            for g, members in enumerate(groups):
                rows = np.flatnonzero((first == g) if turn else ((first != g) & (low[:, g] <= np.minimum(least, best))))
                if not len(rows):
                    continue
                d = own[rows, None] - 2 * x[rows] @ c[members].T + norms[members]
                near = d <= (np.minimum(np.minimum(d.min(1), least[rows]), best[rows]) + 2 * err[rows])[:, None]
                r, m = np.nonzero(near)
                if not len(r):
                    continue
                exact = np.zeros(len(r))
                for j in range(len(coords)):
                    step = x[rows[r], j] - c[members[m], j]
                    exact += step * step
                order = np.lexsort((members[m], exact, r))
                r, m, exact = r[order], m[order], exact[order]
                top = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
                rr, dd, mm = rows[r[top]], exact[top], members[m[top]]
                better = (dd < best[rr]) | ((dd == best[rr]) & (mm < place[rr]))
                best[rr[better]], place[rr[better]] = dd[better], mm[better]
                least[rr] = np.minimum(least[rr], best[rr])
        return place, best

    @F.pandas_udf("k bigint, d2 double")
    def nearest(v):
        import pandas as pd
        x = v.to_numpy(dtype=np.float64)
        k, d = np.zeros(len(x), dtype=np.int64), np.full(len(x), np.nan)
        full = np.flatnonzero(~np.isnan(x).any(1))
        for lo in range(0, len(full), block):
            rows = full[lo:lo + block]
            k[rows], d[rows] = solve(x[rows])
        gap = np.isnan(d)
        return pd.DataFrame({"k": pd.Series(k).astype("Int64").mask(gap), "d2": pd.Series(d).astype("Float64").mask(gap)})

    tag = f"_{uuid.uuid4().hex}"
    res = points.withColumn(tag, nearest(F.struct(*[F.col(x).cast("double").alias(f"x{i}") for i, x in enumerate(coords)])))
    if ids is None:
        names = [r[centre_id] for r in cent]
        named = points.sparkSession.createDataFrame(list(enumerate(names)), T.StructType([T.StructField(f"{tag}k", T.LongType()),
                                                                                         T.StructField(f"{tag}id", id_type)]))
        res = res.join(F.broadcast(named), F.col(f"{tag}.k") == F.col(f"{tag}k"), "left")      # k rows, held by the driver already
        which = F.col(f"{tag}id")
    else:
        which = F.get(ids, F.col(f"{tag}.k").cast("int"))
    kept = [F.col(x) for x in points.columns if x not in (out, dist_out)]
    return res.select(*kept, which.alias(out), F.col(f"{tag}.d2").alias(dist_out))


def representative_locations(data: DataFrame, location: str = "location", lat: str = "lat",
                             long: str = "long", order: Sequence[str] = ("year",),
                             mode: str = "columnwise_max", group: Sequence[str] = (),
                             max_k: int = 5, restarts: int = 10, seed: int = 42):
    """End-to-end representative selection (M4).

    Returns ``(clusters, representatives, rows)``: the de-duplicated points
    with their cluster, one representative per cluster with ``num_obs``, and
    every input row of the representatives tagged with its cluster.
    ``mode='columnwise_max'`` reproduces the source's column-wise maximum;
    ``'most_observed'`` picks the real location with most observations.

    ``group`` (e.g. a country or source-file column) clusters each group on its own, as the
    source does per input file: the group columns (null is a value) are keys of every step
    and of all three outputs, so the number of jobs does not grow with the groups.  Points
    with a null coordinate take no part there.
    """
    if mode not in ("columnwise_max", "most_observed"):
        raise ValueError(f"unknown mode {mode!r}")
    group = list(group)
    if group:
        key = "_group"
        data = data.withColumn(key, F.to_json(F.struct(*group)))    # equal for equal values, never null
        counts = (data.where(F.col(location).isNotNull()).groupBy(key, location)
                      .agg(F.count(F.lit(1)).alias("num_obs")))
        points = dedupe_points(data, [key, lat, long], [*order, location]).select(key, *group, location, lat, long)
        clusters = kmeans_by_group(points, key, [lat, long], max_k, restarts, seed)
        if mode == "columnwise_max":
            reps = cluster_columnwise_max(clusters, "cluster", [location, lat, long], [key, *group])
            reps = reps.join(counts, on=[key, location], how="left")
        else:
            reps = cluster_most_observed(clusters, counts, "cluster", location, [lat, long],
                                         group=[key, *group], on=[key])
        rows = data.join(reps.select(key, location, "cluster"), on=[key, location])
        rest = [c for c in data.columns if c not in (key, location, *group)]
        return (clusters.select(*group, "cluster", location, lat, long),
                reps.select(*group, "cluster", location, lat, long, "num_obs"),
                rows.select(*group, *([] if location in group else [location]), *rest, "cluster"))
    counts = obs_per_location(data, location)
    points = dedupe_points(data, [lat, long], [*order, location]).select(location, lat, long)
    clusters = kmeans_clusters(points, [lat, long], max_k=max_k, restarts=restarts,
                               seed=seed).select("cluster", location, lat, long)
    if mode == "columnwise_max":
        reps = cluster_columnwise_max(clusters, "cluster", [location, lat, long])
        reps = representative_counts(reps, counts, location)
    else:
        reps = cluster_most_observed(clusters, counts, "cluster", location, [lat, long])
    reps = reps.select("cluster", location, lat, long, "num_obs")
    rows = representative_rows(data, reps, location, "cluster")
    return clusters, reps, rows
