"""Per-feature isolation forests.

A forest per feature: ``trees`` trees, each on ``sample`` rows drawn by key hash from a pool
of the ``pool`` rows with the least hashes, a bounded sample whatever the table's size.  A
node with different values splits at a hash-drawn point between its least and largest value,
down to the depth log2(sample); a value's path length is its leaf's depth plus the mean depth
of an unbuilt tree over the leaf's rows.  A tree over one feature cuts the line into
intervals, so a forest is a step function: the leaves' lengths added up along the cuts.

Growing is a chain of windows over (feature, tree, node), at most ``sample`` rows each; the
step functions, at most ``trees * sample`` steps a feature, go to the tasks that score.  Path
lengths are whole multiples of 2^-20, so they add up alike in any order.  The share
``contamination`` with the shortest paths is flagged by an exact order statistic; ties are
never split, and the shortest paths not below it stay.
"""

from __future__ import annotations

import math
import sys
import uuid
from typing import Sequence

import numpy as np
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phenocast.functions.numeric import hash64
from phenocast.functions.quantiles import kth_smallest_many

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # executors need no copy of it

TREES, SAMPLE, POOL, SEED = 100, 256, 5120, 42
UNIT = 1 << 20


def unbuilt_depths(sample: int = SAMPLE) -> list[int]:
    """Mean depth of an unbuilt tree over 0, 1, ..., ``sample`` rows, in units of 2^-20."""
    def depth(n: int) -> float:
        if n <= 1:
            return 0.0
        return 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n

    return [round(depth(n) * UNIT) for n in range(sample + 1)]


def max_depth(sample: int = SAMPLE) -> int:
    return max(1, math.ceil(math.log2(max(sample, 2))))


def forest_leaves(df: DataFrame, cols: Sequence[str], keys: Sequence[str], trees: int = TREES, sample: int = SAMPLE, pool: int = POOL,
                  seed: int = SEED) -> DataFrame:
    """(feature, tree, node, low, high, n, depth): leaves of all forests, of values in (low, high].

    ``feature`` is the column's position.  A missing value is no point of a sample.
    """
    rows = df.select(hash64(keys, seed).alias("h"),
                     F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("key"),
                     *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    # a threshold on the hash first, so that a large table's partitions send few rows to be ordered
    share = min(1.0, 3 * pool / max(df.count(), 1))
    values = [f"x{i}" for i in range(len(cols))]            # tell rows with equal keys apart
    rows = rows.where(F.col("h") <= int(share * (1 << 60))).orderBy("h", "key", *values).limit(pool)       # bounded: one task may hold it
    drawn = (rows.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
             .withColumn("o", hash64(["key", "tree"], seed))
             .withColumn("rn", F.row_number().over(Window.partitionBy("tree").orderBy("o", "key", *values))).where(F.col("rn") <= sample))
    points = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(f"x{i}").alias("x")) for i in range(len(cols))])
    at = (drawn.select("tree", F.explode(points).alias("p")).select("p.feature", "tree", "p.x").where(F.col("x").isNotNull() & ~F.isnan("x"))
          .repartition("feature", "tree")
          .withColumns({"node": F.lit(1).cast("bigint"), "depth": F.lit(0), "low": F.lit(float("-inf")), "high": F.lit(float("inf"))}))
    w = Window.partitionBy("feature", "tree", "node")
    for _ in range(max_depth(sample)):
        at = at.withColumns({"lo": F.min("x").over(w), "hi": F.max("x").over(w)})
        at = at.withColumn("cut", F.col("lo") + (F.col("hi") - F.col("lo")) * (hash64(["feature", "tree", "node"], seed).cast("double") / F.lit(float(1 << 60))))
        at = at.withColumn("cut", F.when(F.col("cut") >= F.col("hi"), F.col("lo")).otherwise(F.col("cut")))
        inner, right = F.col("lo") < F.col("hi"), F.col("x") > F.col("cut")
        at = at.select("feature", "tree", "x", F.when(inner, 2 * F.col("node") + right.cast("int")).otherwise(F.col("node")).alias("node"),
                       (F.col("depth") + inner.cast("int")).alias("depth"), F.when(inner & right, F.col("cut")).otherwise(F.col("low")).alias("low"),
                       F.when(inner & ~right, F.col("cut")).otherwise(F.col("high")).alias("high"))
    return at.groupBy("feature", "tree", "node").agg(F.min("low").alias("low"), F.min("high").alias("high"), F.count(F.lit(1)).alias("n"),
                                                     F.min("depth").alias("depth"))


def path_steps(leaves: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(feature, above, path): the added-up path length of values in (above, next above]."""
    unbuilt = F.array(*[F.lit(x).cast("bigint") for x in unbuilt_depths(sample)])
    length = F.col("depth").cast("bigint") * UNIT + F.element_at(unbuilt, F.col("n").cast("int") + 1)
    sized = leaves.select("feature", "low", "high", length.alias("d"))
    changes = sized.select("feature", F.col("low").alias("above"), "d").unionAll(sized.select("feature", F.col("high").alias("above"), -F.col("d")))
    changes = changes.groupBy("feature", "above").agg(F.sum("d").alias("d"))
    along = Window.partitionBy("feature").orderBy("above").rowsBetween(Window.unboundedPreceding, 0)        # at most trees * sample rows
    return changes.withColumn("path", F.sum("d").over(along)).where(F.col("above") < float("inf")).select("feature", "above", "path")


def isolation_paths(df: DataFrame, cols: Sequence[str], keys: Sequence[str], trees: int = TREES, sample: int = SAMPLE, pool: int = POOL,
                    seed: int = SEED, suffix: str = "_path") -> DataFrame:
    """``df`` with each value's path length added up over its forest's trees, in units of 2^-20.

    A missing value, and any value of a column without a sample, has no path (NULL).
    """
    cols = list(cols)
    steps: dict = {}
    for r in path_steps(forest_leaves(df, cols, keys, trees, sample, pool, seed), sample).orderBy("feature", "above").collect():
        steps.setdefault(r["feature"], []).append((r["above"], r["path"]))
    tables = {f: (np.array([a for a, _ in s]), np.array([p for _, p in s], dtype=np.int64)) for f, s in steps.items()}
    present = [i for i in range(len(cols)) if i in tables]
    if not present:
        return df.withColumns({c + suffix: F.lit(None).cast("bigint") for c in cols})
    fields = ", ".join(f"x{i} bigint" for i in present)

    @F.pandas_udf(fields)
    def paths(x):
        import pandas as pd
        out = {}
        for i in present:
            above, path = tables[i]
            v = x[f"x{i}"].to_numpy(dtype=np.float64)
            gap = np.isnan(v)
            p = path[np.maximum(np.searchsorted(above, np.where(gap, 0.0, v), side="left") - 1, 0)]
            out[f"x{i}"] = pd.Series(p).astype("Int64").mask(gap)
        return pd.DataFrame(out)

    scored = paths(F.struct(*[F.col(cols[i]).cast("double").alias(f"x{i}") for i in present]))
    tag = f"_{uuid.uuid4().hex}"
    return df.withColumn(tag, scored).select(*df.columns, *[(F.col(f"{tag}.x{i}") if i in tables else F.lit(None).cast("bigint")).alias(c + suffix)
                                                            for i, c in enumerate(cols)])


def anomaly_score(path: Column, trees: int = TREES, sample: int = SAMPLE) -> Column:
    """Score in (0, 1], near 1 for values that are isolated early."""
    return F.pow(F.lit(2.0), -path.cast("double") / F.lit(float(trees * unbuilt_depths(sample)[sample])))


def isolation_flags(df: DataFrame, cols: Sequence[str], keys: Sequence[str], contamination: float = 0.05, trees: int = TREES, sample: int = SAMPLE,
                    pool: int = POOL, seed: int = SEED, suffix: str = "_outlier", keep_paths: bool = False) -> DataFrame:
    """``df`` with a flag for each feature's anomalies: of n values those with a path shorter than
    the one at rank floor(contamination * n).  A missing value is never flagged."""
    cols = list(cols)
    scored = isolation_paths(df, cols, keys, trees, sample, pool, seed)
    src = scored.select(*[f"{c}_path" for c in cols]).persist(StorageLevel.MEMORY_AND_DISK)
    cuts = kth_smallest_many(src, [(f"{c}_path", lambda n: min(int(math.floor(contamination * n)), n - 1)) for c in cols])
    src.unpersist()
    flags = {c + suffix: F.coalesce(F.col(f"{c}_path") < F.lit(cut), F.lit(False)) if cut is not None else F.lit(False) for c, cut in zip(cols, cuts)}
    out = scored.withColumns(flags)
    return out if keep_paths else out.drop(*[f"{c}_path" for c in cols])


def oracle_sql(source: str, cols: Sequence[str], keys: Sequence[str], contamination: float = 0.05) -> str:
    """CTEs of the same forests and flags for DuckDB; the last, ``flags``, has the keys, paths and flags."""
    key = "concat_ws('|', " + ", ".join(f"CAST({k} AS VARCHAR)" for k in keys) + ")"
    h = lambda *parts: f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(parts)}, '{SEED}')), 1, 15) AS BIGINT)"
    values = ", ".join(f"x{i} NULLS FIRST" for i in range(len(cols)))
    out = [f"""pool AS (SELECT {key} AS key, {', '.join(f'CAST({c} AS DOUBLE) AS x{i}' for i, c in enumerate(cols))} FROM {source}
  ORDER BY {h(*[f'CAST({k} AS VARCHAR)' for k in keys])}, key, {values} LIMIT {POOL})""",
           f"""drawn AS (SELECT * FROM pool, (SELECT unnest(range(0, {TREES})) AS tree) t
  QUALIFY row_number() OVER (PARTITION BY tree ORDER BY {h('key', 'CAST(tree AS VARCHAR)')}, key, {values}) <= {SAMPLE})""",
           "l0 AS (" + " UNION ALL ".join(f"SELECT {i} AS f, tree, x{i} AS x, CAST(1 AS BIGINT) AS node, 0 AS depth, CAST('-inf' AS DOUBLE) AS low, "
                                          f"CAST('inf' AS DOUBLE) AS high FROM drawn WHERE x{i} IS NOT NULL" for i in range(len(cols))) + ")"]
    for k in range(max_depth()):
        u = f"CAST({h('CAST(f AS VARCHAR)', 'CAST(tree AS VARCHAR)', 'CAST(node AS VARCHAR)')} AS DOUBLE) / CAST({1 << 60} AS DOUBLE)"
        out.append(f"""l{k + 1} AS (
  SELECT f, tree, x, CASE WHEN lo < hi THEN 2 * node + CASE WHEN x > cut THEN 1 ELSE 0 END ELSE node END AS node, depth + CASE WHEN lo < hi THEN 1 ELSE 0 END AS depth,
         CASE WHEN lo < hi AND x > cut THEN cut ELSE low END AS low, CASE WHEN lo < hi AND x <= cut THEN cut ELSE high END AS high
  FROM (SELECT *, CASE WHEN c >= hi THEN lo ELSE c END AS cut FROM (
    SELECT *, lo + (hi - lo) * ({u}) AS c FROM (
      SELECT *, min(x) OVER w AS lo, max(x) OVER w AS hi FROM l{k} WINDOW w AS (PARTITION BY f, tree, node)) a) b) d)""")
    sizes = "[" + ", ".join(map(str, unbuilt_depths())) + "]"
    out.append(f"""leaves AS (SELECT f, min(low) AS low, min(high) AS high, min(depth) * {UNIT} + CAST({sizes}[count(*) + 1] AS BIGINT) AS d
  FROM l{max_depth()} GROUP BY f, tree, node)""")
    out.append("""steps AS (SELECT f, above, sum(d) OVER (PARTITION BY f ORDER BY above) AS path FROM (
  SELECT f, above, sum(d) AS d FROM (SELECT f, low AS above, d FROM leaves UNION ALL SELECT f, high, -d FROM leaves) e GROUP BY f, above) g)""")
    asof = " ".join(f"ASOF LEFT JOIN (SELECT above, path FROM steps WHERE f = {i}) p{i} ON CAST(s.{c} AS DOUBLE) > p{i}.above" for i, c in enumerate(cols))
    out.append(f"paths AS (SELECT {', '.join(f's.{k}' for k in keys)}, {', '.join(f'CAST(p{i}.path AS BIGINT) AS path{i}' for i in range(len(cols)))} FROM {source} s {asof})")
    for i in range(len(cols)):
        out.append(f"c{i} AS (SELECT max(path{i}) AS cut FROM (SELECT path{i}, row_number() OVER (ORDER BY path{i}) AS rn, count(*) OVER () AS n FROM paths WHERE path{i} IS NOT NULL) t "
                   f"WHERE rn = least(CAST(floor(CAST({contamination} AS DOUBLE) * n) AS BIGINT), n - 1) + 1)")
    what = ", ".join(f"path{i} AS {c}_path, coalesce(path{i} < (SELECT cut FROM c{i}), false) AS {c}_outlier" for i, c in enumerate(cols))
    out.append(f"flags AS (SELECT {', '.join(keys)}, {what} FROM paths)")
    return ",\n".join(out)
