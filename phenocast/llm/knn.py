"""Exact top-k search by inner product with a Voronoi join (operator 1).

Vectors are turned into integers, floor(scale * x) for each component x as a double,
and compared by their integer inner product.

1. Pivots: ``n_pivots`` vectors, those whose id hashes lowest (a bounded number,
   shared with every task).  Every vector belongs to the cell of its nearest pivot.
2. Summaries per cell: number of vectors, largest distance to the pivot and norms;
   of the queries' groups (a cell's queries) the same.
3. Bounds: a group's threshold is the k-th best score that its queries are sure to
   reach: a lower bound from the cells' summaries, raised by what each query
   really reaches among the vectors of its own cell.
4. A vector is sent to the groups whose threshold it may reach: with q in a group of
   pivot p and radius r, and x in a cell of pivot c, q.x <= p.x + s + r|x - c|, where s
   is the largest (q - p).c of the group, a summary of one number a group and cell,
   and p.x is computed exactly.
5. Each group is solved locally in pieces of bounded size (queries and candidates
   are both dealt into slices), and the pieces' best k are merged.

All bounds are rounded outward, so the result is exact.  How much step 4 saves depends
on how clustered the data are; without clusters no bound from summaries saves much.

Defined results: a vector that is null or holds a null or non-finite component takes
no part; an empty vector is a zero vector, a shorter one is filled with zeros;
ties go to the smaller id; rows with a null id take no part; of rows that repeat an
id, each is a candidate, a query's own id never is, and a repeated query is answered
once, for the least of its vectors, compared component by component; an empty table gives an empty result; other columns are passed by.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from phenocast.llm._common import table, written

_EPS = 1e-6


def integer_vectors(vectors: DataFrame, scale: float = 64.0, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v array<double>) of the vectors that take part."""
    x = F.col(vec_col)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return (vectors.where(F.col(id_col).isNotNull() & x.isNotNull() & ~bad)
            .select(F.col(id_col).cast("bigint").alias("vec_id"), F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("double")).alias("v")))


def _matrix(column, dim: int) -> np.ndarray:
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == dim).all():
        return flat.reshape(len(sizes), dim)
    out = np.zeros((len(sizes), dim))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products: exact in doubles while no sum can pass 2^53."""
    top = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1]
    if top < 2.0 ** 53:
        return (q @ x.T).astype(np.int64)
    return q.astype(np.int64) @ x.astype(np.int64).T


def _best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int):
    """Of each row: positions of the k best candidates that are not its own id."""
    for row, mine in zip(scores, own):
        ok = np.flatnonzero(ids != mine)
        if len(ok) > k:
            cut = np.partition(row[ok], len(ok) - k)[len(ok) - k]
            ok = ok[row[ok] >= cut]
        yield ok[np.lexsort((ids[ok], -row[ok]))][:k]


def top_k(vectors: DataFrame, is_query, k: int = 20, scale: float = 64.0, n_pivots: int = 64, slice_rows: int = 4096,
          id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of every row where ``is_query`` (a
    condition on ``vec_id``) holds, among all rows but its own."""
    data = written(integer_vectors(vectors, scale, id_col, vec_col), "knn-vectors")
    seeds = data.orderBy(F.xxhash64("vec_id", "v")).limit(n_pivots).collect()  # n_pivots rows
    spark = data.sparkSession
    if not seeds:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    dim = max(data.agg(F.max(F.size("v"))).first()[0], 1)
    pivots = np.zeros((len(seeds), dim))
    for i, r in enumerate(seeds):
        pivots[i, :len(r["v"])] = r["v"]
    pivots = np.unique(pivots, axis=0)

    def assign(batches):
        half = (pivots * pivots).sum(axis=1) / 2
        for batch in batches:
            x = _matrix(batch.column(1), dim)
            cell = np.argmin(half - x @ pivots.T, axis=1) if len(x) else np.zeros(0, dtype=np.int64)
            away = np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell, pa.int32()), pa.array(away),
                                              pa.array(np.sqrt((x * x).sum(axis=1)))], names=["vec_id", "v", "cell", "away", "norm"])

    cells = written(data.mapInArrow(assign, "vec_id bigint, v array<double>, cell int, away double, norm double")
                    .withColumn("q", is_query), "knn-cells")
    # one row a pivot
    summary = {r["cell"]: r for r in cells.groupBy("cell").agg(
        F.count("*").alias("n"), F.max("away").alias("r"), F.max(F.when(F.col("q"), F.col("away"))).alias("qr"),
        F.count_if("q").alias("qn")).collect()}
    groups = sorted(c for c, r in summary.items() if r["qn"])
    if not groups:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    theta = _summary_bounds(pivots, summary, groups, k)

    # queries: one row an id, of different vectors under one id the least
    queries = (cells.where("q").groupBy("vec_id").agg(F.min(F.struct("v", "cell")).alias("x"))
               .select("vec_id", F.col("x.v").alias("v"), F.col("x.cell").alias("cell")))
    pieces = {c: max(1, -(-r["n"] // slice_rows)) for c, r in summary.items()}
    parts = {c: max(1, -(-r["qn"] // slice_rows)) for c, r in summary.items()}
    own = cells.select(F.col("cell").alias("grp"), "vec_id", "v")
    pilot = _solve(queries, own, pieces, parts, dim, k, kth_only=True)
    # the k-th best score within a query's own cell, least over the group; a query without k neighbours there keeps the summary's bound
    reached = pilot.groupBy("grp", "vec_id").agg(F.max("score").alias("s")) if max(pieces.values()) > 1 else pilot.select("grp", "vec_id", F.col("score").alias("s"))
    least = reached.groupBy("grp").agg(F.min("s").alias("s"), F.count("*").alias("n"))
    full = {r["grp"]: r for r in least.collect()}  # one row a group
    asked = {r["cell"]: r["n"] for r in queries.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    for g in groups:
        if g in full and full[g]["n"] == asked[g]:
            theta[g] = max(theta[g], float(full[g]["s"]))
    at = np.array(groups)
    need = np.array([theta[g] for g in groups])
    reach = np.array([summary[g]["qr"] for g in groups])

    def lean(batches):
        for batch in batches:
            q, cell = _matrix(batch.column(0), dim), batch.column(1).to_numpy(zero_copy_only=False)
            for g in np.unique(cell):
                most = ((q[cell == g] - pivots[g]) @ pivots.T).max(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(most), g), pa.int32()), pa.array(np.arange(len(most)), pa.int32()), pa.array(most)],
                                                 names=["grp", "cell", "s"])

    side = np.full((len(pivots), len(pivots)), -np.inf)
    for r in queries.select("v", "cell").mapInArrow(lean, "grp int, cell int, s double").groupBy("grp", "cell").agg(F.max("s").alias("s")).collect():
        side[r["grp"], r["cell"]] = r["s"]  # a row a pair of pivots
    side = side[at]

    def replicate(batches):
        for batch in batches:
            x, cell, away = _matrix(batch.column(1), dim), batch.column(2).to_numpy(), batch.column(3).to_numpy()
            bound = x @ pivots[at].T + side[:, cell].T + reach[None, :] * away[:, None]
            row, g = np.nonzero(bound + _EPS * (1 + np.abs(bound)) >= need[None, :])
            for lo in range(0, len(row), 20_000):
                take = pa.array(row[lo:lo + 20_000])
                yield pa.RecordBatch.from_arrays([pa.array(at[g[lo:lo + 20_000]], pa.int32()), batch.column(0).take(take), batch.column(1).take(take)],
                                                 names=["grp", "vec_id", "v"])

    sent = written(cells.select("vec_id", "v", "cell", "away").mapInArrow(replicate, "grp int, vec_id bigint, v array<double>"), "knn-candidates")
    sizes = {r["grp"]: r["n"] for r in sent.groupBy("grp").agg(F.count("*").alias("n")).collect()}  # one row a group
    pieces = {g: max(1, -(-sizes.get(g, 0) // slice_rows)) for g in groups}
    found = _solve(queries, sent, pieces, parts, dim, k)
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.select(F.col("vec_id").alias("query_id"), F.col("cand").alias("vec_id"), "score")
            .withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))


def _summary_bounds(pivots: np.ndarray, summary: dict, groups: list[int], k: int) -> dict[int, float]:
    """Lower bound of each group's k-th best score: q.x >= p.c - r_q|c| - |p|r - r_q r for
    a query in the group of pivot p and a vector in the cell of pivot c."""
    out = {}
    norm = np.sqrt((pivots * pivots).sum(axis=1))
    for g in groups:
        rq = summary[g]["qr"]
        low = sorted(((float(pivots[g] @ pivots[c] - rq * norm[c] - norm[g] * r["r"] - rq * r["r"]), r["n"]) for c, r in summary.items()), reverse=True)
        left, bound = k + 1, -np.inf  # one of them may be the query itself
        for b, n in low:
            left -= n
            if left <= 0:
                bound = b - _EPS * (1 + abs(b))
                break
        out[g] = bound
    return out


def _solve(queries: DataFrame, candidates: DataFrame, pieces: dict[int, int], parts: dict[int, int], dim: int, k: int,
           kth_only: bool = False) -> DataFrame:
    """Best k of each query within each piece of its group's candidates, or only the
    k-th score where a piece has that many.  A group is dealt into pieces x parts."""
    def spread(of: dict[int, int]):
        return F.element_at(F.create_map(*[F.lit(x) for g, n in sorted(of.items()) for x in (g, n)]), F.col("grp"))

    def slot(n):
        return F.pmod(F.xxhash64("vec_id", "v"), n).cast("int")

    qs = (queries.select(F.col("cell").alias("grp"), "vec_id", "v")
          .withColumn("part", slot(spread(parts))).withColumn("piece", F.explode(F.sequence(F.lit(0), spread(pieces) - 1))))
    cs = (candidates.where(F.col("grp").isin(sorted(pieces)))
          .withColumn("piece", slot(spread(pieces))).withColumn("part", F.explode(F.sequence(F.lit(0), spread(parts) - 1)))
          .select("grp", "piece", "part", F.col("vec_id").alias("cand"), F.col("v").alias("x")))

    def run(_, left, right):
        def col(t, name):
            return t.column(name).combine_chunks()

        if not left.num_rows or not right.num_rows:
            return pa.table({"grp": pa.array([], pa.int32()), "vec_id": pa.array([], pa.int64()), "cand": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        qi, ci = col(left, "vec_id").to_numpy(), col(right, "cand").to_numpy()
        q, x = _matrix(col(left, "v"), dim), _matrix(col(right, "x"), dim)
        who, cand, score = [], [], []
        for lo in range(0, len(qi), 256):
            s = _scores(q[lo:lo + 256], x)
            for i, best in enumerate(_best(s, ci, qi[lo:lo + 256], k)):
                if kth_only:
                    best = best[k - 1:]
                who.append(np.full(len(best), qi[lo + i]))
                cand.append(ci[best])
                score.append(s[i, best])
        who, cand, score = (np.concatenate(c) for c in (who, cand, score))
        grp = left.column("grp")[0].as_py()
        return pa.table({"grp": pa.array(np.full(len(who), grp), pa.int32()), "vec_id": pa.array(who, pa.int64()),
                         "cand": pa.array(cand, pa.int64()), "score": pa.array(score, pa.int64())})

    key = ["grp", "piece", "part"]
    return (qs.groupBy(*key).cogroup(cs.groupBy(*key))
            .applyInArrow(run, "grp int, vec_id bigint, cand bigint, score bigint"))


def op1_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


OP1_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id AS vec_id, CAST(list_inner_product(q.e, d.e) AS BIGINT) AS score
      FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""
