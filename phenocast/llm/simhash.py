"""SimHash near-duplicates with a generalised pigeonhole join (operator 5).

Fingerprint of a text: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, shingles of
``shingle`` words joined by one space with repeats (fewer words: the whole
sequence, none: fingerprint zero), XXH64 with seed 42 of each; a bit is one if it
is set in over half of the hashes.

Equal fingerprints are folded first, so a group of exact copies is one row from
there on.  The distinct fingerprints are joined at ``max_bits`` differing bits:

1. correlated bits are grouped into ``parts`` partitions (correlations over all
   fingerprints, summed as one 64 x 64 matrix);
2. thresholds t_i >= -1 with sum ``max_bits - parts + 1`` are allocated by dynamic
   programming on the candidates that each (partition, threshold) is expected to
   give, counted on histograms of the partition values; -1 leaves a partition
   out.  Two fingerprints within ``max_bits`` bits differ in at most t_i bits in
   some partition i, whatever the allocation;
3. every fingerprint is indexed by its values and probes all values within t_i
   bits; each bucket is verified with the full bit distance.

A bucket emits the edges of a spanning forest of its links, never all pairs.  A
bucket over ``bucket_rows`` rows is not solved in one task but in tiles, each with two
of its slices, so that memory stays bounded and every pair still meets.

Defined results: null and empty texts have fingerprint zero and link like any
other; repeated rows get equal results; a null id takes part but is never the
smallest id of a component unless all ids of it are null; an empty table gives an
empty result; other columns are passed by.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenocast.llm._common import few, released, shuffle_partitions, slices, table, utf8, written
from phenocast.llm.components import connected_components

_BITS = np.arange(64, dtype=np.uint64)


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    ws = utf8(text).lower().split()
    if not ws:
        return 0
    buf, n = b" ".join(ws), max(len(ws) - shingle + 1, 1)
    sizes = np.fromiter(map(len, ws), dtype=np.int64, count=len(ws))
    stop = np.cumsum(sizes + 1) - 1
    start = stop - sizes
    width = min(shingle, len(ws)) - 1
    h = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for lo in range(0, n, 65536):  # bounded memory in very long texts
        hi = min(n, lo + 65536)
        hashes = np.array([h(buf[a:b], seed) for a, b in zip(start[lo:hi].tolist(), stop[lo + width:hi + width].tolist())],
                          dtype=np.uint64)
        ones += _bit_counts(hashes)
    return int((np.uint64(1) << _BITS)[2 * ones > n].sum(dtype=np.uint64))


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set."""
    out = np.zeros(64, dtype=np.int64)
    for lo in range(0, len(hashes), 8192):
        bits = np.unpackbits(hashes[lo:lo + 8192].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        out += bits.sum(axis=0, dtype=np.int64)
    return out


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text", hashed: bool = False) -> DataFrame:
    """(id, fp): the fingerprint of every row, as a signed long; ``hashed`` adds ``th``, Spark's hash of its text."""
    more = ["th"] if hashed else []

    def run(batches):
        for batch in batches:
            for some in slices(batch, 1):
                fps = np.array([fingerprint(t, shingle) for t in some.column(1).to_pylist()], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([some.column(0).cast(pa.int64()), pa.array(fps.view(np.int64), pa.int64()), *some.columns[2:]],
                                                 names=["id", "fp", *more])

    return (docs.select(F.col(id_col).cast("bigint"), F.col(text_col), *[F.xxhash64(text_col).alias(c) for c in more])
            .mapInArrow(released(run), ", ".join(f"{c} bigint" for c in ["id", "fp", *more])))


# --- partitions and thresholds ---------------------------------------------------------------

def bit_correlations(fps: DataFrame) -> np.ndarray:
    """Absolute correlation of every two bits, from one 65 x 64 sum per task."""
    def run(batches):
        s = np.zeros((65, 64))
        for batch in batches:
            x = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8").view(np.uint8).reshape(-1, 8)
            for lo in range(0, len(x), 65536):
                bits = np.unpackbits(x[lo:lo + 65536], axis=1, bitorder="little").astype(np.float32)
                s[:64] += bits.T @ bits
                s[64] += len(bits)
        i, j = np.indices(s.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(s.ravel())], names=["i", "j", "s"])

    rows = fps.select("fp").mapInArrow(run, "i bigint, j bigint, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    s = np.zeros((65, 64))
    for r in rows:  # 65 x 64 rows
        s[r["i"], r["j"]] = r["s"]
    n = max(s[64, 0], 1.0)
    mean = np.diag(s[:64]) / n
    cov = s[:64] / n - np.outer(mean, mean)
    sd = np.sqrt(np.maximum(np.diag(cov), 0))
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.nan_to_num(np.abs(cov / np.outer(sd, sd)))


def bit_partitions(corr: np.ndarray, parts: int) -> list[list[int]]:
    """Bits dealt into ``parts`` partitions of like width, correlated ones together."""
    left, out = set(range(len(corr))), []
    for k in range(parts):
        width = -(-len(left) // (parts - k))
        seed = max(sorted(left), key=lambda b: sum(corr[b][c] for c in left if c != b))
        group = [seed]
        left.remove(seed)
        while len(group) < width:
            best = max(sorted(left), key=lambda b: sum(corr[b][c] for c in group))
            group.append(best)
            left.remove(best)
        out.append(sorted(group))
    return out


def allocate_thresholds(cost: list[list[float]], max_bits: int) -> list[int]:
    """t_i in -1..max_bits with sum ``max_bits - parts + 1`` and the least total of
    ``cost[i][t_i + 1]``, by dynamic programming over the partitions."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in cost:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for total, (c, ts) in best.items():
            for t in range(-1, max_bits + 1):
                got = (c + row[t + 1], [*ts, t])
                if total + t not in nxt or got < nxt[total + t]:
                    nxt[total + t] = got
        best = nxt
    return best[max_bits - len(cost) + 1][1]


def gather(fp, bits: list[int]):
    """Column: the given bits of ``fp``, packed into a long."""
    out = F.lit(0).cast("long")
    for k, b in enumerate(bits):
        out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, b).bitwiseAND(F.lit(1).cast("long")), k))
    return out


def candidate_costs(fps: DataFrame, parts: list[list[int]], max_bits: int, bins: int = 16) -> list[list[float]]:
    """Expected candidates of each (partition, threshold), from histograms of the
    values.  A histogram keeps the first ``bins`` bits of a partition (at most
    2^bins counts each); the other bits are taken as independent."""
    one = fps.select(F.posexplode(F.array(*[gather(F.col("fp"), p[:bins]) for p in parts])).alias("part", "value"))
    rows = one.groupBy("part", "value").count().toPandas()
    ones = fps.agg(*[F.avg(F.shiftrightunsigned("fp", b).bitwiseAND(F.lit(1).cast("long"))).alias(f"b{b}") for b in range(64)]).first()
    out = []
    for k, bits in enumerate(parts):
        w = min(bins, len(bits))
        hist = np.zeros(1 << w)
        mine = rows[rows["part"] == k]
        hist[mine["value"].to_numpy(dtype=np.int64)] = mine["count"].to_numpy()
        # equal[d]: expected pairs that differ in d of the partition's bits
        dist = np.zeros(max_bits + 1)
        at = np.arange(1 << w)
        shells: list[list[int]] = [[0]]
        for _ in range(max_bits):
            shells.append(sorted({m | (1 << i) for m in shells[-1] for i in range(w) if not m >> i & 1}))
        for d, masks in enumerate(shells):
            dist[d] = sum(float(hist @ hist[at ^ m]) for m in masks)
        for b in bits[bins:]:
            p = ones[f"b{b}"] or 0.0
            same = p * p + (1 - p) * (1 - p)
            dist[1:] = dist[1:] * same + dist[:-1] * (1 - same)
            dist[0] *= same
        out.append([0.0, *np.cumsum(dist).tolist()])
    return out


# --- buckets ---------------------------------------------------------------------------------

def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges (larger index to smaller) of a spanning forest of the links in a bucket."""
    root = list(range(len(fps)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    step = max(1, 2_000_000 // max(len(fps), 1))
    for lo in range(0, len(fps), step):
        x = fps[lo:lo + step]
        i, j = np.nonzero(_popcount(x[:, None] ^ fps[None, lo:]) <= max_bits)
        i, j = i[i < j], j[i < j]
        for a, b in zip((i + lo).tolist(), (j + lo).tolist()):
            ra, rb = find(a), find(b)
            if ra != rb:
                root[max(ra, rb)] = min(ra, rb)
                out.append((a, b))
    return out


def _probes(part: int, width: int, t: int):
    """Column: keys of all values within t bits of this partition's value."""
    masks = {0}
    for _ in range(t):
        masks |= {m ^ (1 << i) for m in masks for i in range(width)}
    return F.transform(F.array(*[F.lit(m).cast("long") for m in sorted(masks)]),
                       lambda m: F.xxhash64(F.lit(part), F.col(f"v{part}").bitwiseXOR(m)))


def near_links(fps: DataFrame, max_bits: int = 2, parts: int | None = None, bucket_rows: int = 4096) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) that leave the
    components of all pairs within ``max_bits`` bits as they are."""
    parts = parts or max_bits + 1
    bits = bit_partitions(bit_correlations(fps), parts)
    taus = allocate_thresholds(candidate_costs(fps, bits, max_bits), max_bits)
    probed = [k for k, t in enumerate(taus) if t >= 0]
    values = fps.select("fp", *[gather(F.col("fp"), bits[k]).alias(f"v{k}") for k in probed])
    rows = values.select("fp", F.explode(F.flatten(F.array(*[_probes(k, len(bits[k]), taus[k]) for k in probed]))).alias("key"))
    n = rows.groupBy("key").count()
    big = written(n.where(F.col("count") > bucket_rows).select("key", F.ceil(F.col("count") / bucket_rows).alias("slices")), "simhash-hot")
    if big.isEmpty():
        return _solve(rows, max_bits)
    # every two slices of a large bucket meet in one tile
    tiles = (rows.join(big, "key").withColumn("slice", F.pmod(F.xxhash64("fp"), F.col("slices")))
             .select("fp", "key", "slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("other"))
             .select(F.xxhash64("key", F.least("slice", "other"), F.greatest("slice", "other")).alias("key"), "fp"))
    return _solve(rows.join(big, "key", "left_anti").select("fp", "key").unionByName(tiles), max_bits)


def _solve(rows: DataFrame, max_bits: int) -> DataFrame:
    """Verified forest edges of each bucket; buckets of a task are solved one by one."""
    def run(batches):
        key, held = None, []
        for batch in batches:
            ks, fs = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            edges = np.flatnonzero(np.concatenate(([True], ks[1:] != ks[:-1]))) if len(ks) else []
            bounds = [*edges, len(ks)]
            got = []
            for a, b in zip(bounds, bounds[1:]):
                if ks[a] != key:
                    got += done(held)
                    key, held = ks[a], []
                held.append(fs[a:b])
            if got:
                yield pack(got)
        if got := done(held):
            yield pack(got)

    def done(held):
        if not held:
            return []
        x = np.unique(np.concatenate(held))
        if len(x) < 2:
            return []
        return [(int(x[a]), int(x[b])) for a, b in _forest(x.view(np.uint64), max_bits)]

    def pack(got):
        a, b = zip(*got)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    n = shuffle_partitions(rows.sparkSession)
    return rows.select("key", "fp").repartition(n, "key").sortWithinPartitions("key").mapInArrow(run, "a bigint, b bigint")


def _rooted(firsts: DataFrame, max_bits: int, bucket_rows: int = 4096) -> DataFrame:
    """``firsts`` (one row a fingerprint) with ``root``, the same for all of a component."""
    roots = connected_components(near_links(firsts.select("fp"), max_bits, bucket_rows=bucket_rows))
    return firsts.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def simhash_components(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id",
                       text_col: str = "text", bucket_rows: int = 4096) -> DataFrame:
    """(doc_id, fingerprint, component_id): see the module text."""
    fps = written(fingerprints(docs, shingle, id_col, text_col), "simhash-fp")
    firsts = written(fps.groupBy("fp").agg(F.min("id").alias("first")), "simhash-distinct")
    of = _rooted(firsts, max_bits, bucket_rows)
    low = of.groupBy("root").agg(F.min("first").alias("component_id"))
    of = of.join(low, "root").select("fp", "component_id")
    return (join_back(fps, of, "fp")
            .select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def join_back(rows: DataFrame, lookup: DataFrame, key: str, share: int = 256) -> DataFrame:
    """``rows`` joined to the one ``lookup`` row of their key, without a hot task.

    Keys with over 1/``share`` of the rows (so fewer than ``share`` of them) are
    joined by broadcast, the rest by a shuffle.
    """
    counts = rows.groupBy(key).count()
    total = rows.count()
    hot = [r[0] for r in counts.where(F.col("count") * share > total).select(key).collect()]  # under `share` keys
    if not hot:
        return rows.join(lookup, key)
    cold = rows.where(~F.col(key).isin(hot)).join(lookup, key)
    warm = rows.where(F.col(key).isin(hot)).join(F.broadcast(lookup.where(F.col(key).isin(hot))), key)
    return cold.unionByName(warm.select(*cold.columns))


def near_dedup(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id, nulls
    last, then text hash (of rows that repeat in id and text, one)."""
    fps = written(fingerprints(docs, shingle, id_col, text_col, hashed=True), "simhash-fp")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th")).alias("first")
    total = fps.count()
    firsts = written(few(fps.groupBy("fp").agg(first), total), "simhash-distinct")
    low = _rooted(firsts, max_bits).groupBy("root").agg(F.min("first").alias("first"))
    keep = written(few(low.select(F.col("first.id").alias("id"), F.col("first.th").alias("th")), total), "simhash-keep")
    tag = uuid.uuid4().hex              # helper columns that no column of ``docs`` is named like
    key, at, kept_id, kept_at = (f"{c}_{tag}" for c in ("id", "hash", "kept", "kept_hash"))
    keep = keep.select(F.col("id").alias(kept_id), F.col("th").alias(kept_at))
    rows = fps.groupBy("id", "th").count().where("count > 1")
    repeated = not rows.join(keep, F.col("id").eqNullSafe(F.col(kept_id)) & (F.col("th") == F.col(kept_at)), "left_semi").isEmpty()
    kept = (docs.withColumns({key: F.col(id_col).cast("bigint"), at: F.xxhash64(text_col)})
            .join(keep, F.col(key).eqNullSafe(F.col(kept_id)) & (F.col(at) == F.col(kept_at)), "left_semi"))
    return (kept.dropDuplicates([key, at]) if repeated else kept).drop(key, at)


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))
