"""Gradient-boosted regression trees with the source's settings.

MLlib's boosting lacks the huber and quantile losses, ``min_samples_split``,
``max_leaf_nodes``, ``ccp_alpha``, ``warm_start`` and staged scores.  This learner grows trees
on histograms and trains any number of fits side by side: one Spark job finds the splits of
one level of the next tree of *all* fits, so a search pays the jobs of one ensemble.

Rows are binned once, packed into written blocks of bounded size and dealt out as a kept RDD of
NumPy arrays.  A task walks its blocks and adds up counts and residual sums per (node, feature,
bin) of each fit; the tables of the tasks, whose size is set by the settings and not by the
rows, are added up (by a shuffle where they are large) and the driver, which keeps the trees,
chooses the splits.  What the predictions of each fit leave of the rows' labels lies beside their
block, and is checkpointed every ``CHECKPOINT_TREES`` trees, so a lost executor repeats little work.

Row samples, folds and validation rows are key hashes and each node's feature subset is drawn
from (seed, tree, node): nothing depends on the layout of the rows but the last bits of sums.
Leaf values of the squared loss are means; of the absolute, quantile and huber losses exact
order statistics of the leaf's residuals, found by counting the leading bits of the numbers.
"""

from __future__ import annotations

import heapq
import json
import math
import sys
import uuid
from dataclasses import asdict, dataclass, field, fields, replace
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenocast.functions.numeric import hash64
from phenocast.session import ensure_checkpoint_dir, shared_scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # executors need no copy of it

BLOCK_ROWS = 8192
MAX_BINS = 64
CHECKPOINT_TREES = 25
TASK_ROWS = 1 << 15             # rows of a block in a task, several written blocks
PART_ROWS = 1 << 22             # rows of a task at most, about
DRIVER_NUMBERS = 1 << 23        # numbers of all tasks that the driver adds up itself
WHOLE_ROWS = 1 << 19            # rows of a table, at most, of which a search trains whole ensembles in a task
STATE_BYTES = 1 << 31           # predictions of the fits trained in lockstep, about, where there are more rows
_RADIX = 12                     # bits counted in a round of an order statistic
_FEW = 1024                     # values of a bracket that are fetched

# The losses' names in the source's library, by our names.
LOSSES = {"ls": "squared_error", "squared_error": "squared_error", "lad": "absolute_error", "absolute_error": "absolute_error",
          "huber": "huber", "quantile": "quantile"}
CRITERIA = {"friedman_mse": "friedman_mse", "mse": "squared_error", "squared_error": "squared_error"}


@dataclass(frozen=True)
class Setting:
    """One fit's settings, named and defaulted as in the source."""
    loss: str = "squared_error"
    alpha: float = 0.9                      # of the huber and quantile losses
    learning_rate: float = 0.1
    n_estimators: int = 100
    max_depth: int = 3
    min_samples_split: int = 2
    min_samples_leaf: int = 1
    min_weight_fraction_leaf: float = 0.0
    min_impurity_decrease: float = 0.0
    subsample: float = 1.0
    max_features: object = None             # None, "auto", "sqrt", "log2", share or number
    max_leaf_nodes: int | None = None
    criterion: str = "friedman_mse"
    ccp_alpha: float = 0.0
    init: str | None = None                 # None: the loss's best constant; "zero"
    n_iter_no_change: int | None = None
    validation_fraction: float = 0.1
    tol: float = 1e-4

    @classmethod
    def of(cls, p: dict) -> Setting:
        """From named settings; ``warm_start``, ``random_state`` and ``verbose`` are arguments of a fit."""
        p = {k: v for k, v in p.items() if k not in ("warm_start", "random_state", "verbose")}
        unknown = set(p) - {f.name for f in fields(cls)}
        if unknown:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        s = cls(**p)
        if s.loss not in LOSSES:
            raise ValueError(f"unknown loss {s.loss!r}")
        if s.criterion not in CRITERIA:
            raise ValueError(f"criterion {s.criterion!r} is not built: it needs the medians of all candidate children")
        return replace(s, loss=LOSSES[s.loss], criterion=CRITERIA[s.criterion])

    def plain(self, n: int) -> Setting:
        """The same fit on ``n`` features, without what has no effect in it."""
        inert = {} if self.loss in ("huber", "quantile") else {"alpha": 0.9}
        if not self.n_iter_no_change:
            inert |= {"validation_fraction": 0.1, "tol": 1e-4}
        return replace(self, max_features=self.tried(n), **inert)

    def tried(self, n: int) -> int:
        """Features looked at in a split, of ``n``."""
        m = self.max_features
        if m is None or m == "auto":
            return n
        if m == "sqrt":
            return max(1, int(math.sqrt(n)))
        if m == "log2":
            return max(1, int(math.log2(n)))
        return max(1, int(m * n) if isinstance(m, float) else min(int(m), n))


@dataclass
class Tree:
    """Nodes in parallel lists; feature -1 marks a leaf.  ``cut``: bin, rows at most there go left."""
    feature: list = field(default_factory=list)
    cut: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    depth: list = field(default_factory=list)
    n: list = field(default_factory=list)
    sum: list = field(default_factory=list)
    sumsq: list = field(default_factory=list)
    gain: list = field(default_factory=list)
    value: list = field(default_factory=list)
    path: list = field(default_factory=list)        # 1 for the root, 2p and 2p + 1 below p

    def add(self, depth: int, path: int, n: int = 0, total: float = 0.0) -> int:
        for held in (self.feature, self.cut, self.left, self.right):
            held.append(-1)
        for held in (self.sumsq, self.gain, self.value):
            held.append(0.0)
        self.depth.append(depth)
        self.n.append(n)
        self.sum.append(total)
        self.path.append(path)
        return len(self.feature) - 1

    def leaves(self) -> list[int]:
        out, todo = [], [0]
        while todo:
            k = todo.pop()
            if self.feature[k] < 0:
                out.append(k)
            else:
                todo += [self.right[k], self.left[k]]
        return out

    def cost(self, k: int, rows: int) -> float:
        """The node's share of the squared error as a leaf, R(t)."""
        return max(self.sumsq[k] - self.sum[k] ** 2 / self.n[k], 0.0) / rows if self.n[k] else 0.0

    def compact(self) -> Tree:
        """Only the nodes that are still reached."""
        out, todo = Tree(), [(0, -1, False)]
        while todo:
            k, parent, right = todo.pop(0)
            new = out.add(self.depth[k], self.path[k])
            for name in ("feature", "cut", "n", "sum", "sumsq", "gain", "value"):
                getattr(out, name)[new] = getattr(self, name)[k]
            if parent >= 0:
                getattr(out, "right" if right else "left")[parent] = new
            if self.feature[k] >= 0:
                todo += [(self.left[k], new, False), (self.right[k], new, True)]
        return out

    def arrays(self) -> tuple:
        return tuple(np.array(x, dtype=t) for x, t in ((self.feature, np.int32), (self.cut, np.int32), (self.left, np.int32),
                                                       (self.right, np.int32), (self.value, np.float64)))


def best_first(tree: Tree, most: int) -> None:
    """Leave only the splits that best-first growth to ``most`` leaves would take.

    A node's best split depends on its rows alone, so the order of growth can be found
    on the tree grown by levels: the open node of the largest gain is split next.
    """
    kept, queue = set(), [(-tree.gain[0], 0)] if tree.feature[0] >= 0 else []
    while queue and len(kept) + 1 < most:
        _, k = heapq.heappop(queue)
        kept.add(k)
        for child in (tree.left[k], tree.right[k]):
            if tree.feature[child] >= 0:
                heapq.heappush(queue, (-tree.gain[child], child))
    for k in range(len(tree.feature)):
        if tree.feature[k] >= 0 and k not in kept:
            tree.feature[k] = -1


def prune_path(tree: Tree, rows: int, alpha: float = math.inf) -> list[tuple[float, int]]:
    """Weakest-link pruning in place up to ``alpha``: (link cost, node) of each pruned link."""
    out = []
    while tree.feature[0] >= 0:
        weakest = (math.inf, -1)

        def walk(k):
            nonlocal weakest
            if tree.feature[k] < 0:
                return tree.cost(k, rows), 1
            (a, m), (b, n) = walk(tree.left[k]), walk(tree.right[k])
            link = (tree.cost(k, rows) - a - b) / (m + n - 1)
            weakest = min(weakest, (link, k))
            return a + b, m + n

        walk(0)
        if weakest[0] > alpha:
            break
        out.append(weakest)
        tree.feature[weakest[1]] = -1
    return out


# --------------------------------------------------------------------------- numbers in tasks
def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    """64 mixed bits of the key hashes and a salt."""
    x = h ^ np.uint64((salt * 0x9E3779B97F4A7C15 + 0x1234567) & 0xFFFFFFFFFFFFFFFF)
    shifted = np.empty_like(x)
    for bits, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        np.right_shift(x, np.uint64(bits), out=shifted)
        x ^= shifted
        x *= np.uint64(factor)
    return x


def _share(h: np.ndarray, salt: int, share: float) -> np.ndarray:
    return _mixed(h, salt) < np.uint64(min(int(share * 2.0 ** 64), 2 ** 64 - 1))


def _route(tree: tuple, bins: np.ndarray) -> np.ndarray:
    """Node of each row; ``bins`` is feature by row."""
    feature, cut, left, right, _ = tree
    n = bins.shape[1]
    node = np.zeros(n, dtype=np.int32)
    if feature[0] < 0:
        return node
    if len(feature) <= 128:
        # few nodes: each is compared with the whole column, its children come after it
        small, step = np.zeros(n, dtype=np.uint8), np.uint8
        for k in np.flatnonzero(feature >= 0):
            here = small == k
            small += here.view(step) * step(left[k] - k)
            here &= bins[feature[k]] > int(cut[k])
            small += here.view(step) * step((right[k] - left[k]) % 256)
        return small.astype(np.int32)
    leaf = feature < 0
    own = np.arange(len(feature), dtype=np.int32)
    # a leaf leads to itself
    first, limit = np.where(leaf, 0, feature).astype(np.int64) * n, np.where(leaf, 255, cut)
    below, above = np.where(leaf, own, left), np.where(leaf, own, right)
    flat, rows = bins.reshape(-1), np.arange(n)
    while not leaf[node].all():
        node = np.where(flat[first[node] + rows] > limit[node], above[node], below[node])
    return node


def _residual(loss: str, diff: np.ndarray, alpha: float, delta: float) -> np.ndarray:
    if loss == "absolute_error":
        return np.sign(diff)
    if loss == "quantile":
        return np.where(diff > 0, alpha, alpha - 1)
    if loss == "huber":
        return np.clip(diff, -delta, delta)
    return diff


def _loss(loss: str, diff: np.ndarray, alpha: float, delta: float) -> float:
    if loss == "absolute_error":
        return float(np.abs(diff).sum())
    if loss == "quantile":
        return float(np.where(diff > 0, alpha * diff, (alpha - 1) * diff).sum())
    if loss == "huber":
        a = np.abs(diff)
        return float(np.where(a <= delta, 0.5 * a * a, delta * (a - 0.5 * delta)).sum())
    return float((diff * diff).sum())


def _ordered(x: np.ndarray) -> np.ndarray:
    """Unsigned integers in the order of the doubles."""
    b = (x + 0.0).view(np.uint64)       # -0.0 becomes 0.0
    return np.where(b >> np.uint64(63) == 1, ~b, b | np.uint64(1 << 63))


def _double(key: int) -> float:
    b = key ^ (1 << 63) if key >> 63 else ~key & 0xFFFFFFFFFFFFFFFF
    return float(np.array([b], dtype=np.uint64).view(np.float64)[0])


class _Block:
    """Some training rows, with what the predictions of all fits leave of their labels."""

    def __init__(self, bins, h, fold, left):
        self.bins, self.h, self.fold, self.left = bins, h, fold, left     # bins is feature by row, left fit by row


def _task_blocks(rows, n_features: int, n_fits: int, chosen: list | None = None):
    """Written blocks, several joined, with the ``chosen`` of their features (all by default)."""
    held, size = [], 0

    def joined():
        y, h, fold, f, bins = zip(*held)
        return (np.ascontiguousarray(np.concatenate(bins, axis=1)), np.concatenate(h), np.concatenate(fold),
                np.tile(np.concatenate(y) - np.concatenate(f), (n_fits, 1)))

    for r in rows:
        y, h, fold, f = (np.frombuffer(r[c], dtype=t) for c, t in (("y", np.float64), ("h", np.uint64), ("fold", np.uint8), ("f", np.float64)))
        bins = np.frombuffer(r["bins"], dtype=np.uint8).reshape(n_features, len(y))
        held.append((y, h, fold, f, bins if chosen is None else bins[chosen]))
        size += len(y)
        if size >= TASK_ROWS:
            yield joined()
            held, size = [], 0
    if held:
        yield joined()


@dataclass
class _Fit:
    """What a task knows of a fit."""
    number: int
    fold: int                       # fold held out, -1 for none
    setting: Setting
    salt: int
    delta: float = 0.0

    def masks(self, b: _Block) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        """Rows to train on, rows of the next tree's sample, validation rows."""
        train = b.fold != self.fold
        valid = None
        if self.setting.n_iter_no_change:
            valid = train & _share(b.h, 977, self.setting.validation_fraction)
            train = train & ~valid
        bag = train if self.setting.subsample >= 1 else train & _share(b.h, self.salt, self.setting.subsample)
        return train, bag, valid


# --------------------------------------------------------------------------- the rows
@dataclass
class Rows:
    """Binned training rows: written blocks, thresholds of each feature, the number of folds."""
    blocks: DataFrame
    features: list
    thresholds: list            # a sorted array a feature; bin k holds x <= thresholds[k]
    folds: int
    n_blocks: int
    n_rows: int
    n_packed: int               # features in the blocks
    chosen: list | None = None  # places there of ``features``, None for all

    def only(self, features: Sequence[str]) -> Rows:
        """The same blocks with some of the features, in the given order."""
        at = [self.features.index(c) for c in features]
        chosen = at if self.chosen is None else [self.chosen[i] for i in at]
        return replace(self, features=list(features), thresholds=[self.thresholds[i] for i in at], chosen=chosen)


def _thresholds(x: DataFrame, max_bins: int) -> list[np.ndarray]:
    names = x.columns
    one = x.agg(*[F.max(c).alias(f"top_{c}") for c in names], *[F.approx_count_distinct(c).alias(f"n_{c}") for c in names]).first()
    few = [c for c in names if one[f"n_{c}"] <= 1.25 * max_bins]        # the count is within a few percent
    values: dict = {c: set() for c in few}
    if few:
        long = x.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in few])).alias("p")).select("p.c", "p.v")
        for r in long.where("v IS NOT NULL").distinct().collect():          # about max_bins values a feature
            values[r["c"]].add(r["v"])
    probs = [k / max_bins for k in range(1, max_bins)]
    many = [c for c in names if c not in values or len(values[c]) > max_bins]
    for c, q in zip(many, x.approxQuantile(many, probs, 0.001) if many else []):
        values[c] = set(q) | {one[f"top_{c}"]}
    return [np.array(sorted(v for v in values[c] if one[f"top_{c}"] is not None and v < one[f"top_{c}"]), dtype=np.float64) for c in names]


def prepare(train: DataFrame, features: Sequence[str], label: str, keys: Sequence[str], folds: int = 1, seed: int = 42,
            thresholds: list | None = None, max_bins: int = MAX_BINS, init: str | None = None) -> Rows:
    """Bin and pack the rows with a label; a row's fold and samples follow from its key.

    Thresholds are a feature's values if it has at most ``max_bins`` different ones, else
    approximate quantiles (relative error 1/1000); a missing feature value lies above all
    thresholds.  ``init`` names a column of predictions to start from.
    """
    features = list(features)
    spark = train.sparkSession
    rows = train.where(F.col(label).isNotNull()).select(
        *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)], F.col(label).cast("double").alias("y"),
        hash64(keys, seed).alias("h"), (F.pmod(hash64(keys, f"{seed}-fold"), F.lit(folds)).cast("int") if folds > 1 else F.lit(0)).alias("fold"),
        (F.col(init).cast("double") if init else F.lit(0.0)).alias("f"))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)       # read by each of the passes
    if thresholds is None:
        thresholds = _thresholds(rows.select(*[F.when(~F.isnan(f"x{i}"), F.col(f"x{i}")).alias(f"x{i}") for i in range(len(features))]), max_bins)

    def pack(batches):
        part = np.uint64(0)
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for lo in range(0, len(batch), BLOCK_ROWS):
                b = batch.slice(lo, BLOCK_ROWS)
                col = lambda c, t=np.float64: np.asarray(b.column(c).to_numpy(zero_copy_only=False), dtype=t)
                bins = np.stack([np.searchsorted(t, col(f"x{i}"), side="left") for i, t in enumerate(thresholds)]).astype(np.uint8)
                out = [[number], [len(b)], [bins.tobytes()], [col("y").tobytes()], [col("h", np.int64).astype(np.uint64).tobytes()],
                       [col("fold", np.uint8).tobytes()], [col("f").tobytes()]]
                yield pa.RecordBatch.from_arrays([*[pa.array(x, pa.int64()) for x in out[:2]], *[pa.array(x, pa.binary()) for x in out[2:]]],
                                                 names=["block", "n", "bins", "y", "h", "fold", "f"])
                number += 1

    path = shared_scratch_path(spark, f"boosting-{uuid.uuid4().hex}")
    rows.mapInArrow(pack, "block bigint, n bigint, bins binary, y binary, h binary, fold binary, f binary").write.parquet(path)
    rows.unpersist()
    blocks = spark.read.parquet(path)
    n_blocks, n_rows = blocks.agg(F.count("block"), F.coalesce(F.sum("n"), F.lit(0))).first()
    return Rows(blocks, features, thresholds, folds, n_blocks, n_rows, len(features))


# --------------------------------------------------------------------------- models
@dataclass
class BoostedModel:
    """Trees over raw feature values, with the training loss after each number of trees."""
    setting: Setting
    features: list
    thresholds: list
    init: float
    trees: list
    curve: list = field(default_factory=list)       # training loss after 0, 1, 2, ... trees
    init_col: str | None = None
    held_out: list = field(default_factory=list)    # (rows, squared error) on the held-out fold after 0, 1, 2, ... trees
    seed: int = 42

    def transform(self, df: DataFrame, out: str = "prediction", n_trees: int | None = None) -> DataFrame:
        """``df`` with the prediction of the first ``n_trees`` trees (all by default), on Arrow batches."""
        trees, thresholds, rate = [t.arrays() for t in self.trees[:n_trees]], self.thresholds, self.setting.learning_rate

        @F.pandas_udf("double")
        def predict(x):
            import pandas as pd
            bins = np.stack([np.searchsorted(t, x.iloc[:, i].to_numpy(dtype=np.float64), side="left") for i, t in enumerate(thresholds)]).astype(np.uint8)
            total = np.zeros(len(x))
            for t in trees:
                total += rate * t[4][_route(t, bins)]
            return pd.Series(total)

        start = F.lit(self.init) + (F.col(self.init_col).cast("double") if self.init_col else F.lit(0.0))
        packed = F.struct(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(self.features)])
        return df.withColumn(out, start + predict(packed))

    def nodes(self, spark: SparkSession) -> DataFrame:
        """A row a node: tree, node, parent's children, feature, threshold, value, n, sum, sumsq, gain."""
        rows = []
        for t, tree in enumerate(self.trees):
            for k in range(len(tree.feature)):
                f = tree.feature[k]
                rows.append((t, k, tree.depth[k], self.features[f] if f >= 0 else None, f, tree.cut[k] if f >= 0 else None,
                             float(self.thresholds[f][tree.cut[k]]) if f >= 0 else None,
                             tree.left[k] if f >= 0 else None, tree.right[k] if f >= 0 else None, int(tree.n[k]), float(tree.sum[k]),
                             float(tree.sumsq[k]), float(tree.gain[k]), float(tree.value[k]), int(tree.path[k])))
        return spark.createDataFrame(rows, "tree int, node int, depth int, feature string, feature_id int, cut int, threshold double, "
                                           "left int, right int, n bigint, sum double, sumsq double, gain double, value double, path bigint")

    def importances(self) -> dict:
        """Share of each feature in all trees' mean impurity decrease (M9)."""
        total = np.zeros(len(self.features))
        for tree in self.trees:
            own = np.zeros(len(self.features))
            for f, g in zip(tree.feature, tree.gain):
                if f >= 0:
                    own[f] += g
            total += own / own.sum() if own.sum() else own
        return dict(zip(self.features, (total / total.sum() if total.sum() else total).tolist()))

    def save(self, spark: SparkSession, path: str) -> None:
        """Node table and settings, as Parquet below ``path`` (never overwritten)."""
        self.nodes(spark).coalesce(1).write.parquet(f"{path}/nodes")
        meta = {"setting": asdict(self.setting), "features": self.features, "thresholds": [t.tolist() for t in self.thresholds], "init": self.init,
                "curve": self.curve, "init_col": self.init_col, "seed": self.seed, "n_trees": len(self.trees)}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.parquet(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedModel:
        meta = json.loads(spark.read.parquet(f"{path}/meta").first()["meta"])
        trees = [Tree() for _ in range(meta["n_trees"])]
        for r in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():     # a model's nodes
            t = trees[r["tree"]]
            k = t.add(r["depth"], r["path"], r["n"], r["sum"])
            t.feature[k], t.sumsq[k], t.gain[k], t.value[k] = r["feature_id"], r["sumsq"], r["gain"], r["value"]
            if r["feature_id"] >= 0:
                t.cut[k], t.left[k], t.right[k] = r["cut"], r["left"], r["right"]
        return cls(Setting(**meta["setting"]), meta["features"], [np.array(t) for t in meta["thresholds"]], meta["init"], trees, meta["curve"],
                   meta["init_col"], seed=meta["seed"])


# --------------------------------------------------------------------------- the trainer
class _Held(list):
    """Blocks in a task's memory, with the calls that a trainer makes of an RDD."""

    def mapPartitions(self, run):  # noqa: N802
        return _Held(run(iter(self)))

    def collect(self):
        return self

    def persist(self, *_):
        return self

    def unpersist(self):
        pass

    def checkpoint(self):
        pass


class _Trainer:
    """Fits in lockstep over ``state``: an RDD of blocks in ``n_tasks`` tasks, or a task's own blocks."""

    def __init__(self, state, n_tasks: int, cores: int, features: list, thresholds: list, fits: list[tuple[Setting, int]], seed: int,
                 models: list[BoostedModel] | None = None, init_col: str | None = None, drawn: dict | None = None):
        self.drawn = {} if drawn is None else drawn
        self.seed, self.n_features, self.n_tasks, self.cores = seed, len(features), n_tasks, cores
        self.width = max([len(t) for t in thresholds], default=0) + 1
        self.fits = [_Fit(k, fold, s, 0) for k, (s, fold) in enumerate(fits)]
        self.models = models or [BoostedModel(s, features, thresholds, 0.0, [], init_col=init_col, seed=seed) for s, _ in fits]
        self.since, self.old = 0, None
        self.state = self._kept(state)
        if models is None:
            self._constants()
        else:
            self._advance([m.trees for m in models], constants=True)

    @classmethod
    def over(cls, rows: Rows, fits: list[tuple[Setting, int]], seed: int, models: list[BoostedModel] | None = None, init_col: str | None = None):
        cores, n_packed, chosen, n_fits = rows.blocks.sparkSession.sparkContext.defaultParallelism, rows.n_packed, rows.chosen, len(fits)
        size = rows.n_blocks * BLOCK_ROWS      # about
        n_tasks = max(min(cores, -(-size // TASK_ROWS)), -(-size // PART_ROWS), 1)
        state = rows.blocks.repartition(n_tasks).rdd.mapPartitions(lambda part: _task_blocks(part, n_packed, n_fits, chosen))
        return cls(state, n_tasks, cores, rows.features, rows.thresholds, fits, seed, models, init_col)

    # ---- state
    def _kept(self, state):
        return state.persist(StorageLevel.MEMORY_AND_DISK_DESER)       # pickled already

    def _summed(self, fits: list[_Fit], one, finish) -> list:
        """``one(fit, block)`` gives an array, added up over all blocks; ``finish(fit, sum)`` gives rows."""
        def run(part):
            total: dict = {}
            for parts in part:
                b = _Block(*parts)
                for f in fits:
                    got = np.asarray(one(f, b), dtype=np.float64)
                    total[f.number] = total[f.number] + got if f.number in total else got
            return [(k, v.tobytes()) for k, v in total.items()]

        empty = _Block(np.zeros((self.n_features, 0), dtype=np.uint8), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint8),
                       np.zeros((len(self.fits), 0)))
        totals = {f.number: np.asarray(one(f, empty), dtype=np.float64) for f in fits}
        got = self.state.mapPartitions(run)
        if self.n_tasks * sum(map(len, totals.values())) > DRIVER_NUMBERS:
            # added up and searched where they meet; the driver gets splits
            got = got.reduceByKey(lambda a, b: (np.frombuffer(a) + np.frombuffer(b)).tobytes(), self.cores)
            done = dict(got.map(lambda kv: (kv[0], finish(kv[0], np.frombuffer(kv[1])))).collect())
            return [r for k, total in totals.items() for r in (done[k] if k in done else finish(k, total))]
        for k, v in got.collect():          # tables a fit, as large as its settings make them
            totals[k] = totals[k] + np.frombuffer(v)
        return [r for k, total in totals.items() for r in finish(k, total)]

    def _advance(self, new_trees: list[list[Tree]], constants: bool = False) -> None:
        """Add trees (and the models' constants) to all rows' predictions."""
        adds = [(f.number, [t.arrays() for t in new_trees[f.number]], self.models[f.number].setting.learning_rate,
                 self.models[f.number].init if constants else 0.0) for f in self.fits]

        def run(part):
            for bins, h, fold, left in part:
                left = left.copy()
                for k, trees, rate, constant in adds:
                    left[k] -= constant
                    for t in trees:
                        left[k] -= (rate * t[4]).take(_route(t, bins))
                yield bins, h, fold, left

        self.old, self.state = self.state, self._kept(self.state.mapPartitions(run))
        self.since += 1
        if self.since >= CHECKPOINT_TREES:
            self.state.checkpoint()
            self.since = 0

    def _release(self) -> None:
        if self.old is not None:
            self.old.unpersist()
            self.old = None

    # ---- order statistics
    def _statistics(self, asked: dict[int, tuple[float, int]], what: str, trees: dict | None = None) -> dict[int, list[float | None]]:
        """Of each fit the ``q`` order statistic (the least value with a share of q at or below it)
        of each of its groups of rows: ``asked`` is fit -> (q, groups).  ``what``: "y" or "abs" over
        the training rows, "resid" over the sampled rows of each leaf of ``trees``."""
        fits, leaf_slots = [f for f in self.fits if f.number in asked], self._leaf_slots
        slots = {} if trees is None else {k: leaf_slots(t) for k, t in trees.items()}

        def values(f, b):
            train, bag, _ = f.masks(b)
            if what == "y":
                return b.left[f.number][train], None
            diff = b.left[f.number]
            if what == "abs":
                return np.abs(diff[train]), None
            arrays, slot = slots[f.number]
            return diff[bag], slot[_route(arrays, b.bins[:, bag])]

        found: dict = {k: [None] * m for k, (_, m) in asked.items()}
        open_: dict = {k: {g: (0, 0, None) for g in range(m)} for k, (_, m) in asked.items()}     # group -> (bits known, prefix, rank left)
        for _ in range(-(-64 // _RADIX) + 1):
            brackets = {k: v for k, v in open_.items() if v}
            if not brackets:
                break
            live = [f for f in fits if f.number in brackets]

            def count(f, b, brackets=brackets):
                v, group = values(f, b)
                keys = _ordered(v)
                todo = brackets[f.number]
                out = np.zeros((len(todo), 1 << _RADIX))
                for j, (g, (bits, prefix, _)) in enumerate(todo.items()):
                    mine = keys if group is None else keys[group == g]
                    if bits:
                        mine = mine[(mine >> np.uint64(64 - bits)) == np.uint64(prefix)]
                    step = min(_RADIX, 64 - bits)
                    digit = (mine >> np.uint64(64 - bits - step)) & np.uint64((1 << step) - 1)
                    out[j] = np.bincount(digit.astype(np.int64), minlength=1 << _RADIX)
                return out.ravel()

            def pick(k, total, brackets=brackets):
                out = []
                q = asked[k][0]
                for (g, (bits, _, rank)), counts in zip(brackets[k].items(), total.reshape(-1, 1 << _RADIX)):
                    n = int(counts.sum())
                    if not n:
                        continue
                    rank = max(int(math.ceil(q * n)) - 1, 0) if rank is None else rank
                    upto = np.cumsum(counts)
                    digit = int(np.searchsorted(upto, rank, side="right"))
                    out.append((k, g, digit, rank - int(upto[digit] - counts[digit]), int(counts[digit])))
                return out

            got = self._summed(live, count, pick)
            few: dict = {}
            for k in brackets:
                open_[k] = {}
            for k, g, digit, rank, n in got:
                bits, prefix, _ = brackets[k][g]
                step = min(_RADIX, 64 - bits)
                bits, prefix = bits + step, prefix << step | digit
                if bits == 64:
                    found[k][g] = _double(prefix)
                elif n <= _FEW:
                    few.setdefault(k, {})[g] = (bits, prefix, rank)
                else:
                    open_[k][g] = (bits, prefix, rank)
            if few:
                self._fetched(few, values, found)
        return found

    def _fetched(self, few: dict, values, found: dict) -> None:
        """The last of an order statistic: the few values of a bracket are fetched, at most _FEW each."""
        some = [f for f in self.fits if f.number in few]

        def run(part):
            for parts in part:
                b = _Block(*parts)
                for f in some:
                    v, group = values(f, b)
                    keys = _ordered(v)
                    for g, (bits, prefix, _) in few[f.number].items():
                        hit = (keys >> np.uint64(64 - bits)) == np.uint64(prefix)
                        mine = v[hit if group is None else hit & (group == g)]
                        if len(mine):
                            yield (f.number, g), mine.tolist()

        held: dict = {}
        for at, mine in self.state.mapPartitions(run).collect():
            held.setdefault(at, []).extend(mine)
        for (k, g), some in held.items():
            found[k][g] = float(np.sort(np.array(some))[few[k][g][2]])

    @staticmethod
    def _leaf_slots(tree: Tree) -> tuple:
        slot = np.full(len(tree.feature), -1, dtype=np.int32)
        for j, k in enumerate(tree.leaves()):
            slot[k] = j
        return tree.arrays(), slot

    # ---- one round
    def _constants(self) -> None:
        """The constants that the ensembles start from."""
        def total(f, b):
            train, _, _ = f.masks(b)
            d = b.left[f.number][train]
            return np.array([len(d), d.sum()])

        fits = [f for f in self.fits if f.setting.init != "zero"]
        mean = [f for f in fits if f.setting.loss == "squared_error"]
        if mean:
            for k, c in self._summed(mean, total, lambda k, v: [(k, float(v[1] / v[0]) if v[0] else 0.0)]):
                self.models[k].init = c
        rest = {f.number: (f.setting.alpha if f.setting.loss == "quantile" else 0.5, 1) for f in fits if f.setting.loss != "squared_error"}
        if rest:
            for k, v in self._statistics(rest, "y").items():
                self.models[k].init = v[0] if v[0] is not None else 0.0
        self._advance([[] for _ in self.fits], constants=True)

    def _drawn(self, salt: int, path: int, tried: int) -> np.ndarray:
        """The features that a node looks at; of all settings alike."""
        at = salt, path, tried
        if at not in self.drawn:
            if len(self.drawn) > 1 << 18:
                self.drawn.clear()
            self.drawn[at] = np.sort(np.random.default_rng([self.seed, salt, path]).choice(self.n_features, tried, replace=False)).astype(np.uint16)
        return self.drawn[at]

    def _level(self, trees: dict[int, Tree], open_: dict[int, list[int]], first: bool) -> dict:
        """Best splits of the open nodes of all fits, by one job; with ``first`` also the losses."""
        n_features, width, seed, fits = self.n_features, self.width, self.seed, [f for f in self.fits if f.number in open_]
        plan = {}
        for f in fits:
            tree, nodes = trees[f.number], open_[f.number]
            tried = f.setting.tried(n_features)
            looked = np.tile(np.arange(n_features), (len(nodes), 1))        # node by number: feature
            if tried < n_features:
                looked = np.array([self._drawn(f.salt, tree.path[k], tried) for k in nodes], dtype=np.int64)
            slot = np.full(len(tree.feature), -1, dtype=np.int64)
            slot[nodes] = np.arange(len(nodes))
            plan[f.number] = (tree.arrays(), slot, looked, len(nodes))

        def one(f, b):
            arrays, slot, looked, n_nodes = plan[f.number]
            s = f.setting
            head = np.zeros(6)
            train, bag, valid = f.masks(b)
            diff = b.left[f.number]
            if first:
                head[:2] = train.sum(), _loss(s.loss, diff if train.all() else diff[train], s.alpha, f.delta)
                if f.fold >= 0:
                    out = diff[~train & (b.fold == f.fold)]
                    head[2:4] = len(out), (out * out).sum()
                if valid is not None:
                    head[4:] = valid.sum(), _loss(s.loss, diff[valid], s.alpha, f.delta)
            rows = None if bag.all() else np.flatnonzero(bag)
            bins = b.bins if rows is None else b.bins.take(rows, axis=1)
            r = _residual(s.loss, diff if rows is None else diff.take(rows), s.alpha, f.delta)
            at = np.zeros(len(r), dtype=np.int64) if first else slot.take(_route(arrays, bins))
            if n_nodes < len(slot):     # some nodes are closed
                rows = np.flatnonzero(at >= 0)
                if len(rows) < len(at):
                    at, r, bins = at.take(rows), r.take(rows), bins.take(rows, axis=1)
            nodes = np.concatenate([np.bincount(at, minlength=n_nodes), np.bincount(at, weights=r, minlength=n_nodes),
                                    np.bincount(at, weights=r * r, minlength=n_nodes)])
            tried = looked.shape[1]
            counts, sums = np.zeros((n_nodes, tried, width)), np.zeros((n_nodes, tried, width))
            base, cells = at * width, n_nodes * width
            flat, own = bins.reshape(-1), np.arange(bins.shape[1]) if tried < n_features else None
            for j in range(tried):
                if own is None or (looked[:, j] == looked[0, j]).all():
                    code = base + bins[looked[0, j]]
                else:
                    place = (looked[:, j] * bins.shape[1]).take(at)
                    place += own
                    code = base + flat.take(place)
                counts[:, j] = np.bincount(code, minlength=cells).reshape(n_nodes, width)
                sums[:, j] = np.bincount(code, weights=r, minlength=cells).reshape(n_nodes, width)
            return np.concatenate([head, nodes, counts.ravel(), sums.ravel()])

        settings = {f.number: f.setting for f in fits}
        roots = {} if first else {f.number: trees[f.number].n[0] for f in fits}

        def finish(k, total):
            looked, n_nodes = plan[k][2:]
            s = settings[k]
            head, rest = total[:6], total[6:]
            n, sm, sq = rest[:3 * n_nodes].reshape(3, n_nodes)
            counts, sums = rest[3 * n_nodes:].reshape(2, n_nodes, -1, width)
            least = max(s.min_samples_leaf, int(math.ceil(s.min_weight_fraction_leaf * roots.get(k, n[0]))), 1)
            left_n, left_s = np.cumsum(counts, axis=2), np.cumsum(sums, axis=2)
            n_all, s_all = n[:, None, None], sm[:, None, None]
            right_n = n_all - left_n
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where((left_n >= least) & (right_n >= least),
                                left_s * left_s / left_n + (s_all - left_s) ** 2 / right_n, -np.inf) - s_all ** 2 / n_all
            cuts = np.argmax(gain, axis=2)
            pick = lambda x: np.take_along_axis(x, cuts[:, :, None], 2)[:, :, 0]
            gains, ns, ss = pick(gain), pick(left_n), pick(left_s)
            # the first feature of the largest gain, by more than rounding
            best, at, least_gain = np.zeros(n_nodes), np.full(n_nodes, -1), 1e-12 * np.maximum(sq, 1e-300)
            for j in range(looked.shape[1]):
                better = (gains[:, j] > best + least_gain) & (n >= s.min_samples_split)
                best[better], at[better] = gains[better, j], j
            own, found = np.arange(n_nodes), at >= 0
            of = lambda x, none: np.where(found, x[own, at], none).tolist()
            head = head.tolist()
            return [(k, j, int(a), *r, *head) for j, (a, *r) in enumerate(zip(
                n.tolist(), sm.tolist(), sq.tolist(), best.tolist(), of(looked, -1), of(cuts, -1), of(ns.astype(np.int64), 0), of(ss, 0.0)))]

        names = ("fit", "slot", "n", "sum", "sumsq", "gain", "feature", "cut", "left_n", "left_sum",
                 "n_train", "loss", "n_out", "se_out", "n_valid", "loss_valid")
        return [dict(zip(names, r)) for r in self._summed(fits, one, finish)]

    def _grow(self, live: list[_Fit]) -> dict[int, Tree]:
        trees = {f.number: Tree() for f in live}
        open_ = {k: [tree.add(0, 1)] for k, tree in trees.items()}
        settings = {f.number: f.setting for f in live}
        in_all: dict = {}
        level = 0
        while open_:
            nxt: dict = {}
            for r in self._level(trees, open_, level == 0):
                k, tree, s = r["fit"], trees[r["fit"]], settings[r["fit"]]
                node = open_[k][r["slot"]]
                tree.n[node], tree.sum[node], tree.sumsq[node] = r["n"], r["sum"], r["sumsq"]
                if level == 0:
                    in_all[k] = r
                if r["feature"] < 0 or r["n"] == 0 or level >= s.max_depth:
                    continue
                scale = 1.0 if s.criterion == "friedman_mse" else max(in_all[k]["n"], 1)
                if r["gain"] / scale < s.min_impurity_decrease:
                    continue
                tree.feature[node], tree.cut[node], tree.gain[node] = r["feature"], r["cut"], r["gain"]
                a = tree.add(level + 1, 2 * tree.path[node], r["left_n"], r["left_sum"])
                b = tree.add(level + 1, 2 * tree.path[node] + 1, r["n"] - r["left_n"], r["sum"] - r["left_sum"])
                tree.left[node], tree.right[node] = a, b
                # the nodes of the last level are looked at only where their squared error counts
                if level + 1 < s.max_depth or s.ccp_alpha > 0:
                    nxt.setdefault(k, []).extend([a, b])
            if level == 0:
                self._release()
            open_, level = nxt, level + 1
        for k, r in in_all.items():
            m = self.models[k]
            m.curve.append(r["loss"] / r["n_train"] if r["n_train"] else 0.0)
            m.held_out.append((r["n_out"], r["se_out"]))
            if settings[k].n_iter_no_change:
                self.valid[k].append(r["loss_valid"] / max(r["n_valid"], 1))
        for f in live:
            tree, s = trees[f.number], f.setting
            if s.max_leaf_nodes is not None:
                best_first(tree, s.max_leaf_nodes)
            if s.ccp_alpha > 0:
                prune_path(tree, max(tree.n[0], 1), s.ccp_alpha)
            if s.max_leaf_nodes is not None or s.ccp_alpha > 0:
                trees[f.number] = tree.compact()
        return trees

    def _values(self, live: list[_Fit], trees: dict[int, Tree]) -> None:
        for f in live:
            tree = trees[f.number]
            if f.setting.loss == "squared_error":
                tree.value = [s / n if n else 0.0 for s, n in zip(tree.sum, tree.n)]
        by_rank = {f.number: (f.setting.alpha if f.setting.loss == "quantile" else 0.5, len(trees[f.number].leaves()))
                   for f in live if f.setting.loss != "squared_error"}
        if not by_rank:
            return
        some = {k: trees[k] for k in by_rank}
        got = self._statistics(by_rank, "resid", some)
        huber = [f for f in live if f.setting.loss == "huber"]
        if huber:
            slots = {f.number: self._leaf_slots(trees[f.number]) for f in huber}

            def clipped(f, b):
                _, bag, _ = f.masks(b)
                arrays, slot = slots[f.number]
                at = slot[_route(arrays, b.bins[:, bag])]
                m = np.array([x or 0.0 for x in got[f.number]])
                d = b.left[f.number][bag] - m[at]
                n = len(m)
                return np.concatenate([np.bincount(at, minlength=n), np.bincount(at, weights=np.clip(d, -f.delta, f.delta), minlength=n)])

            def finish(k, v):
                n, s = v.reshape(2, -1)
                return [(k, j, float(s[j] / n[j]) if n[j] else 0.0) for j in range(len(n))]

            for k, j, v in self._summed(huber, clipped, finish):
                if got[k][j] is not None:
                    got[k][j] += v
        for k, values in got.items():
            for j, node in enumerate(trees[k].leaves()):
                trees[k].value[node] = values[j] if values[j] is not None else 0.0

    def run(self) -> list[BoostedModel]:
        stopped = [False] * len(self.fits)
        self.valid = [[] for _ in self.fits]
        try:
            while True:
                live = [f for f in self.fits if len(self.models[f.number].trees) < f.setting.n_estimators and not stopped[f.number]]
                if not live:
                    break
                for f in live:
                    f.salt = 1000 + len(self.models[f.number].trees)
                huber = {f.number: (f.setting.alpha, 1) for f in live if f.setting.loss == "huber"}
                if huber:
                    for k, v in self._statistics(huber, "abs").items():
                        self.fits[k].delta = v[0] or 0.0
                trees = self._grow(live)
                for f in live:
                    v, patience = self.valid[f.number], f.setting.n_iter_no_change
                    if patience and len(v) > patience and min(v[-patience:]) + f.setting.tol >= min(v[:-patience]):
                        stopped[f.number] = True
                        trees.pop(f.number)
                live = [f for f in live if not stopped[f.number]]
                self._values(live, trees)
                for f in live:
                    self.models[f.number].trees.append(trees[f.number])
                self._advance([[trees[f.number]] if f.number in trees else [] for f in self.fits])
            self._last()
        finally:
            self._release()
            self.state.unpersist()
        return self.models

    def _last(self) -> None:
        """The losses of the finished ensembles."""
        def one(f, b):
            train, _, _ = f.masks(b)
            d = b.left[f.number]
            out = d[~train & (b.fold == f.fold)] if f.fold >= 0 else d[:0]
            return np.array([train.sum(), _loss(f.setting.loss, d[train], f.setting.alpha, f.delta), len(out), (out * out).sum()])

        for k, n, loss, n_out, se_out in self._summed(self.fits, one, lambda k, v: [(k, *[float(x) for x in v])]):
            m = self.models[k]
            if len(m.curve) <= len(m.trees):
                m.curve.append(loss / n if n else 0.0)
                m.held_out.append((n_out, se_out))


def fit_boosting(train: DataFrame, features: Sequence[str], label: str, keys: Sequence[str], settings: dict | None = None, seed: int = 42,
                 start: BoostedModel | None = None, init: str | None = None, max_bins: int = MAX_BINS) -> BoostedModel:
    """One ensemble on all rows with a label.

    ``start`` continues a stored model (``warm_start``): its trees are kept, its settings are
    replaced by the given ones and trees are added up to ``n_estimators``; samples go on as
    in an uninterrupted fit.  ``init`` names a column of predictions that the ensemble corrects
    (it must then be there when the model scores).  A missing label is no training row; without
    rows every tree is one leaf of value 0.
    """
    s = Setting.of(settings or {})
    if start is not None:
        rows = prepare(train, start.features, label, keys, 1, seed, start.thresholds, init=start.init_col)
        model = replace(start, setting=s, trees=list(start.trees), curve=list(start.curve), held_out=list(start.held_out))
        model.curve, model.held_out = model.curve[:len(model.trees)], model.held_out[:len(model.trees)]
        if s.learning_rate != start.setting.learning_rate or s.loss != start.setting.loss:
            raise ValueError("a continued fit keeps its loss and learning rate")
        ensure_checkpoint_dir(train.sparkSession)
        return _Trainer.over(rows, [(s, -1)], start.seed, [model]).run()[0]
    rows = prepare(train, features, label, keys, 1, seed, init=init, max_bins=max_bins)
    ensure_checkpoint_dir(train.sparkSession)
    return _Trainer.over(rows, [(s, -1)], seed, init_col=init).run()[0]


def fit_many(rows: Rows, fits: list[tuple[Setting, int]], seed: int = 42) -> list[BoostedModel]:
    """Ensembles of (setting, held-out fold or -1), trained in lockstep."""
    ensure_checkpoint_dir(rows.blocks.sparkSession)
    return _Trainer.over(rows, fits, seed).run()


def held_out_errors(rows: Rows, fits: list[tuple[Setting, int]], seed: int = 42, at_once: int | None = None):
    """Of all fits, (place in ``fits``, [(rows, squared error) on the held-out fold after 1, 2, ... trees]); yields
    lists of at most ``at_once`` of them.

    Tables of at most ``WHOLE_ROWS`` rows are dealt whole to tasks that train some fits each, one
    after the other; of larger ones as many fits are trained in lockstep as ``STATE_BYTES`` allow.
    """
    cores = rows.blocks.sparkSession.sparkContext.defaultParallelism
    if rows.n_rows > WHOLE_ROWS:
        at_once = max(1, min(at_once or len(fits), STATE_BYTES // (8 * rows.n_rows)))
        # fits of like depth side by side, so that few wait for the deepest
        order = sorted(range(len(fits)), key=lambda i: (fits[i][0].max_depth, fits[i][0].n_estimators, i))
        for lo in range(0, len(order), at_once):
            some = order[lo:lo + at_once]
            yield [(i, m.held_out[1:]) for i, m in zip(some, fit_many(rows, [fits[i] for i in some], seed))]
        return
    # the longest first, so that the batches' tasks end at about the same time
    order = sorted(range(len(fits)), key=lambda i: (-fits[i][0].n_estimators * 2 ** (fits[i][0].max_depth / 2), i))
    at_once = 16 * cores
    for lo in range(0, len(order), at_once):
        some = order[lo:lo + at_once]
        yield _errors_by_task(rows, [(i, fits[i]) for i in some], seed, min(2 * cores, len(some)))


def _errors_by_task(rows: Rows, fits: list[tuple[int, tuple[Setting, int]]], seed: int, n_tasks: int) -> list[tuple[int, list]]:
    features, thresholds, n_packed, chosen = rows.features, rows.thresholds, rows.n_packed, rows.chosen
    columns = ["block", "y", "bins", "h", "fold", "f"]

    def run(k, part):
        held = list(_task_blocks(sorted((r for _, r in part), key=lambda r: r["block"]), n_packed, 1, chosen))
        drawn: dict = {}
        for i, fit in fits[k::n_tasks]:
            m = _Trainer(_Held(held), 1, 1, features, thresholds, [fit], seed, drawn=drawn).run()[0]
            yield i, [(int(n), float(se)) for n, se in m.held_out[1:]]

    dealt = rows.blocks.select(*columns).rdd.flatMap(lambda r: [(k, r) for k in range(n_tasks)]).partitionBy(n_tasks, lambda k: k)
    return dealt.mapPartitionsWithIndex(run).collect()      # two numbers a tree
