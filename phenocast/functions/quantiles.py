"""Exact order statistics without sorting a whole column in one task.

``percentile``/``percentile_disc`` keep every distinct value of the column in
one reducer, and a global ``row_number`` window moves all rows into a single
partition.  :func:`kth_smallest_many` instead works in distributed passes
over a persisted projection of the needed columns, for any number of
(column, rank) targets at once:

1. one aggregate: non-null count and approximate distinct count per column;
   a column with few distinct values is answered by collecting its
   ``(value, count)`` pairs (a partially aggregated group-by);
2. otherwise each round narrows an open value bracket per target with one
   ``approxQuantile`` pass (a mergeable sketch; values outside a target's
   bracket are masked to NULL, so all targets share the pass) and one
   conditional-count pass, until few enough rows remain inside the bracket
   to fetch them as ``(value, count)`` pairs.

Each round shrinks a bracket by about ``1 / (4 * rel_err)``, so even a
trillion-row column needs a handful of rounds, and the driver only ever sees
a bounded number of scalars.  Bracket end points are counted separately, so
heavy ties (one value holding a third of all rows) cost nothing extra.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _walk(pairs, k: int, offset: int):
    cum = offset
    for value, cnt in pairs:
        if k < cum + cnt:
            return value
        cum += cnt
    raise AssertionError("rank outside the collected range")


def _valid(c: str, dtype) -> object:
    cond = F.col(c).isNotNull()
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        cond = cond & ~F.isnan(c)
    return cond


def kth_smallest(df: DataFrame, col: str, ks: Sequence[int], rel_err: float = 1e-3,
                 max_collect: int = 100_000) -> list:
    """Exact 0-based ``k``-th smallest non-null value of ``col`` for each ``k``."""
    return kth_smallest_many(df, [(col, k) for k in ks], rel_err, max_collect)


def kth_smallest_many(df: DataFrame, targets: Sequence[tuple], rel_err: float = 1e-3,
                      max_collect: int = 100_000) -> list:
    """Exact order statistics for several ``(column, 0-based rank)`` targets at once.

    A rank may also be a function of the column's non-null count ``n`` (for
    example ``lambda n: (n - 1) // 2`` for the lower median); ``n`` is taken
    from the first pass, so no separate count job is needed.  Returns Python
    scalars in the order of ``targets``.  NaN counts as missing.  A rank
    outside ``[0, n)`` raises ``ValueError``.
    """
    targets = list(targets)
    cols = list(dict.fromkeys(c for c, _ in targets))
    types = {c: df.schema[c].dataType for c in cols}
    fractional = any(isinstance(types[c], (T.DoubleType, T.FloatType)) for c in cols)
    # integral columns need no masking (NULL stays NULL); reuse a cached input as is
    v = (df.select(*[F.when(_valid(c, types[c]), F.col(c)).alias(c) for c in cols])
         if fractional else df.select(*cols))
    own_cache = not (df.is_cached and not fractional)
    if own_cache:
        v = v.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        stats = v.agg(*[F.count(c).alias(f"n_{i}") for i, c in enumerate(cols)],
                      *[F.approx_count_distinct(c, 0.05).alias(f"d_{i}")
                        for i, c in enumerate(cols)]).first()
        n = {c: stats[f"n_{i}"] for i, c in enumerate(cols)}
        distinct = {c: stats[f"d_{i}"] for i, c in enumerate(cols)}
        results: dict[int, object] = {}
        for i, (c, k) in enumerate(targets):
            if callable(k) and n[c] == 0:
                results[i] = None       # no value at all: no order statistic
        targets = [(c, k(n[c]) if callable(k) and n[c] else k) for c, k in targets]
        for i, (c, k) in enumerate(targets):
            if i not in results and not 0 <= k < n[c]:
                raise ValueError(f"rank {k} outside [0, {n[c]}) for {c}")
        # few distinct values (or few rows): fetch (value, count) pairs directly
        small = [c for c in cols if 0 < n[c] and (n[c] <= max_collect or distinct[c] <= max_collect // 2)]
        if small:
            pairs = _value_counts(v, {c: (None, None) for c in small}, types)
            for i, (c, k) in enumerate(targets):
                if c in small and i not in results:
                    results[i] = _walk(pairs[c], k, 0)
        state = {i: dict(col=c, k=k, lo=None, hi=None, offset=0, m=n[c], width=2 * rel_err)
                 for i, (c, k) in enumerate(targets) if i not in results}
        while state:
            _narrow_round(v, state, results, types, rel_err, max_collect)
        return [results[i] for i in range(len(targets))]
    finally:
        if own_cache:
            v.unpersist()


def _lit(x, integral: bool):
    return F.lit(int(x)).cast("long") if integral else F.lit(float(x))


def _in_bracket(c: str, lo, hi, integral: bool):
    cond = F.col(c).isNotNull()
    if lo is not None:
        cond = cond & (F.col(c) > _lit(lo, integral))
    if hi is not None:
        cond = cond & (F.col(c) < _lit(hi, integral))
    return cond


def _value_counts(v: DataFrame, brackets: dict, types: dict) -> dict:
    """{key: sorted [(value, count)]} of the rows inside each bracket, one pass.

    ``brackets`` maps a key (a column name or a target id) to
    (column, lo, hi); for plain column keys pass (None, None) as bounds.
    """
    keys = list(brackets)
    parts = []
    for kid, key in enumerate(keys):
        spec = brackets[key]
        if len(spec) == 2:
            c, (lo, hi) = key, spec
        else:
            c, lo, hi = spec
        integral = isinstance(types[c], _INTEGRAL)
        value = F.col(c).cast("long") if integral else F.col(c).cast("double")
        parts.append(v.where(_in_bracket(c, lo, hi, integral)).select(
            F.lit(kid).alias("key"),
            (value if integral else F.lit(None).cast("long")).alias("lv"),
            (F.lit(None).cast("double") if integral else value).alias("dv")))
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionAll(p)
    grouped = stacked.groupBy("key", "lv", "dv").count().collect()
    out: dict = {kid: [] for kid in range(len(keys))}
    for r in grouped:
        out[r["key"]].append((r["lv"] if r["lv"] is not None else r["dv"], r["count"]))
    return {key: sorted(out[kid]) for kid, key in enumerate(keys)}


def _narrow_round(v: DataFrame, state: dict, results: dict, types: dict, rel_err: float,
                  max_collect: int) -> None:
    # targets whose bracket is small enough: fetch and finish
    ready = {i: s for i, s in state.items() if s["m"] <= max_collect}
    if ready:
        pairs = _value_counts(v, {i: (s["col"], s["lo"], s["hi"]) for i, s in ready.items()}, types)
        for i, s in ready.items():
            results[i] = _walk(pairs[i], s["k"], s["offset"])
            del state[i]
    if not state:
        return
    # one approxQuantile pass for every remaining target (masked columns)
    masked, probs = [], []
    for i, s in state.items():
        integral = isinstance(types[s["col"]], _INTEGRAL)
        masked.append(F.when(_in_bracket(s["col"], s["lo"], s["hi"], integral),
                             F.col(s["col"]).cast("double")).alias(f"t{i}"))
        r = s["k"] - s["offset"]
        p = (r + 0.5) / s["m"]
        probs.append((max(0.0, p - s["width"]), min(1.0, p + s["width"])))
    flat = sorted({q for pair in probs for q in pair})
    names = [f"t{i}" for i in state]
    qs = v.select(*masked).approxQuantile(names, flat, rel_err)
    bounds = {}
    for (i, s), (p_lo, p_hi), qcol in zip(state.items(), probs, qs):
        q_lo, q_hi = qcol[flat.index(p_lo)], qcol[flat.index(p_hi)]
        if isinstance(types[s["col"]], _INTEGRAL):
            # the sketch works in doubles: widen only where these are inexact (60-bit
            # hashes); below that the ends are values of the column, so ties at an end
            # are counted there and every round shrinks the bracket
            if max(abs(q_lo), abs(q_hi)) >= 2 ** 53:
                q_lo = math.floor(q_lo - math.ulp(q_lo)) - 1
                q_hi = math.ceil(q_hi + math.ulp(q_hi)) + 1
            if s.get("stuck"):      # the last round did not shrink: halve the integer bracket
                q_lo = q_hi = (s["lo"] + s["hi"]) // 2
        bounds[i] = (q_lo, q_hi)
    # one conditional-count pass for every remaining target
    aggs = []
    for i, s in state.items():
        integral = isinstance(types[s["col"]], _INTEGRAL)
        x = F.col(s["col"])
        inside = _in_bracket(s["col"], s["lo"], s["hi"], integral)
        a, b = (_lit(q, integral) for q in bounds[i])
        aggs += [F.count_if(inside & (x < a)).alias(f"below_{i}"),
                 F.count_if(inside & (x == a)).alias(f"eqlo_{i}"),
                 F.count_if(inside & (x > a) & (x < b)).alias(f"mid_{i}"),
                 F.count_if(inside & (x == b) & (a != b)).alias(f"eqhi_{i}")]
    row = v.agg(*aggs).first()
    for i in list(state):
        s = state[i]
        integral = isinstance(types[s["col"]], _INTEGRAL)
        below, eq_lo = row[f"below_{i}"], row[f"eqlo_{i}"]
        mid, eq_hi = row[f"mid_{i}"], row[f"eqhi_{i}"]
        r = s["k"] - s["offset"]
        q_lo, q_hi = bounds[i]
        if integral and s.get("stuck") and not below <= r < below + eq_lo:
            if r < below:
                s["hi"], s["m"] = q_lo, below
            else:
                s["lo"], s["offset"], s["m"] = q_lo, s["offset"] + below + eq_lo, s["m"] - below - eq_lo
        elif r < below or r >= below + eq_lo + mid + eq_hi:
            s["width"] *= 4          # the sketch missed: widen and retry
            s["misses"] = s.get("misses", 0) + 1
            if s["misses"] > 20:
                raise RuntimeError(f"order statistic of {s['col']} did not converge")
        elif r < below + eq_lo:
            results[i] = int(q_lo) if integral else float(q_lo)
            del state[i]
        elif r >= below + eq_lo + mid:
            results[i] = int(q_hi) if integral else float(q_hi)
            del state[i]
        else:
            s["offset"] += below + eq_lo
            s["stuck"] = s["lo"] is not None and mid >= s["m"]
            if s["stuck"] and not integral:
                raise RuntimeError(f"order statistic of {s['col']} did not converge")
            s["lo"], s["hi"], s["m"] = q_lo, q_hi, mid
