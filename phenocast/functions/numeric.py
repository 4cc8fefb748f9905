"""Numeric expressions: sentinels, rounding, hashing, normal quantiles."""

from __future__ import annotations

from statistics import NormalDist
from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the missing-value sentinel used by the raw observation files.
MISSING_SENTINEL = -9999.0

_FRACTIONAL = (T.DoubleType, T.FloatType)
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DoubleType,
            T.FloatType, T.DecimalType)


def sentinel_to_null(df: DataFrame, cols: Iterable[str] | None = None,
                     value: float = MISSING_SENTINEL) -> DataFrame:
    """Replace a numeric sentinel (and NaN) by NULL in the given numeric columns.

    The comparison is numeric, after the column has its numeric type, so both
    ``-9999`` and ``-9999.0`` in the source text are caught.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    cols = list(cols) if cols is not None else [
        n for n, t in fields.items() if isinstance(t, _NUMERIC)]
    repl = {}
    for c in cols:
        dt = fields[c]
        cond = F.col(c) == F.lit(value).cast(dt)
        if isinstance(dt, _FRACTIONAL):
            cond = cond | F.isnan(c)
        repl[c] = F.when(cond, F.lit(None).cast(dt)).otherwise(F.col(c))
    return df.withColumns(repl)


def half_even_int(c: Column | str) -> Column:
    """Round half to even, then to INT (82.5 -> 82, 83.5 -> 84)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.bround(c, 0).cast("int")


def numeric_aware_key(c: Column | str) -> Column:
    """Ordering key for ids stored as text: numbers by value, then the text."""
    c = F.col(c) if isinstance(c, str) else c
    return F.struct(c.try_cast("bigint").alias("n"), c.alias("s"))


def hash64(cols: Iterable[str | Column], seed: int | str = 42) -> Column:
    """Deterministic 60-bit hash of the key columns and a seed.

    First 15 hex digits of ``md5(k1|k2|...|seed)`` as BIGINT; the same value
    is ``CAST('0x' || substr(md5(concat_ws('|', ...)), 1, 15) AS BIGINT)`` in
    DuckDB, which makes hash-based splits and samples checkable.
    """
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    text = F.concat_ws("|", *parts, F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def normal_z(tail_alpha: float) -> float:
    """abs(inverse normal CDF of tail_alpha / 2); 0.75 -> 0.3186, 0.05 -> 1.96."""
    return abs(NormalDist().inv_cdf(tail_alpha / 2.0))


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every DOUBLE/FLOAT column (stable output for checks)."""
    repl = {f.name: F.round(F.col(f.name).cast("double"), digits)
            for f in df.schema.fields if isinstance(f.dataType, _FRACTIONAL)}
    return df.withColumns(repl) if repl else df
