"""Training-set assembly: lag join, union, gap filling, summaries."""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)

# Fixed value: column order of the event table in the training set.
BLOOM_COLUMNS = ["location", "year", "bloom_doy", "lat", "long", "bloom_date", "alt"]


def lag_year_join(events: DataFrame, features: DataFrame, location: str = "location",
                  year: str = "year", lag: int = 1, date_col: str | None = "bloom_date",
                  event_cols: Sequence[str] | None = None) -> DataFrame:
    """Each event beside the feature row of the same location ``lag`` years earlier.

    Inner equi-join on (location, year - lag): events without earlier
    features produce no row.  The output ``year`` is re-derived from
    ``date_col`` when given, as in the source pipeline.  The feature side's
    own year column is dropped.
    """
    event_cols = list(event_cols or [c for c in events.columns])
    ev = events.select(*event_cols).withColumn("_pred_year", F.col(year) - F.lit(lag))
    feat = features.withColumnRenamed(year, "_pred_year")
    joined = ev.join(feat, on=[location, "_pred_year"], how="inner").drop("_pred_year")
    if date_col is not None:
        joined = joined.withColumn(year, F.year(date_col).cast("int"))
    feature_cols = [c for c in features.columns if c not in (location, year)]
    return joined.select(*event_cols, *feature_cols)


def union_locations(frames: Sequence[DataFrame]) -> DataFrame:
    """Union all by column name; missing columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, _NUMERIC) and f.name not in set(exclude)]


def fill_with_means(df: DataFrame, cols: Sequence[str] | None = None,
                    fit_on: DataFrame | None = None) -> DataFrame:
    """Fill NULLs of numeric columns with the column mean.

    Columns are cast to DOUBLE first so a fractional mean is not truncated in
    an integer column.  ``fit_on`` chooses the rows the means come from
    (default: ``df`` itself; pass the training part to avoid leakage).  The
    means are one global aggregate (partial per task); only those scalars
    reach the driver and go back into the plan as literals.
    """
    cols = list(cols) if cols is not None else numeric_columns(df)
    src = fit_on if fit_on is not None else df
    means = src.agg(*[F.avg(F.col(c).cast("double")).alias(f"_mean_{i}")
                      for i, c in enumerate(cols)]).first()
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"),
                                         F.lit(means[f"_mean_{i}"]).cast("double"))
                           for i, c in enumerate(cols)})


def training_summary(df: DataFrame, location: str = "location") -> DataFrame:
    """Rows and distinct locations of a training set."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_distinct(location).alias("n_locations"))


def location_points(df: DataFrame, lat: str = "lat", long: str = "long") -> DataFrame:
    """Distinct coordinates with their row counts."""
    return df.groupBy(lat, long).agg(F.count(F.lit(1)).alias("n_rows"))


def value_counts(df: DataFrame, col: str, out: str = "n") -> DataFrame:
    """Rows per value, NULL values dropped, most frequent first."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).alias(out)).orderBy(F.desc(out), col))


def alias_locations(df: DataFrame, aliases: DataFrame, location: str = "location",
                    key: str = "key", alias: str = "alias") -> DataFrame:
    """Rename locations through an alias table; unknown names stay as they are."""
    a = aliases.select(F.col(key).alias("_alias_key"), F.col(alias).alias("_alias"))
    j = df.join(a, df[location] == a["_alias_key"], "left")
    return j.withColumn(location, F.coalesce(F.col("_alias"), F.col(location))) \
            .drop("_alias_key", "_alias")


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename all columns by position (P5)."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def year_consistency(df: DataFrame, year: str = "year", date_col: str = "bloom_date") -> DataFrame:
    """Data-quality check: rows whose ``year`` differs from the year of ``date_col`` (Q4).

    One aggregation pass: rows checked, rows with a mismatch, rows without a date.
    """
    y = F.year(date_col).cast("int")
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_if(F.col(date_col).isNotNull() & (y != F.col(year))).alias("n_mismatch"),
                  F.count_if(F.col(date_col).isNull()).alias("n_missing_date"))
