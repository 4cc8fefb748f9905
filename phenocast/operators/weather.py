"""Daily measurements -> yearly / monthly feature tables."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenocast.functions.dates import day_length_seconds, parse_timestamp

MONTHS = list(range(1, 13))


def month_column(feature: str, month: int) -> str:
    """Wide column name of a monthly feature: ``tempmax_03``."""
    return f"{feature}_{month:02d}"


def add_day_length(df: DataFrame, sunrise: str = "sunrise", sunset: str = "sunset",
                   out: str = "day_length", parse: bool = True) -> DataFrame:
    """Seconds of daylight; text timestamps are parsed with the fixed pattern."""
    a, b = F.col(sunrise), F.col(sunset)
    if parse:
        a, b = parse_timestamp(a), parse_timestamp(b)
    return df.withColumn(out, day_length_seconds(a, b))


def with_location(df: DataFrame, file_col: str | None = None, name_col: str = "name",
                  order: Sequence[str] = (), out: str = "location",
                  name: str | None = None) -> DataFrame:
    """Constant location column.

    ``name`` given: that literal.  Otherwise every row gets the ``name_col``
    of the first row (by ``order``) of its file/group ``file_col``; the
    per-file names are a one-row-per-file aggregate joined back.
    """
    if name is not None:
        return df.withColumn(out, F.lit(name))
    first = df.groupBy(file_col).agg(
        F.min_by(name_col, F.struct(*[F.col(c) for c in order] or [F.col(name_col)])).alias(out))
    return df.join(first, on=file_col, how="inner")


def yearly_means_named(df: DataFrame, file_col: str, name_col: str, date_col: str,
                       measures: Sequence[str], order: Sequence[str] = (),
                       out: str = "location", year_col: str = "year") -> DataFrame:
    """Yearly means per file, labelled with the name of the file's first row (A1 + P8).

    The first row of each (file, year) is kept inside the same aggregation
    (a partial ``min`` of a struct), and the per-file minimum over those is a
    window over the small aggregated table - the daily rows are scanned and
    shuffled once and never joined back.
    """
    order = list(order) or [date_col]
    first = F.min(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                           F.col(name_col).alias("_name"))).alias("_first")
    per_year = (df.withColumn(year_col, F.year(date_col).cast("int"))
                  .groupBy(file_col, year_col)
                  .agg(*[F.avg(m).alias(m) for m in measures], first))
    from pyspark.sql import Window
    file_first = F.min("_first").over(Window.partitionBy(file_col))
    return (per_year.withColumn(out, file_first.getField("_name"))
                    .select(out, year_col, *measures))


def yearly_means(df: DataFrame, keys: Sequence[str], date_col: str,
                 measures: Sequence[str], year_col: str = "year") -> DataFrame:
    """Mean of each measure per (keys, year); NULLs are skipped (A1)."""
    return (df.withColumn(year_col, F.year(date_col).cast("int"))
              .groupBy(*keys, year_col)
              .agg(*[F.avg(m).alias(m) for m in measures]))


def monthly_means(df: DataFrame, keys: Sequence[str], date_col: str,
                  measures: Sequence[str], year_col: str = "year",
                  month_col: str = "month") -> DataFrame:
    """Long form: mean of each measure per (keys, year, month) (A2)."""
    return (df.withColumns({year_col: F.year(date_col).cast("int"),
                            month_col: F.month(date_col).cast("int")})
              .groupBy(*keys, year_col, month_col)
              .agg(*[F.avg(m).alias(m) for m in measures]))


def monthly_pivot(df: DataFrame, keys: Sequence[str], date_col: str,
                  measures: Sequence[str], year_col: str = "year",
                  months: Sequence[int] = MONTHS) -> DataFrame:
    """Wide form ``{measure}_{MM}``: one row per (keys, year) (A2 + A3).

    The month list is always passed, so Spark skips the distinct-values job,
    and the pivot runs as one aggregation with a map-side partial stage keyed
    by (keys, year, month).  A month with no rows yields NULL columns.
    """
    measures, months = list(measures), list(months)
    grouped = (df.withColumns({year_col: F.year(date_col).cast("int"),
                               "_month": F.month(date_col).cast("int")})
                 .groupBy(*keys, year_col).pivot("_month", months))
    wide = grouped.agg(*[F.avg(m).alias(m) for m in measures])
    if len(measures) == 1:
        renames = {str(mo): month_column(measures[0], mo) for mo in months}
    else:
        renames = {f"{mo}_{m}": month_column(m, mo) for mo in months for m in measures}
    wide = wide.withColumnsRenamed(renames)
    ordered = [month_column(m, mo) for m in measures for mo in months]
    return wide.select(*keys, year_col, *ordered)


def yearly_monthly_align(yearly: DataFrame, monthly: DataFrame,
                         keys: Sequence[str]) -> DataFrame:
    """Outer alignment of yearly extras and the monthly table on the keys."""
    return yearly.join(monthly, on=list(keys), how="full")


def weather_features(daily: DataFrame, location: str, date_col: str,
                     monthly: Sequence[str], yearly_extra: Sequence[str] = (),
                     year_col: str = "year", months: Sequence[int] = MONTHS) -> DataFrame:
    """The per-file feature table: yearly extras beside the monthly pivot (A1-A3 + J4).

    One partial aggregation keyed by (location, year, month) computes the
    monthly means and the sums and counts of the extra measures; a second,
    tiny aggregation per (location, year) pivots the months and rolls the
    extras up to yearly means (sum of sums / sum of counts).  No join: the
    outer alignment of yearly and monthly rows falls out of the shared keys.
    The monthly set's own yearly means are dead work in the source and are
    never computed.
    """
    monthly, extras, months = list(monthly), list(yearly_extra), list(months)
    if not extras:
        return monthly_pivot(daily, [location], date_col, monthly, year_col, months)
    per_month = (daily.withColumns({year_col: F.year(date_col).cast("int"),
                                    "_month": F.month(date_col).cast("int")})
                      .groupBy(location, year_col, "_month")
                      .agg(*[F.avg(m).alias(m) for m in monthly],
                           *[F.sum(e).alias(f"_sum_{e}") for e in extras],
                           *[F.count(e).alias(f"_cnt_{e}") for e in extras]))
    wide = per_month.groupBy(location, year_col).agg(
        *[F.try_divide(F.sum(f"_sum_{e}").cast("double"), F.sum(f"_cnt_{e}").cast("double")).alias(e)
          for e in extras],
        *[F.max(F.when(F.col("_month") == mo, F.col(m))).alias(month_column(m, mo))
          for m in monthly for mo in months])
    return wide.select(location, year_col, *extras,
                       *[month_column(m, mo) for m in monthly for mo in months])
