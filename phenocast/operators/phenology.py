"""Status observations -> first event per group."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def site_species_filter(df: DataFrame, equals: dict) -> DataFrame:
    """Rows where every ``column == value`` of ``equals`` holds."""
    cond = F.lit(True)
    for c, v in equals.items():
        cond = cond & (F.col(c) == F.lit(v))
    return df.where(cond)


def site_species_complement(df: DataFrame, equals: dict) -> DataFrame:
    """Exact complement of :func:`site_species_filter`.

    A row for which the filter is not true is *kept* here, so a row whose key is
    NULL is (plain ``!=`` would drop it from both), and every row if a given value
    is None.
    """
    cond = F.lit(True)
    for c, v in equals.items():
        cond = cond & (F.col(c) == F.lit(v))
    return df.where(~F.coalesce(cond, F.lit(False)))


def split_by_keys(df: DataFrame, equals: dict) -> tuple[DataFrame, DataFrame]:
    """Partition into (matching, rest) over one lineage (U4)."""
    return site_species_filter(df, equals), site_species_complement(df, equals)


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                    carry: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the row that is smallest by ``order``.

    ``order`` must end in columns that make it a total order, so the choice is
    deterministic.  Implemented as ``min(struct(order..., carry...))`` per
    group: the aggregate is combined map-side before the shuffle, so a hot
    group (a third of all rows under one key) is reduced to one row per input
    partition instead of being sorted inside a single task, as a
    ``row_number`` window would do.
    """
    keys, order = list(keys), list(order)
    if carry is None:
        carry = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      *[F.col(c) for c in carry if c not in order])
    best = df.groupBy(*keys).agg(F.min(packed).alias("_best"))
    out = [F.col(k) for k in keys]
    out += [F.col(f"_best._o{i}").alias(c) for i, c in enumerate(order) if c not in keys]
    out += [F.col(f"_best.{c}") for c in carry if c not in order and c not in keys]
    return best.select(*out)


def first_event_per_group(df: DataFrame, keys: Sequence[str], flag: str,
                          order: Sequence[str], flag_value=1,
                          drop_flag: bool = True) -> DataFrame:
    """First row with ``flag == flag_value`` in each group (W1 with P3).

    Groups without such a row produce nothing (only 0/-1 statuses -> no row).
    """
    yes = df.where(F.col(flag) == F.lit(flag_value))
    if drop_flag:
        yes = yes.drop(flag)
    return first_per_group(yes, keys, order)


def first_bloom(status: DataFrame, species: str = "Species_ID", site: str = "Site_ID",
                date: str = "Observation_Date", doy: str = "Day_of_Year",
                status_col: str = "Phenophase_Status",
                tie_break: Sequence[str] = (), location: str = "location",
                year: str = "year") -> DataFrame:
    """First 'yes' observation per (species, site, year), with location = site.

    Species stays in the output (two species at one site give two rows).
    """
    df = status.withColumns({
        year: F.year(date).cast("int"),
        location: F.col(site).cast("string"),
    })
    return first_event_per_group(df, [species, site, year], status_col,
                                 [doy, date, *tie_break])


def dedupe_points(df: DataFrame, point_cols: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep-first de-duplication on coordinates by an explicit order."""
    return first_per_group(df, point_cols, order)


def distinct_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct key combinations."""
    return df.select(*cols).distinct()


def day_of_year_check(df: DataFrame, date: str, doy: str,
                      out: str = "doy_matches") -> DataFrame:
    """Compare a given 1-based day-of-year with the one of its date."""
    return df.withColumns({
        "date_doy": F.dayofyear(date).cast("int"),
    }).withColumn(out, F.col(doy).cast("int") == F.col("date_doy"))


def status_code(c: Column | str, yes, no, unsure) -> Column:
    """Map raw status values to 1 / 0 / -1."""
    c = F.col(c) if isinstance(c, str) else c
    return (F.when(c == F.lit(yes), 1).when(c == F.lit(no), 0)
            .when(c == F.lit(unsure), -1).cast("int"))
