"""Date and time expressions.

Raw inputs carry dates as text in two shapes, ISO ``yyyy-MM-dd`` and
``M/d/yy`` (sometimes mixed inside one file).  A two-digit year is ambiguous:
Spark's ``yy`` maps it into 2000-2099, so ``2/10/92`` would become 2092.  When
the row carries its own ``year`` column we splice that year in before parsing;
otherwise a pivot decides the century.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ISO_DATE = "yyyy-MM-dd"
SLASH_DATE_FULL_YEAR = "M/d/yyyy"
SUN_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss"

_TWO_DIGIT_TAIL = r"^(\d{1,2}/\d{1,2}/)(\d{2})$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_mixed_date(text: Column | str, year: Column | str | None = None,
                     pivot: int = 50) -> Column:
    """Text -> DATE for ISO and ``M/d/yy`` (or ``M/d/yyyy``) values.

    ``year``: column holding the true year of the row; replaces a two-digit
    year.  Without it, ``yy < pivot`` means 20yy and ``yy >= pivot`` 19yy.
    Unparseable text gives NULL (never an exception under ANSI mode).
    """
    t = F.trim(_col(text))
    iso = F.try_to_timestamp(t, F.lit(ISO_DATE))
    two_digit = F.regexp_extract(t, _TWO_DIGIT_TAIL, 2)
    if year is not None:
        full_year = _col(year).cast("int").cast("string")
    else:
        yy = two_digit.try_cast("int")
        full_year = F.when(yy >= pivot, yy + 1900).otherwise(yy + 2000).cast("string")
    repaired = F.when(
        two_digit != "",
        F.concat(F.regexp_extract(t, _TWO_DIGIT_TAIL, 1), full_year),
    ).otherwise(t)
    slash = F.try_to_timestamp(repaired, F.lit(SLASH_DATE_FULL_YEAR))
    return F.coalesce(iso, slash).cast("date")


def parse_timestamp(text: Column | str, fmt: str = SUN_TIMESTAMP) -> Column:
    """Text -> wall-clock TIMESTAMP_NTZ with a fixed pattern (NULL when it does not match).

    Local times without a zone stay zone-free, so differences between them do
    not depend on the session time zone or its daylight-saving shifts.
    """
    return F.try_to_timestamp(_col(text), F.lit(fmt)).cast("timestamp_ntz")


def day_length_seconds(sunrise: Column | str, sunset: Column | str) -> Column:
    """Seconds between two timestamps as DOUBLE (may be negative)."""
    return F.timestamp_diff("SECOND", _col(sunrise), _col(sunset)).cast("double")


def calendar_parts(df: DataFrame, date_col: str, year_col: str = "year",
                   month_col: str = "month") -> DataFrame:
    """Add integer ``year`` and ``month`` columns derived from ``date_col``."""
    return df.withColumns({
        year_col: F.year(date_col).cast("int"),
        month_col: F.month(date_col).cast("int"),
    })
