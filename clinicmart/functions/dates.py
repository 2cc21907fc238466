"""Calendar arithmetic. All inputs are dates or timestamps without zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clinicmart.schema import DAY_NAMES, DAYS_PER_YEAR, MONTH_NAMES

_MICROS_PER_DAY = 86_400_000_000


def day(col: Column) -> Column:
    return F.to_date(col)


def date_key(col: Column) -> Column:
    """``yyyyMMdd`` as a whole number, by arithmetic rather than by formatting."""
    parts = F.year(col) * 10_000 + F.month(col) * 100 + F.dayofmonth(col)
    return parts.cast("bigint")


def iso_weekday(col: Column) -> Column:
    """Monday is 1."""
    return F.weekday(col) + 1


def month_name(month: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in MONTH_NAMES]), month)


def day_name(weekday: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in DAY_NAMES]), weekday)


def whole_days(start: Column, end: Column) -> Column:
    """Days from start to end, rounded down, also for negative spans."""
    micros = F.timestamp_diff("MICROSECOND", start.cast("timestamp_ntz"), end.cast("timestamp_ntz"))
    span = F.lit(_MICROS_PER_DAY)
    return F.rint((micros - F.pmod(micros, span)) / span).cast("bigint")


def age_years(birth: Column, as_of: Column) -> Column:
    """Whole years at ``as_of``; a missing birth date counts as 0."""
    years = (whole_days(birth, as_of) / F.lit(DAYS_PER_YEAR)).cast("int")
    return F.coalesce(years, F.lit(0))


def period(year: Column, month: Column) -> Column:
    """``YYYY-MM``."""
    return F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"))
