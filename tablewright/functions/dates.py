"""Date columns. The present day always enters as ``as_of``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def day(as_of: str | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def parse_date(text: Column | str, pattern: str = "yyyy-MM-dd") -> Column:
    """A date, or NULL when the text does not fit the pattern."""
    return F.try_to_timestamp(_col(text), F.lit(pattern)).cast("date")


def parse_timestamp(text: Column | str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.try_to_timestamp(_col(text), F.lit(pattern))


def age_years(born: Column | str, as_of: str | None = None) -> Column:
    """Whole years by the calendar."""
    return F.floor(F.months_between(day(as_of), _col(born)) / 12).cast("int")


def age_years_by_days(born: Column | str, as_of: str | None = None) -> Column:
    """Whole years as days / 365.25, rounded down."""
    return F.floor(F.datediff(day(as_of), _col(born)) / F.lit(365.25)).cast("int")


def is_leap_year(year: Column | str) -> Column:
    y = _col(year)
    return ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)


def next_sunday(as_of: Column | str | None = None) -> Column:
    """The coming Sunday; a Sunday gives itself."""
    start = day(as_of) if as_of is None or isinstance(as_of, str) else as_of
    return F.next_day(F.date_sub(start, 1), "Sun")


def date_key(text: Column | str, pattern: str = "dd/MM/yyyy") -> Column:
    """A date text as the whole number yyyymmdd."""
    return F.date_format(parse_date(text, pattern), "yyyyMMdd").cast("int")


def hours_minutes_seconds(start: Column | str, end: Column | str) -> Column:
    """The time between two moments as ``h:mm:ss``; negative ones carry a sign."""
    seconds = F.timestamp_diff("SECOND", _col(start), _col(end))
    size = F.abs(seconds)
    text = F.format_string(
        "%d:%02d:%02d", F.floor(size / 3600), F.floor(size / 60) % 60, size % 60
    )
    return F.when(seconds < 0, F.concat(F.lit("-"), text)).otherwise(text)
