"""Number columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def digital_root(value: Column | str) -> Column:
    """The repeated digit sum of a whole number, in closed form."""
    n = F.abs(_col(value))
    return F.when(n == 0, 0).otherwise(1 + F.pmod(n - 1, F.lit(9))).cast("int")


def percent_of(part: Column | str, whole: Column | str, places: int = 2) -> Column:
    """``part`` in percent of ``whole``; NULL for a whole of zero."""
    return F.round(_col(part) / F.nullif(_col(whole), F.lit(0)) * 100, places)


def parity(value: Column | str) -> Column:
    """``even`` or ``odd``; NULL stays NULL."""
    rest = F.pmod(_col(value), F.lit(2))
    return F.when(rest == 0, "even").when(rest == 1, "odd")
