"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

ColumnOrName = Column | str

_WHOLE = r"^[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*$"
_REAL = r"(?i)\p{Nd}|inf|nan"
_DIGIT = r"\p{Nd}"
# What a text must look like at least to be read as each type.
POSSIBLE = {
    **dict.fromkeys(("tinyint", "smallint", "int", "bigint"), _WHOLE),
    **dict.fromkeys(("float", "double"), _REAL),
    **dict.fromkeys(("decimal", "date", "timestamp", "timestamp_ntz"), _DIGIT),
}


def as_column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def read_as(value: Column, kind: DataType | str, source: str = "string") -> Column:
    """``try_cast`` that does not pay for an error on each text that is plainly wrong.

    A failed cast raises and catches an error inside Spark, which is slow when many
    rows are bad. Texts that cannot be of the wanted type are set to NULL by a
    pattern before; whatever passes is still cast with ``try_cast``.
    """
    name = kind if isinstance(kind, str) else kind.simpleString()
    pattern = POSSIBLE.get(name.split("(")[0]) if source == "string" else None
    cast = value.try_cast(kind)
    return cast if pattern is None else F.when(value.rlike(pattern), cast)


def join_null_safe(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join in which NULL keys match; the right side's keys are dropped."""
    if not keys:
        raise ValueError("join_null_safe needs at least one key")
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    matched = left.join(
        renamed, all_of([F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]), how
    )
    return matched.drop(*[f"__r_{k}" for k in keys])


def money(value: ColumnOrName) -> Column:
    """A two-place decimal, so that sums do not depend on the order of adding."""
    return as_column(value).cast("decimal(18,2)")


def cents(value: ColumnOrName) -> Column:
    """A two-place amount as whole hundredths.

    Sums of these are exact in any order and cheaper than decimal ones, up to 9.2e16 units.
    """
    return F.rint(as_column(value) * 100).cast("bigint")


def total(value: ColumnOrName) -> Column:
    """The exact sum of a two-place amount, rounded once to a double.

    High and low bits of the hundredths are added apart, so sums up to 9e22 units are exact.
    """
    whole = cents(value)
    high, low = F.sum(F.shiftright(whole, 20)), F.sum(whole.bitwiseAND(F.lit(2**20 - 1)))
    exact = high.cast("decimal(20,0)") * F.lit(2**20) + low.cast("decimal(20,0)")
    return (exact * F.lit(Decimal("0.01"))).cast("double")


def day_text(value: ColumnOrName) -> Column:
    return F.date_format(as_column(value), "yyyy-MM-dd")
