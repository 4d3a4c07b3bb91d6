"""Grouped aggregation. All stages combine rows before they are shuffled."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.common import ColumnOrName, as_column, join_null_safe
from tablewright.operators.ordered import running_sum
from tablewright.session import settle


def count_by(
    df: DataFrame, by: Sequence[str], where: Column | str | None = None, into: str = "count"
) -> DataFrame:
    rows = df.filter(where) if where is not None else df
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias(into))


def period_totals(
    df: DataFrame,
    at: str,
    value: ColumnOrName,
    grain: Sequence[str] = ("year", "month"),
    keys: Sequence[str] = (),
    into: str = "total",
) -> DataFrame:
    """Sums per calendar period; grains are year, quarter, month and day."""
    parts = {"year": F.year, "quarter": F.quarter, "month": F.month, "day": F.dayofmonth}
    return df.groupBy(*keys, *[parts[g](at).alias(g) for g in grain]).agg(
        F.sum(as_column(value)).alias(into)
    )


def groups_with_members_holding(
    df: DataFrame,
    group: str,
    member: str,
    value: str,
    *,
    k: int | None = None,
    values: Sequence | None = None,
    min_members: int = 1,
) -> DataFrame:
    """Groups with at least ``min_members`` members that hold ``k`` distinct values,
    or all of ``values`` when those are listed."""
    rows = df.filter(F.col(value).isin(list(values))) if values is not None else df
    need = len(set(values)) if values is not None else k
    if need is None:
        raise ValueError("give k or values")
    held = rows.groupBy(group, member).agg(F.count_distinct(value).alias("__held"))
    full = held.filter(F.col("__held") == need)
    return (
        full.groupBy(group)
        .agg(F.count(F.lit(1)).alias("members"))
        .filter(F.col("members") >= min_members)
    )


def category_of(value: ColumnOrName, bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """The label of the half-open range [bound, next bound) a value falls in."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("one label more than bounds")
    column = as_column(value)
    chosen = F.when(column.isNull(), F.lit(None).cast("string"))
    for bound, label in zip(bounds, labels):
        chosen = chosen.when(column < bound, label)
    return chosen.otherwise(labels[-1])


def category_counts(
    df: DataFrame, value: str, bounds: Sequence[float], labels: Sequence[str]
) -> DataFrame:
    """Rows per category, with a zero for a category that has none."""
    counts = df.groupBy(category_of(value, bounds, labels).alias("category")).agg(
        F.count(value).alias("count")
    )
    listed = F.explode(F.array(*[F.lit(label) for label in labels])).alias("category")
    names = df.sparkSession.range(1).select(listed)
    return counts.join(names, "category", "right").select(
        "category", F.coalesce("count", F.lit(0)).alias("count")
    )


def duplicates(df: DataFrame, keys: Sequence[str], into: str = "copies") -> DataFrame:
    """Keys that occur more than once."""
    return count_by(df, keys, into=into).filter(F.col(into) > 1)


def median_by(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    into: str = "median",
) -> DataFrame:
    """Exact median per group, as a double; NULL for a group without values.

    Spark's own median holds the values of a group in one buffer. Here equal values
    are counted first, and a running count finds the middle ones.
    """
    counts = settle(df.groupBy(*keys, value).agg(F.count(value).alias("__n")))
    sizes = counts.groupBy(*keys).agg(F.sum("__n").alias("__size"))
    upto = running_sum(counts, keys, [value], {"__upto": "__n"})
    if keys:
        placed = join_null_safe(upto, sizes, keys)
    else:
        placed = upto.withColumn("__size", sizes.select("__size").scalar())
    low = F.floor((F.col("__size") + 1) / 2)
    high = F.floor((F.col("__size") + 2) / 2)
    first = F.col("__upto") - F.col("__n") + 1

    def holds(place: Column) -> Column:
        return F.max(F.when((first <= place) & (place <= F.col("__upto")), F.col(value)))

    middle = F.col("__low").cast("double") / 2 + F.col("__high").cast("double") / 2
    both = placed.groupBy(*keys).agg(holds(low).alias("__low"), holds(high).alias("__high"))
    return both.select(*keys, middle.alias(into))


def members_where_total(
    df: DataFrame, member: str, total: Column, condition: Column | str
) -> DataFrame:
    """Rows of the members whose aggregate, named ``total``, meets the condition."""
    chosen = df.groupBy(member).agg(total.alias("total")).filter(condition).select(member)
    return df.join(chosen, member, "left_semi")


def top_groups(
    df: DataFrame, by: str, size: Column, n: int, into: str = "size"
) -> DataFrame:
    """The ``n`` groups with the largest aggregate; ties go by the group key."""
    return df.groupBy(by).agg(size.alias(into)).orderBy(F.col(into).desc(), by).limit(n)


def status_counts(df: DataFrame, flags: Mapping[str, Column]) -> DataFrame:
    """Rows (status, count) for several conditions from one pass, plus the total."""
    made = df.agg(
        *[F.count_if(flag).alias(name) for name, flag in flags.items()],
        F.count(F.lit(1)).alias("total"),
    )
    return made.unpivot([], [*flags, "total"], "status", "count")


def pivot_totals(
    df: DataFrame, by: Sequence[str], column: str, values: Sequence[str], cell: Column
) -> DataFrame:
    """One row per group and one column per listed value; listing saves a pass."""
    return df.groupBy(*by).pivot(column, list(values)).agg(cell)


def row_with_max(df: DataFrame, keys: Sequence[str], value: str, *tie_break: str) -> DataFrame:
    """The row with the largest value per group, the tie broken by further columns."""
    rest = [c for c in df.columns if c not in (*keys, value, *tie_break)]
    packed = F.max(F.struct(value, *tie_break, *rest)).alias("__row")
    return df.groupBy(*keys).agg(packed).select(*keys, "__row.*").select(*df.columns)
