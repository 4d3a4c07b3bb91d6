"""Top rows per group, with and without ties.

Only distinct values are ranked; the rows follow by an equi-join on the value.
The filter on a row number lets Spark cut each task's rows to n per group before
the shuffle, so a hot group never meets in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewright.operators.common import ColumnOrName, all_of, join_null_safe
from tablewright.operators.slices import cut_points, leading_bound, places, row_before, stretch

SHALLOW = 100_000  # rows from the top that a task may hold for a page


def _place(by: str, descending: bool):
    return F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_first()


def first_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[ColumnOrName], n: int = 1
) -> DataFrame:
    """Exactly the first ``n`` rows per group in a total order (row_number <= n)."""
    if not keys:
        return df.orderBy(*order).limit(n)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= n).drop("__n")


def top_values(
    df: DataFrame, keys: Sequence[str], by: str, n: int, descending: bool = True
) -> DataFrame:
    """The ``n`` best distinct values per group: keys, value, rows and ranks."""
    counts = df.groupBy(*keys, by).agg(F.count(F.lit(1)).alias("rows"))
    best = first_rows(counts, keys, [_place(by, descending)], n)
    # At most n rows per group are left for this second window.
    w = Window.partitionBy(*keys).orderBy(_place(by, descending))
    earlier = F.sum("rows").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return best.withColumns(
        {
            "dense_rank": F.row_number().over(w).cast("bigint"),
            "rank": F.coalesce(earlier, F.lit(0)) + 1,
        }
    )


def top_with_ties(
    df: DataFrame,
    keys: Sequence[str],
    by: str,
    n: int,
    *,
    kind: str = "dense_rank",
    into: str | None = None,
    descending: bool = True,
) -> DataFrame:
    """Rows whose rank is at most ``n``; ``kind`` is ``rank`` or ``dense_rank``."""
    best = top_values(df, keys, by, n, descending).filter(F.col(kind) <= n)
    best = best.select(*keys, by, F.col(kind).alias(into or "__rank"))
    kept = join_null_safe(df, best, [*keys, by])
    return kept if into else kept.drop("__rank")


def nth_value_rows(
    df: DataFrame,
    keys: Sequence[str],
    by: str,
    n: int,
    *,
    or_last: bool = False,
    descending: bool = True,
) -> DataFrame:
    """Rows holding the n-th distinct value of their group.

    With ``or_last`` a group that has fewer values gives its last one.
    """
    best = top_values(df, keys, by, n, descending)
    if or_last:
        pick = F.max_by(by, "dense_rank")
        wanted = best.groupBy(*keys).agg(pick.alias(by)) if keys else best.agg(pick.alias(by))
    else:
        wanted = best.filter(F.col("dense_rank") == n).select(*keys, by)
    return join_null_safe(df, wanted, [*keys, by])


def ends(
    df: DataFrame, order: Sequence[str], n: int, into: str = "end", descending: bool = True
) -> DataFrame:
    """The best and the worst ``n`` rows, marked ``top`` and ``bottom``."""
    forward = [_place(c, descending) for c in order]
    backward = [_place(c, not descending) for c in order]
    top = df.orderBy(*forward).limit(n).withColumn(into, F.lit("top"))
    bottom = df.orderBy(*backward).limit(n).withColumn(into, F.lit("bottom"))
    return top.unionByName(bottom)


def page(
    df: DataFrame, order: Sequence[ColumnOrName], offset: int, n: int, shallow: int = SHALLOW, cuts: int = 32
) -> DataFrame:
    """Rows ``offset`` + 1 to ``offset`` + ``n`` in a total order.

    Up to ``shallow`` rows deep each task keeps its first rows only. Beyond that, rows are counted by
    stretches of the order, and only the stretches that hold the page are read again, cut
    anew until few enough rows are left to sort; see ``page_after`` for the page behind one.
    """
    placed = places(df, order)
    if offset + n <= shallow or placed is None:
        return df.orderBy(*order).offset(offset).limit(n)
    part, left = df, df.count()
    while left > shallow:
        points = cut_points(part, placed, cuts, left)
        counted = dict(part.groupBy(stretch(placed, points).alias("k")).count().collect())
        ends = list(accumulate(counted.get(k, 0) for k in range(len(points) + 1)))
        first = next((k for k, end in enumerate(ends) if end > offset), len(points))
        last = next((k for k, end in enumerate(ends) if end >= offset + n), len(points))
        before = ends[first - 1] if first else 0
        if ends[last] - before == left:  # no rows stand outside the stretches that hold the page
            break
        low, high = (points[first - 1] if first else None), (points[last] if last < len(points) else None)
        part = part.filter(leading_bound(placed[0], low and low[0], high and high[0]))
        if low:
            part = part.filter(~row_before(placed, low))
        if high:
            part = part.filter(row_before(placed, high))
        offset, left = offset - before, ends[last] - before
    return part.orderBy(*order).offset(offset).limit(n)


def page_after(df: DataFrame, order: Sequence[ColumnOrName], last: Sequence, n: int) -> DataFrame:
    """The ``n`` rows behind the row whose order columns have the values ``last``; no row before it is sorted."""
    placed = places(df, order)
    if placed is None or len(placed) != len(order):
        raise ValueError("the order must be of plain columns")
    here = all_of([p.same(v) for p, v in zip(placed, last)])
    behind = df.filter(leading_bound(placed[0], last[0], None)).filter(~row_before(placed, last) & ~here)
    return behind.orderBy(*order).limit(n)


def page_with_total(
    df: DataFrame, order: Sequence[ColumnOrName], offset: int, n: int, into: str = "total_rows"
) -> DataFrame:
    """One page of rows, each with the row count of the whole table."""
    total = df.agg(F.count(F.lit(1)))
    return page(df, order, offset, n).withColumn(into, total.scalar())


def largest_distinct(df: DataFrame, column: str, n: int) -> DataFrame:
    return df.select(column).distinct().orderBy(F.col(column).desc()).limit(n)
