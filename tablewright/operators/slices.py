"""Cutting rows into stretches of an order, by expressions.

Cut points are read off a sample of the order columns; the number of the stretch that a row is in is
then an expression over its own values (a balanced tree of comparisons). So nothing has to be written out for
the numbers to stay the same: a task that runs again, or a second scan, gives the same. The
sample only decides how even the stretches are, never what comes out.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.common import ColumnOrName

MOST = 1024  # stretches: the expression has as many leaves
PER_CUT = 48  # sampled rows for each cut point
_SIMPLE = re.compile(r"^(tinyint|smallint|int|bigint|float|double|decimal.*|string|date|timestamp|timestamp_ntz|boolean)$")
_ORDERED = re.compile(r"^(.*?)(?: (ASC|DESC) NULLS (FIRST|LAST))?$", re.S)


@dataclass(frozen=True)
class Place:
    """One column of an order: its name, direction, and where NULLs stand."""

    name: str
    kind: str
    descending: bool = False
    nulls_last: bool = False

    def literal(self, value: Any) -> Column:
        # a time without a zone must not pass through the zone of the Python process
        return F.lit(str(value)).cast(self.kind) if self.kind == "timestamp_ntz" else F.lit(value)

    def column(self) -> Column:
        column = F.col(self.name)
        if self.descending:
            return column.desc_nulls_last() if self.nulls_last else column.desc_nulls_first()
        return column.asc_nulls_last() if self.nulls_last else column.asc_nulls_first()

    def before(self, value: Any) -> Column:
        """True for rows whose value stands before ``value`` in this order."""
        column = F.col(self.name)
        if value is None:
            return F.lit(False) if not self.nulls_last else column.isNotNull()
        nulls = F.lit(not self.nulls_last)
        side = column > self.literal(value) if self.descending else column < self.literal(value)
        return F.coalesce(side, nulls)

    def same(self, value: Any) -> Column:
        return F.col(self.name).eqNullSafe(F.lit(None) if value is None else self.literal(value))


def places(df: DataFrame, order: Sequence[ColumnOrName]) -> list[Place] | None:
    """The leading columns of an order that stretches can be cut by; None if there is none.

    An entry is a column of ``df``, by name or with a direction. What follows an entry that is no
    simple column does not take part in the cuts.
    """
    kinds, out = dict(df.dtypes), []
    for item in order:
        text = item if isinstance(item, str) else str(item)[len("Column<'") : -len("'>")]
        name, way, nulls = _ORDERED.match(text).groups()
        if name not in kinds or not _SIMPLE.match(kinds[name]):
            break
        out.append(Place(name, kinds[name], way == "DESC", (nulls or "FIRST") == "LAST"))
    return out or None


def leading_bound(place: Place, low: Any, high: Any) -> Column:
    """A plain comparison of the first column, which a scan can use, for rows from ``low`` to ``high``."""
    column, found = F.col(place.name), F.lit(True)
    if low is not None and not place.nulls_last:
        found = column <= place.literal(low) if place.descending else column >= place.literal(low)
    if high is not None and place.nulls_last:
        found = found & (column >= place.literal(high) if place.descending else column <= place.literal(high))
    return found


def row_before(order: Sequence[Place], cut: Sequence[Any]) -> Column:
    """True for rows that stand before the point ``cut``."""
    found = F.lit(False)
    for k, (place, value) in enumerate(reversed(list(zip(order, cut)))):
        found = place.before(value) | (place.same(value) & found) if k else place.before(value)
    return found


def stretch(order: Sequence[Place], cuts: Sequence[Sequence[Any]]) -> Column:
    """How many of the ascending ``cuts`` a row does not stand before."""

    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(row_before(order, cuts[middle]), tree(low, middle)).otherwise(tree(middle + 1, high))

    return tree(0, len(cuts))


def cut_points(df: DataFrame, order: Sequence[Place], n: int, rows: int) -> list[tuple]:
    """At most ``n`` - 1 points that cut about ``rows`` rows into even stretches.

    Read off a sample of about ``PER_CUT`` rows for each point, of the order columns alone.
    """
    n = min(n, MOST, max(rows, 1))
    if n < 2:
        return []
    share = min(1.0, PER_CUT * n / rows)
    slim = df.select(*[p.name for p in order])
    if share < 1.0:
        slim = slim.sample(share, 17)
    sampled = slim.orderBy(*[p.column() for p in order]).collect()
    at = sorted({len(sampled) * k // n for k in range(1, n)})
    cuts: list[tuple] = []
    last: tuple | None = None
    for k in at:
        row = tuple(sampled[k]) if k < len(sampled) else last
        if row != last:
            # as few columns as tell the point from the one before: a cut need not be a row
            size = 1 if last is None else next(i for i in range(len(row)) if row[i] != last[i]) + 1
            cuts.append(row[:size])
            last = row
    return cuts


def number_of_tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def large_groups(df: DataFrame, keys: Sequence[str], share: float) -> tuple[int, list[int]]:
    """(rows, hashes of the groups that may hold ``share`` of them), in one pass without a shuffle of keys.

    Each task keeps a frequent-items summary of bounded size, and the summaries are merged. With
    8 / ``share`` items a summary is wrong by less than half the share, so every group above it is
    listed; some that hold more than about half of it may be too.
    """
    held = min(1_000_000, max(64, int(8 / share)))
    top = F.call_function("approx_top_k", F.xxhash64(*keys), F.lit(held), F.lit(held))
    rows, found = df.agg(F.count(F.lit(1)), top).first()
    return rows, [item["item"] for item in found if item["count"] >= rows * share / 2]


