"""Running totals, neighbours and ranks that stay spread out on hot keys.

A plain ``Window.partitionBy(key)`` sends all rows of a key to one task. Here a summary pass finds the
groups that hold more than a task's share of the rows. Their rows are cut into even stretches of the order
(``slices``); the window works inside each stretch, and what the stretches before add is carried
forward: there is one total per stretch and group, so the window over those is small. All other groups
fit a task and take the plain window. A window over the whole table is one large group.
``bounded=True`` states that groups cannot grow with the data (days, months, distinct values of a
small domain) and leaves the summary pass out.

``order`` must be total within a group wherever single rows are told apart.
Sums of doubles depend on the order of adding in their last digits, here as
everywhere in Spark; whole numbers and decimals are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tablewright.operators.common import ColumnOrName, as_column, join_null_safe
from tablewright.operators.slices import MOST, cut_points, large_groups, number_of_tasks, places, stretch

SLICE = "__slice"
GROUP = "__group"
HASH = "__hash"


def parted(
    df: DataFrame, keys: Sequence[str], order: Sequence[ColumnOrName], slices: int | None = None
) -> tuple[DataFrame | None, DataFrame | None]:
    """(rows of groups that fit a task, rows of large groups with their stretch); None: no such rows.

    A group is large when it holds more than 1 / ``slices`` of all rows (``slices`` is the number of
    shuffle partitions unless given). Stretches are cut over all large groups together, in
    the order of (keys, order).
    """
    n = min(slices or number_of_tasks(df), MOST)
    group = F.struct(F.lit(0), *keys)
    if keys:
        rows, found = large_groups(df, keys, 1 / n)
        if not found:
            return df, None
        large = F.xxhash64(*keys).isin(found)
        small, df = df.filter(~large), df.filter(large)
    else:
        rows, small = df.count(), None
    placed = places(df, [*keys, *order])
    cuts = cut_points(df, placed, n, rows) if placed else []
    return small, df.withColumns({SLICE: stretch(placed, cuts) if placed else F.lit(0), GROUP: group})


def both_parts(small: DataFrame | None, large: DataFrame | None) -> DataFrame:
    if small is None or large is None:
        return large if small is None else small
    return small.unionByName(large)


def _add(a: Column, b: Column) -> Column:
    """Sum that is NULL only where both parts are."""
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[ColumnOrName],
    sums: Mapping[str, ColumnOrName],
    *,
    bounded: bool = False,
    slices: int | None = None,
) -> DataFrame:
    """Running totals row by row (ROWS frame), per key or over the whole table."""
    values = {name: as_column(v) for name, v in sums.items()}
    upto = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def plain(rows: DataFrame) -> DataFrame:
        return rows.withColumns({name: F.sum(v).over(upto) for name, v in values.items()})

    if bounded:
        return plain(df)
    small, large = parted(df, keys, order, slices)
    if large is None:
        return plain(small)
    types = {f.name: f.dataType for f in df.agg(*[F.sum(v).alias(n) for n, v in values.items()]).schema}
    # One struct per group key: equal NULLs match in a plain equi-join, and the join
    # reuses the partitioning of the window.
    cut = large.withColumns({f"__v_{n}": v for n, v in values.items()})
    inside = Window.partitionBy(SLICE, GROUP).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    earlier = Window.partitionBy(GROUP).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    rows = cut.withColumns({f"__i_{n}": F.sum(f"__v_{n}").over(inside) for n in values})
    totals = (
        cut.groupBy(SLICE, GROUP)
        .agg(*[F.sum(f"__v_{n}").alias(f"__t_{n}") for n in values])
        .select(SLICE, GROUP, *[F.sum(f"__t_{n}").over(earlier).alias(f"__b_{n}") for n in values])
    )
    made = {n: _add(F.col(f"__b_{n}"), F.col(f"__i_{n}")).cast(types[n]) for n in values}
    names = [*df.columns, *[n for n in values if n not in df.columns]]
    done = rows.join(totals, [SLICE, GROUP]).withColumns(made).select(*names)
    return both_parts(None if small is None else plain(small).select(*names), done)


def running_sum_with_peers(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, ColumnOrName],
    *,
    bounded: bool = False,
) -> DataFrame:
    """Running totals in which rows with equal order values share one total.

    This is the default (RANGE) frame. Peers are added up before the scan, so
    a heavy order value costs no more than a light one.
    """
    if set(sums) & {*keys, *order}:
        raise ValueError("a total may not be named like a key or an order column")
    peers = df.groupBy(*keys, *order).agg(*[F.sum(as_column(v)).alias(n) for n, v in sums.items()])
    totals = running_sum(peers, keys, order, {n: n for n in sums}, bounded=bounded)
    return join_null_safe(df, totals, [*keys, *order])


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[ColumnOrName],
    into: str,
    *,
    bounded: bool = False,
    slices: int | None = None,
) -> DataFrame:
    """1, 2, 3, ... in order, per key or over the whole table."""
    return running_sum(
        df, keys, order, {into: F.lit(1)}, bounded=bounded, slices=slices
    )


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[ColumnOrName],
    columns: Callable[[WindowSpec], Mapping[str, Column]],
    *,
    before: int = 0,
    after: int = 0,
    bounded: bool = False,
    slices: int | None = None,
) -> DataFrame:
    """Columns that look at most ``before`` rows back and ``after`` rows ahead.

    ``columns`` gets the ordered window and returns the new columns: lag, lead and aggregates over a
    bounded ROWS frame. In a large group, rows inside a stretch see their whole frame there. The
    first and last ``before`` + ``after`` rows of every stretch are put together once more: a row
    next to a cut has its frame among these.
    """
    whole = Window.partitionBy(*keys).orderBy(*order)
    small, large = (df, None) if bounded else parted(df, keys, order, slices)
    if large is None:
        return small.withColumns(dict(columns(whole)))
    inside = Window.partitionBy(SLICE, GROUP).orderBy(*order)
    every = Window.partitionBy(SLICE, GROUP)
    first, last = F.col("__first"), F.col("__count") - F.col("__first") + 1
    placed = large.withColumns({"__first": F.row_number().over(inside), "__count": F.count(F.lit(1)).over(every)})
    made = columns(inside)
    names = [*df.columns, *[n for n in made if n not in df.columns]]
    middle = placed.withColumns(dict(made)).filter((first > before) & (last > after)).select(*names)
    edge = placed.filter((first <= before + after) | (last <= before + after))
    near = Window.partitionBy(GROUP).orderBy(*order)
    ends = edge.withColumns(dict(columns(near))).filter((first <= before) | (last <= after)).select(*names)
    done = middle.unionByName(ends)
    return both_parts(None if small is None else small.withColumns(dict(columns(whole))).select(*names), done)


def rank_rows(
    df: DataFrame,
    keys: Sequence[str],
    by: str,
    *,
    tie_break: Sequence[ColumnOrName],
    descending: bool = True,
    rank: str | None = None,
    dense: str | None = None,
    unique: str | None = None,
    modified: str | None = None,
    bounded: bool = False,
    slices: int | None = None,
) -> DataFrame:
    """Up to four kinds of rank by the column ``by``, under the names given.

    ``rank`` leaves gaps after ties, ``dense`` does not, ``unique`` breaks ties by
    ``tie_break``, and ``modified`` gives tied rows the last of their places.
    """
    place = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_first()
    kinds = ("__rank", "__dense", "__unique", "__modified")
    wanted = {name: kind for name, kind in zip((rank, dense, unique, modified), kinds) if name}
    names = [*df.columns, *[n for n in wanted if n not in df.columns]]

    def ranked(rows: DataFrame, *parts: str) -> DataFrame:
        """All kinds inside each part, from one sort."""
        w = Window.partitionBy(*parts).orderBy(place)
        total = Window.partitionBy(*parts).orderBy(place, *tie_break)
        tied = w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
        numbered = rows.withColumn("__unique", F.row_number().over(total).cast("bigint"))  # its sort serves the others
        made = {"__rank": F.rank().over(w), "__dense": F.dense_rank().over(w), "__modified": F.count(F.lit(1)).over(tied)}
        return numbered.withColumns({kind: m.cast("bigint") for kind, m in made.items()})

    def named(rows: DataFrame) -> DataFrame:
        return rows.withColumns({name: F.col(kind) for name, kind in wanted.items()}).select(*names)

    small, large = (df, None) if bounded else parted(df, keys, [place, *tie_break], slices)
    if large is None:
        return named(ranked(small, *keys))
    inside = ranked(large, SLICE, GROUP)
    # Per stretch: its rows and values, and the first and last value with their places. From counted
    # values, so that the rows are sorted once.
    value = F.struct(F.col(by).alias("v"))
    counted = large.groupBy(SLICE, GROUP, value.alias("v")).agg(F.count(F.lit(1)).alias("c"))
    low, high = F.min(F.struct("v", "c")), F.max(F.struct("v", "c"))
    facts = counted.groupBy(SLICE, GROUP).agg(
        F.sum("c").alias("n"),
        F.count(F.lit(1)).alias("values"),
        (high if descending else low).alias("f"),
        (low if descending else high).alias("l"),
    )
    first = F.struct("f.v", F.lit(1).cast("bigint").alias("__rank"), F.col("f.c").alias("__modified"))
    last = F.struct("l.v", (F.col("n") - F.col("l.c") + 1).alias("__rank"), F.col("n").alias("__modified"))
    facts = facts.select(SLICE, GROUP, "n", "values", first.alias("first"), last.alias("last"))
    along = Window.partitionBy(GROUP).orderBy(SLICE)
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    goes_on = F.coalesce(F.lag("last.v").over(along) == F.col("first.v"), F.lit(False)).cast("int")
    facts = facts.withColumns({"shared": goes_on, "base": F.coalesce(F.sum("n").over(earlier), F.lit(0))})
    facts = facts.withColumn(
        "dense_base",
        F.coalesce(F.sum("values").over(earlier), F.lit(0))
        - F.sum("shared").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    )
    # A value on both sides of a cut begins where it first stands and ends where it last does.
    side = F.explode(F.array(F.struct(F.lit(0).alias("s"), "first.*"), F.struct(F.lit(1).alias("s"), "last.*")))
    ends = facts.select(SLICE, GROUP, "base", "dense_base", side.alias("end"))
    same = Window.partitionBy(GROUP, "end.v")
    span = F.struct(
        F.min(F.col("base") + F.col("end.__rank")).over(same).alias("from"),
        F.max(F.col("base") + F.col("end.__modified")).over(same).alias("upto"),
    )
    edge = F.struct("end.v", "span.*")
    facts = (
        ends.withColumn("span", span)
        .groupBy(SLICE, GROUP, "base", "dense_base")
        .agg(
            F.max(F.when(F.col("end.s") == 0, edge)).alias("at_first"),
            F.max(F.when(F.col("end.s") == 1, edge)).alias("at_last"),
        )
    )
    joined = inside.join(facts, [SLICE, GROUP])
    edge = F.when(value == F.col("at_first.v"), F.col("at_first")).when(value == F.col("at_last.v"), F.col("at_last"))
    joined = joined.withColumn("__edge", edge).withColumns(
        {
            "__unique": F.col("base") + F.col("__unique"),
            "__dense": F.col("dense_base") + F.col("__dense"),
            "__rank": F.coalesce("__edge.from", F.col("base") + F.col("__rank")),
            "__modified": F.coalesce("__edge.upto", F.col("base") + F.col("__modified")),
        }
    )
    return both_parts(None if small is None else named(ranked(small, *keys)), named(joined))


def capacity_cutoff(
    df: DataFrame,
    order: Sequence[str],
    weight: str,
    limit,
    keys: Sequence[str] = (),
    into: str = "running",
    *,
    bounded: bool = False,
) -> DataFrame:
    """The last row, in order, whose running weight stays within ``limit``.

    Weights are taken to be positive, as for a queue: the row is the one with the
    largest running weight. The row is picked by an aggregate, not by a sort.
    """
    totals = running_sum(df, keys, order, {into: weight}, bounded=bounded)
    within = totals.filter(F.col(into) <= limit)
    rest = [c for c in df.columns if c not in (*keys, *order)]
    last = F.max(F.struct(into, *order, *rest)).alias("__row")
    picked = within.groupBy(*keys).agg(last).select(*keys, "__row.*")
    return picked.filter(F.col(into).isNotNull()).select(*df.columns, into)
