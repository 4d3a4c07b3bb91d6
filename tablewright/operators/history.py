"""Snapshot comparison, type-2 history, upsert and incremental load."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.strings import row_hash
from tablewright.operators.common import ColumnOrName, all_of, any_of
from tablewright.operators.ranking import first_rows

OPEN = ("start_date", "end_date", "is_current", "hash")


def snapshot_diff(
    previous: DataFrame,
    current: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str] | None = None,
    include_unchanged: bool = False,
) -> DataFrame:
    """Rows added, deleted and modified between two snapshots of one table.

    One full outer join. NULLs compare as values. ``changed_columns`` names what
    differs; a deleted row shows its previous values.
    """
    columns = list(compare) if compare is not None else [c for c in current.columns if c not in keys]
    a = previous.select(*keys, F.struct(*columns).alias("__was"))
    b = current.select(*keys, F.struct(*columns).alias("__is"))
    both = b.alias("b").join(
        a.alias("a"), all_of([F.col(f"b.{k}").eqNullSafe(F.col(f"a.{k}")) for k in keys]), "full"
    )
    differs = {c: ~F.col(f"__is.{c}").eqNullSafe(F.col(f"__was.{c}")) for c in columns}
    kind = (
        F.when(F.col("__was").isNull(), "Added")
        .when(F.col("__is").isNull(), "Deleted")
        .when(any_of(list(differs.values())), "Modified")
        .otherwise("Unchanged")
    )
    names = F.concat_ws(",", *[F.when(d, F.lit(c)) for c, d in differs.items()])
    made = both.select(
        *[F.coalesce(f"b.{k}", f"a.{k}").alias(k) for k in keys],
        *[
            F.when(F.col("__is").isNull(), F.col(f"__was.{c}")).otherwise(F.col(f"__is.{c}")).alias(c)
            for c in columns
        ],
        kind.alias("change_type"),
        F.when(kind == "Modified", names).alias("changed_columns"),
    )
    return made if include_unchanged else made.filter(F.col("change_type") != "Unchanged")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[ColumnOrName]
) -> DataFrame:
    """One row per key, the first in a total order."""
    return first_rows(df, keys, order, 1)


def upsert(base: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Changed rows replace the base rows of their key; new keys are added. A NULL key equals NULL."""
    same = all_of([F.col(f"b.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys])
    kept = base.alias("b").join(changes.select(*keys).alias("c"), same, "left_anti").select(*base.columns)
    return kept.unionByName(changes.select(*base.columns))


def open_history(df: DataFrame, keys: Sequence[str], tracked: Sequence[str], as_of: str) -> DataFrame:
    """First version of every key."""
    return df.select(
        *keys,
        *tracked,
        F.lit(as_of).cast("date").alias("start_date"),
        F.lit(None).cast("date").alias("end_date"),
        F.lit(True).alias("is_current"),
        row_hash(tracked).alias("hash"),
    )


def scd2_merge(
    history: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    as_of: str | dt.date,
    close_missing: bool = False,
) -> DataFrame:
    """Fold a batch into a type-2 history.

    A changed key closes its current version at ``as_of`` and opens a new one; a
    new key opens one; an equal key stays. Keys missing from the batch stay, or are
    closed with ``close_missing``. Closed versions are kept. Running the same batch
    again changes nothing. ``incoming`` holds each key once (see
    ``latest_per_key``); a repeated key fails the job, as two versions would be
    current. Values are compared NULL-safe, and the hash is stored beside them.
    """
    as_of = str(as_of)
    day = F.lit(as_of).cast("date")
    columns = [*keys, *tracked, *OPEN]
    current = history.filter("is_current").select(*columns)
    closed = history.filter(~F.coalesce("is_current", F.lit(False))).select(*columns)
    old = current.select(*keys, F.struct(*tracked, *OPEN).alias("__old"))
    found = F.struct(*tracked, row_hash(tracked).alias("hash"))
    new = incoming.groupBy(*keys).agg(F.first(found).alias("__new"), F.count(F.lit(1)).alias("__rows"))
    twice = F.raise_error(F.lit("a key occurs more than once in the incoming rows"))
    new = new.select(*keys, F.when(F.col("__rows") == 1, F.col("__new")).otherwise(twice).alias("__new"))
    both = old.alias("o").join(
        new.alias("n"), all_of([F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]), "full"
    )
    has_old, has_new = F.col("__old").isNotNull(), F.col("__new").isNotNull()
    differs = any_of([~F.col(f"__old.{c}").eqNullSafe(F.col(f"__new.{c}")) for c in tracked])
    changed = has_old & has_new & differs
    closes = changed | (has_old & ~has_new) if close_missing else changed

    def version(values: str, start: Column, end: Column, is_open: Column) -> Column:
        return F.struct(
            *[F.col(f"{values}.{c}").alias(c) for c in tracked],
            start.alias("start_date"),
            end.alias("end_date"),
            is_open.alias("is_current"),
            F.col(f"{values}.hash").alias("hash"),
        )

    end = F.col("__old.end_date")
    kept = version(
        "__old", F.col("__old.start_date"), F.when(closes, day).otherwise(end), ~closes
    )
    opened = version("__new", day, F.lit(None).cast("date"), F.lit(True))
    versions = F.array_compact(
        F.array(F.when(has_old, kept), F.when(~has_old | changed, opened))
    )
    merged = both.select(
        *[F.coalesce(f"o.{k}", f"n.{k}").alias(k) for k in keys], F.explode(versions).alias("v")
    ).select(*keys, "v.*")
    return closed.unionByName(merged.select(*columns))


def incremental(df: DataFrame, watermark_col: str, since, inclusive: bool = False) -> DataFrame:
    """Rows past the high-water mark; the filter reaches the file scan.

    With ``inclusive`` the rows at the mark come again, to be folded in by ``upsert``: rows that
    arrived with the mark's value after it was taken are then not lost.
    """
    mark = F.col(watermark_col)
    return df.filter(mark >= F.lit(since) if inclusive else mark > F.lit(since))


def high_water_mark(df: DataFrame, watermark_col: str):
    """The mark to keep for the next load."""
    return df.agg(F.max(watermark_col)).first()[0]


def merge_totals(
    saved: DataFrame, fresh: DataFrame, keys: Sequence[str], sums: Sequence[str]
) -> DataFrame:
    """Add the totals of new rows to saved totals (incremental refresh)."""
    both = saved.select(*keys, *sums).unionByName(fresh.select(*keys, *sums))
    return both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])

