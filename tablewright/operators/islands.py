"""Gap-and-island runs and event pairing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.operators.common import read_as
from tablewright.operators.ordered import GROUP, SLICE, both_parts, parted


def _position(df: DataFrame, at: str) -> tuple[Column, int]:
    """A whole-number position of a date or timestamp, and its units per second (0: days)."""
    kind = dict(df.dtypes)[at]
    if kind == "date":
        return F.unix_date(at), 0
    if kind in ("timestamp", "timestamp_ntz"):
        origin = F.lit("1970-01-01 00:00:00").cast(kind)
        return F.timestamp_diff("MICROSECOND", origin, F.col(at)), 1_000_000
    raise TypeError(f"{at} is {kind}, not a date or timestamp")


def islands(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    gap: int = 1,
    where: Column | str | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Runs of rows in which neighbours are at most ``gap`` apart, per key.

    ``gap`` counts days for a date column and seconds for a timestamp. Repeated
    moments count once in ``n``. Moments inside one slot as wide as the gap always
    belong together, so each slot is pre-aggregated to one row before the window
    looks at a key. A key with more than a task's share of the slots is cut into stretches
    of time, and runs are put together over the cuts.
    """
    rows = df.filter(where) if where is not None else df
    position, units = _position(rows, at)
    width = gap * units if units else gap
    moments = rows.filter(F.col(at).isNotNull()).select(*keys, at, position.alias("__p")).distinct()
    slots = moments.groupBy(*keys, F.floor(F.col("__p") / width).alias("__slot")).agg(
        F.min("__p").alias("__first"),
        F.max("__p").alias("__last"),
        F.min(at).alias("start"),
        F.max(at).alias("end"),
        F.count(F.lit(1)).alias("n"),
    )
    small, large = parted(slots, keys, ["__slot"], slices)
    parts = [None if small is None else _runs(small, keys, width), None if large is None else _merged_runs(large, width)]
    return (
        both_parts(*[p if p is None else p.select(*keys, "island", "start", "end", "n") for p in parts])
        .groupBy(*keys, "island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n"))
    )


def _runs(slots: DataFrame, keys: Sequence[str], width: int, into: str = "island") -> DataFrame:
    """Slots with the number of their run: one more wherever the gap to the slot before is too wide."""
    w = Window.partitionBy(*keys).orderBy("__slot")
    opens = F.when(F.col("__first") - F.lag("__last").over(w) <= width, 0).otherwise(1)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return slots.withColumn("__opens", opens).withColumn(into, F.sum("__opens").over(upto))


def _merged_runs(slots: DataFrame, width: int) -> DataFrame:
    """The same for a key that is cut into stretches.

    Runs are found inside each stretch. Of a stretch its first and last moment and its number of
    runs are enough to see whether its first run goes on from the stretch before, and how many
    runs there are up to it.
    """
    inside = _runs(slots, [SLICE, GROUP], width, "__inside")
    facts = inside.groupBy(SLICE, GROUP).agg(
        F.min("__first").alias("begins"), F.max("__last").alias("stops"), F.max("__inside").alias("runs")
    )
    along = Window.partitionBy(GROUP).orderBy(SLICE)
    goes_on = F.when(F.col("begins") - F.lag("stops").over(along) <= width, 1).otherwise(0)
    facts = facts.withColumn("joined", goes_on)
    earlier = F.coalesce(F.sum("runs").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    joined = F.sum("joined").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    facts = facts.select(SLICE, GROUP, (earlier - joined).alias("base"))
    return inside.join(facts, [SLICE, GROUP]).withColumn("island", F.col("base") + F.col("__inside"))


def pair_events(
    df: DataFrame, keys: Sequence[str], kind: str, at: str, start: str, end: str
) -> DataFrame:
    """One row per key with the last start, the first end and their difference.

    ``at`` may be a number or text; text that is no number counts as missing.
    """
    moment = read_as(F.col(at), "double") if dict(df.dtypes)[at] == "string" else F.col(at)
    return (
        df.groupBy(*keys)
        .agg(
            F.max(F.when(F.col(kind) == start, moment)).alias("start_at"),
            F.min(F.when(F.col(kind) == end, moment)).alias("end_at"),
        )
        .withColumn("duration", F.col("end_at") - F.col("start_at"))
    )


def mean_duration(pairs: DataFrame, keys: Sequence[str], places: int = 3) -> DataFrame:
    return pairs.groupBy(*keys).agg(F.round(F.avg("duration"), places).alias("mean_duration"))
