"""Event-time aggregation; the same functions serve tables and streams."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MERGE_FIRST = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}


def event_time(df: DataFrame, at: str, delay: str) -> DataFrame:
    """``at`` as a zoned timestamp with a watermark; a table ignores the watermark."""
    typed = df.withColumn(at, F.col(at).cast("timestamp"))
    return typed.withWatermark(at, delay)


def _bounds(df: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Window bounds as columns without a zone."""
    return df.select(
        F.col("window.start").cast("timestamp_ntz").alias("start"),
        F.col("window.end").cast("timestamp_ntz").alias("end"),
        *keys,
        *names,
    )


def windowed(
    df: DataFrame,
    at: str,
    keys: Sequence[str],
    measures: Mapping[str, Column],
    width: str,
    slide: str | None = None,
) -> DataFrame:
    """Aggregates per tumbling window, or per sliding one with ``slide``."""
    made = df.groupBy(F.window(at, width, slide).alias("window"), *keys).agg(
        *[m.alias(n) for n, m in measures.items()]
    )
    return _bounds(made, keys, list(measures))


def sessions(
    df: DataFrame, at: str, keys: Sequence[str], measures: Mapping[str, Column], gap: str
) -> DataFrame:
    """Aggregates per run of events at most ``gap`` apart.

    Start such a stream under ``MERGE_FIRST``: each task then merges its events to
    sessions before the shuffle, which takes the weight off hot keys.
    """
    made = df.groupBy(F.session_window(at, gap).alias("window"), *keys).agg(
        *[m.alias(n) for n, m in measures.items()]
    )
    return _bounds(made, keys, list(measures))


def flag_bursts(
    df: DataFrame, at: str, keys: Sequence[str], amount: Column, width: str, max_count: int, max_amount
) -> DataFrame:
    """Keys with more events or a larger sum in one window than allowed."""
    measures = {"events": F.count(F.lit(1)), "amount": F.sum(amount)}
    made = windowed(df, at, keys, measures, width)
    return made.filter((F.col("events") > max_count) | (F.col("amount") > max_amount))


def enrich(stream: DataFrame, static: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Stream rows joined to a table.

    Spark broadcasts the table only if it is small; else the join keeps no state, so
    adaptive execution splits hot keys in each micro-batch.
    """
    return stream.join(static, list(on), how)


def first_seen(
    df: DataFrame, keys: Sequence[str], salt_on: Sequence[str] = (), salts: int = 16
) -> DataFrame:
    """Each key once within the watermark's delay.

    With ``salt_on`` copies are removed in two steps, first per key and salt, so that
    many copies of one key do not all go to one task.
    """
    if salt_on:
        salt = F.pmod(F.xxhash64(*salt_on), F.lit(salts)).cast("int")
        salted = df.withColumn("__salt", salt).dropDuplicatesWithinWatermark([*keys, "__salt"])
        df = salted.drop("__salt")
    return df.dropDuplicatesWithinWatermark(list(keys))


def first_per_day(
    df: DataFrame, at: str, keys: Sequence[str], delay: str, salt_on: Sequence[str] = (), salts: int = 16
) -> DataFrame:
    """Each key once per day of event time, however many batches the day comes in.

    The day's start is part of the key and carries the watermark, a day behind the events'
    own: a day is closed, and its state dropped, when events of the next day are ``delay``
    past midnight at the least. With ``salt_on`` copies are removed in two steps.
    """
    day = F.date_trunc("day", F.col(at))
    dated = df.withColumn("day_start", day).withWatermark("day_start", f"1 day {delay}")
    if salt_on:
        salt = F.pmod(F.xxhash64(*salt_on), F.lit(salts)).cast("int")
        dated = dated.withColumn("__salt", salt)
        dated = dated.dropDuplicates([*keys, "day_start", "__salt"]).drop("__salt")
    return dated.dropDuplicates([*keys, "day_start"])
