"""Starts that wait for their end, with time-outs: own state and event-time timers.

A start is answered by the earliest end of its key that comes at most ``wait`` after it. The answer is given
when the watermark says that no earlier end can still arrive, so it does not depend on how the
rows are dealt to batches or in which order they come.

State is kept per share of the keys and slot, a stretch of event time ``wait`` long. An end is sent to its own
slot and the one before, so a slot holds all that its starts may need: starts and ends of twice the wait,
however long the stream runs, and a busy key is spread over its slots. Keys are dealt to ``SHARES`` shares
by a hash: every call for state or a timer costs the worker a turn to the store and back, and with one
state per key there would be as many of these as keys and slots. One timer per share and
slot fires when its last start cannot be answered any more; then all its starts come out once and
the state is removed.
"""

from __future__ import annotations

import datetime as dt
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

#: The state store that list state and timers need.
STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
}

SHARES = 128  # of the keys; a timer holds the rows of one share and slot in a worker's memory

_MICRO = 1_000_000
_BLOCK = 10_000  # rows that are handed to the store at once


class WaitingStarts(StatefulProcessor):
    """Holds the starts and ends of a share of the keys in one slot until its timer fires."""

    def __init__(self, wait: int):
        self.wait = wait

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        moment = StructType([StructField("at", LongType())])
        start = StructType([StructField("key", LongType()), StructField("id", LongType()), StructField("at", LongType())])
        end = StructType([StructField("key", LongType()), StructField("at", LongType())])
        self.due = handle.getValueState("due", moment)
        self.starts = handle.getListState("starts", start)
        self.ends = handle.getListState("ends", end)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        starts, ends = [], set()
        for row in rows:
            who, at = row["__key"], row["__at"]
            if row["__is_start"]:
                starts.append((who, row["__id"], at))
                if len(starts) >= _BLOCK:
                    self.starts.appendList(starts)
                    starts = []
            else:
                ends.add((who, at))
                if len(ends) >= _BLOCK:
                    self.ends.appendList(list(ends))
                    ends = set()
        if starts:
            self.starts.appendList(starts)
        if ends:
            self.ends.appendList(list(ends))
        if not self.due.exists():
            # the slot's last start gives up here
            due = (key[-1] + 2) * self.wait
            self.due.update((due,))
            self.handle.registerTimer(-(-due // 1000))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        ends = defaultdict(list)
        for who, at in self.ends.get():
            ends[who].append(at)
        for moments in ends.values():
            moments.sort()
        for who, number, at in self.starts.get():
            moments = ends.get(who, ())
            found = bisect_left(moments, at)
            end = moments[found] if found < len(moments) and moments[found] <= at + self.wait else None
            yield Row(__key=who, __id=number, start_at=at, end_at=end)
        for state in (self.starts, self.ends, self.due):
            state.clear()

    def close(self) -> None:
        pass


def _micros(at: str) -> Column:
    return F.unix_micros(F.col(at))


def answered_starts(
    stream: DataFrame, key: str, id_col: str, at: str, is_start: Column, is_end: Column, wait: dt.timedelta
) -> DataFrame:
    """(key, id, start_at, end_at) of every start whose wait is over; ``end_at`` is null if none came.

    ``stream`` has a watermark on the timestamp ``at``; ``id_col`` and ``key`` are whole numbers. Times come
    out in microseconds since 1970. Run the stream under ``STORE``. Rows that are neither start nor
    end, or that have no time, are passed over.
    """
    width = int(wait.total_seconds()) * _MICRO
    slot = F.call_function("div", _micros(at) - F.pmod(_micros(at), F.lit(width)), F.lit(width))
    # a start is needed in its own slot, an end in that and the one before
    slots = F.when(is_start, F.array(slot)).otherwise(F.array(slot, slot - 1))
    share = F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(SHARES))
    rows = (
        stream.filter((is_start | is_end) & F.col(at).isNotNull())
        .select(
            F.col(key).cast("bigint").alias("__key"),
            share.alias("__share"),
            F.col(id_col).cast("bigint").alias("__id"),
            F.col(at),
            _micros(at).alias("__at"),
            is_start.alias("__is_start"),
            F.explode(slots).alias("__slot"),
        )
    )
    made = rows.groupBy("__share", "__slot").transformWithState(
        statefulProcessor=WaitingStarts(width),
        outputStructType="__key bigint, __id bigint, start_at bigint, end_at bigint",
        outputMode="Append",
        timeMode="EventTime",
    )
    return made.withColumnsRenamed({"__key": key, "__id": id_col})


def state_rows(spark: SparkSession, checkpoint: str, variable: str) -> DataFrame:
    """What a stopped query still holds under a state variable of ours."""
    return (
        spark.read.format("statestore")
        .option("stateVarName", variable)
        .option("path", checkpoint)
        .load()
    )
