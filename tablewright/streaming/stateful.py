"""State of our own per key, kept across micro-batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def running_totals(
    stream: DataFrame, key: str, value: str, salt_on: Sequence[str], salts: int = 16
) -> DataFrame:
    """Count and sum since the stream began, per key and salt, once per batch.

    ``value`` is a whole number. Salts spread a hot key over several tasks; a hash
    of ``salt_on`` gives a row the same salt when a task runs again. The state is
    two numbers, and rows arrive in chunks that are added up one by one, so no
    group is ever held whole. ``totals_of`` puts the salts together.
    """

    def add(
        group: tuple, chunks: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        count, total = state.get if state.exists else (0, 0)
        for chunk in chunks:
            count += len(chunk)
            total += int(chunk[value].sum())
        state.update((count, total))
        yield pd.DataFrame({key: [group[0]], "salt": [group[1]], "events": [count], "total": [total]})

    salt = F.pmod(F.xxhash64(*salt_on), F.lit(salts)).cast("int")
    return (
        stream.select(key, salt.alias("salt"), value)
        .groupBy(key, "salt")
        .applyInPandasWithState(
            add,
            outputStructType=f"{key} {dict(stream.dtypes)[key]}, salt int, events bigint, total bigint",
            stateStructType="events bigint, total bigint",
            outputMode="update",
            timeoutConf=GroupStateTimeout.NoTimeout,
        )
    )


def totals_of(parts: DataFrame, key: str) -> DataFrame:
    """Totals per key from the latest totals per key and salt."""
    return parts.groupBy(key).agg(F.sum("events").alias("events"), F.sum("total").alias("total"))
