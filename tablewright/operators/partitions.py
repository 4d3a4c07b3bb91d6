"""Work on one physical partition at a time, in batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


def map_partitions(
    df: DataFrame, fn: Callable[[int, Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str
) -> DataFrame:
    """Apply ``fn(partition number, batches)``; batches stream through, none is kept."""

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return fn(TaskContext.get().partitionId(), batches)

    return df.mapInPandas(apply, schema)


def each_partition(df: DataFrame, fn: Callable[[Iterator[Row]], None]) -> None:
    """Side effects per partition, such as writing to an outside system."""
    df.foreachPartition(fn)


def summaries(df: DataFrame, column: str) -> DataFrame:
    """Rows and range of a column per partition (in place of listing its rows); partitions without rows are left out."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(column).alias("low"), F.max(column).alias("high")
    )
