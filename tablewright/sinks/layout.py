"""Physical layout: gathering and ordering within partitions."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.operators.skew import frequent_keys


def spread(df: DataFrame, n: int | None = None, by: Sequence[str] = (), ranged: bool = False) -> DataFrame:
    """Repartition to ``n``, by hash or range of columns, or both."""
    args = ([n] if n else []) + list(by)
    return df.repartitionByRange(*args) if ranged else df.repartition(*args)


def gathered(df: DataFrame, n: int) -> DataFrame:
    """At most ``n`` partitions, without a shuffle: neighbours are put together."""
    return df.coalesce(n)


def spread_by_rule(df: DataFrame, rule: Column, n: int | None = None) -> DataFrame:
    """Rows for which ``rule`` gives one value come together."""
    return df.repartition(n, rule) if n else df.repartition(rule)


def balanced(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Partitions of about the advisory size; Spark splits heavy keys, merges light ones."""
    return df.hint("rebalance", *by)


def sorted_inside(df: DataFrame, by: Sequence[str], order: Sequence[str], n: int | None = None) -> DataFrame:
    """Rows of a key together and each partition sorted; no order across partitions."""
    return spread(df, n, by).sortWithinPartitions(*order)


def held(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    """Kept for reuse; call ``unpersist`` on it when done."""
    return df.persist(level)


def partition_count(df: DataFrame) -> int:
    """Partitions that hold rows."""
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def partition_numbers(df: DataFrame, into: str = "partition") -> DataFrame:
    return df.withColumn(into, F.spark_partition_id())


def packed_bins(sizes: Sequence[tuple[int, int]], held: Sequence[int]) -> dict[int, int]:
    """Bins for the listed (group, rows), largest first into the emptiest; ``held`` rows lie in each bin already."""
    bins = [(rows, k) for k, rows in enumerate(held)]
    heapq.heapify(bins)
    out = {}
    for group, rows in sorted(sizes, key=lambda g: (-g[1], g[0])):
        now, k = heapq.heappop(bins)
        out[group] = k
        heapq.heappush(bins, (now + rows, k))
    return out


def spread_by_size(df: DataFrame, keys: Sequence[str], n: int, share: float | None = None) -> DataFrame:
    """``n`` partitions of about even size, all rows of a group in one.

    Groups with more than ``share`` of the rows (a hundredth of a partition unless given) are measured;
    there are at most 1 / share of them. All others go by a hash, and then the measured ones are packed
    into the emptiest partition, largest first. A group larger than a partition's even share stays
    whole all the same: it is alone there as far as others allow.
    """
    share = max(share or 1 / (100 * n), 1e-5)
    found = frequent_keys(df, keys, share).select(F.xxhash64(*keys).alias("group"), "rows").collect()
    group = F.xxhash64(*keys)
    target = F.pmod(F.xxhash64(group, F.lit(n)), F.lit(n)).cast("int")
    others = df.filter(~group.isin([r["group"] for r in found])) if found else df
    held = dict(others.groupBy(target.alias("bin")).count().collect())
    bins = packed_bins([(r["group"], r["rows"]) for r in found], [held.get(k, 0) for k in range(n)])
    by_bin: dict[int, list[int]] = {}
    for number, k in bins.items():
        by_bin.setdefault(k, []).append(number)
    for k, numbers in by_bin.items():
        target = F.when(group.isin(numbers), k).otherwise(target)
    return df.repartitionById(n, target)
