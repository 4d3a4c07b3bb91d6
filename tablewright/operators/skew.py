"""Finding skew and aggregating through it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators.slices import large_groups


def partition_report(df: DataFrame) -> DataFrame:
    """Rows per physical partition and their ratio to the mean."""
    counts = df.groupBy(F.spark_partition_id().alias("partition")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    mean = counts.agg(F.avg("rows"))
    return counts.withColumn("ratio_to_mean", F.round(F.col("rows") / mean.scalar(), 4))


def skew_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key, the key's share of all rows and its ratio to the mean key."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    whole = counts.agg(F.struct(F.sum("rows").alias("total"), F.avg("rows").alias("mean"))).scalar()
    return counts.withColumns(
        {
            "share": F.round(F.col("rows") / whole["total"], 6),
            "ratio_to_mean": F.round(F.col("rows") / whole["mean"], 4),
        }
    )


def skewed_keys(df: DataFrame, keys: Sequence[str], ratio: float) -> DataFrame:
    """Keys with more than ``ratio`` times the rows of the mean key."""
    return skew_report(df, keys).filter(F.col("ratio_to_mean") > ratio)


def frequent_keys(df: DataFrame, keys: Sequence[str], share: float) -> DataFrame:
    """Keys that hold more than ``share`` of the rows, and how many they hold.

    No shuffle of all keys: tasks summarise their frequent keys in bounded space, the merged summary
    names at most 2 / share candidates and misses none, and only the rows of these are counted. NULL is a key.
    """
    if not 1e-5 <= share <= 1:
        raise ValueError("share must lie between 1e-5 and 1")
    rows, found = large_groups(df, keys, share)
    kept = df.filter(F.xxhash64(*keys).isin(found)) if found else df.limit(0)
    counts = kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    made = counts.withColumn("share", F.round(F.col("rows") / F.lit(max(rows, 1)), 6))
    return made.filter(F.col("rows") > F.lit(rows * share))


MERGED_BY = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def salted_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    aggs: dict[str, tuple[str, str]],
    salts: int,
    salt_on: Sequence[str],
) -> DataFrame:
    """Two-stage aggregate: by (keys, salt), then by keys.

    ``aggs`` maps an output name to (kind, column); kinds are sum, count, min, max
    and avg. The salt is a hash of ``salt_on``, so a repeated task salts alike.
    """
    first, last = [], []
    for name, (kind, column) in aggs.items():
        if kind == "avg":
            first += [F.sum(column).alias(f"__s_{name}"), F.count(column).alias(f"__c_{name}")]
            total = F.sum(f"__s_{name}") / F.nullif(F.sum(f"__c_{name}"), F.lit(0))
            last.append(total.alias(name))
        elif kind in MERGED_BY:
            first.append(getattr(F, kind)(column).alias(f"__p_{name}"))
            last.append(MERGED_BY[kind](f"__p_{name}").alias(name))
        else:
            raise ValueError(f"{kind} cannot be merged from parts")
    salt = F.pmod(F.xxhash64(*salt_on), F.lit(salts))
    parts = df.groupBy(*keys, salt.alias("__salt")).agg(*first)
    return parts.groupBy(*keys).agg(*last)

