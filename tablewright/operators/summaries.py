"""Summaries of a day that can be merged: quantiles and distinct counts without reading the rows again.

A KLL summary holds a sample of values by rank, an HLL summary the largest hash patterns. Both are a few
kilobytes whatever they stand for, and a summary of two days is the merge of theirs, so any span of days is
answered from one row per day and group. With k = 200 a KLL rank is off by 1.65 % of the rows at
the most in 99 of 100 cases; with 12 bits an HLL count is off by 1.6 % on average.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KLL_SIZE = 200
HLL_BITS = 12


def summarise(
    df: DataFrame, keys: Sequence[str], value: str, distinct: str, size: int = KLL_SIZE, bits: int = HLL_BITS
) -> DataFrame:
    """Per group: rows, a summary of the values and one of the distinct column. NULLs are left out of both.

    Summaries are built inside tasks and merged behind the shuffle.
    """
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), size).alias("values"),
        F.hll_sketch_agg(distinct, bits).alias("distinct"),
    )


def merge_summaries(summaries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Summaries of coarser groups, from those of finer ones or of other spans."""
    return summaries.groupBy(*keys).agg(
        F.sum("rows").alias("rows"),
        F.kll_merge_agg_double("values").alias("values"),
        F.hll_union_agg("distinct").alias("distinct"),
    )


def quantile(at: float) -> Column:
    """A value about that share of the values are not above; NULL for a summary without values."""
    some = F.kll_sketch_get_n_double("values") > 0
    return F.when(some, F.kll_sketch_get_quantile_double("values", F.lit(at)))


def distinct_count() -> Column:
    return F.hll_sketch_estimate("distinct")
