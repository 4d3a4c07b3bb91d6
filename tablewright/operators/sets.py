"""Set operations on whole rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def stack_all(frames: Sequence[DataFrame], fill_missing: bool = False) -> DataFrame:
    """Union all of any number of frames, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill_missing), frames)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def difference(a: DataFrame, b: DataFrame, keep_copies: bool = False) -> DataFrame:
    b = b.select(*a.columns)
    return a.exceptAll(b) if keep_copies else a.subtract(b)


def intersection(a: DataFrame, b: DataFrame, keep_copies: bool = False) -> DataFrame:
    b = b.select(*a.columns)
    return a.intersectAll(b) if keep_copies else a.intersect(b)
