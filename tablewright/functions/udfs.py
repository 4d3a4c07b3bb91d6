"""Functions of one's own, usable from SQL, working on Arrow batches."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def register_vectorized(
    spark: SparkSession, name: str, fn: Callable[[pd.Series], pd.Series], returns: str
) -> None:
    """Make a function from column batch to column batch known to SQL."""

    def apply(values: pd.Series) -> pd.Series:
        return fn(values)

    spark.udf.register(name, F.pandas_udf(apply, returns))


@F.udtf(returnType="place int, word string")
class WordPlaces:
    """Table function: the words of a text with their 1-based places."""

    def eval(self, text: str):
        if text is not None:
            yield from enumerate(text.split(" "), 1)


def register_word_places(spark: SparkSession, name: str = "word_places") -> None:
    spark.udtf.register(name, WordPlaces)
