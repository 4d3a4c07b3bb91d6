"""Counting words, runs of words and anagrams over whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions.arrays import ngrams
from tablewright.functions.strings import letter_signature


def words_of(
    df: DataFrame, text: str, *, lower: bool = False, pattern: str = " ", drop_empty: bool = False
) -> DataFrame:
    """One row per word, in a column ``word``."""
    source = F.lower(text) if lower else F.col(text)
    words = df.select(F.explode(F.split(source, pattern)).alias("word"))
    return words.filter(F.col("word") != "") if drop_empty else words


def word_count(
    df: DataFrame, text: str, *, lower: bool = False, pattern: str = " ", drop_empty: bool = False
) -> DataFrame:
    words = words_of(df, text, lower=lower, pattern=pattern, drop_empty=drop_empty)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def top_words(df: DataFrame, text: str, n: int, **how) -> DataFrame:
    """The ``n`` most frequent words; equal counts go by the word."""
    return word_count(df, text, **how).orderBy(F.col("count").desc(), "word").limit(n)


def ngram_count(
    df: DataFrame, text: str, n: int, *, lower: bool = False, pattern: str = " "
) -> DataFrame:
    source = F.lower(text) if lower else F.col(text)
    made = df.select(F.explode(ngrams(F.split(source, pattern), n)).alias("ngram"))
    return made.groupBy("ngram").agg(F.count(F.lit(1)).alias("count"))


def anagram_groups(words: DataFrame, word: str, min_size: int = 2) -> DataFrame:
    """Distinct words that share their letters with others: one row per word.

    Groups stay rows, with their size beside them, and are never collected.
    """
    distinct = words.select(F.col(word).alias("word")).distinct()
    signed = distinct.withColumn("signature", letter_signature("word"))
    sizes = signed.groupBy("signature").agg(F.count(F.lit(1)).alias("group_size"))
    return signed.join(sizes.filter(F.col("group_size") >= min_size), "signature")
