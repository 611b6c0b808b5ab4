"""Word count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.text import tokens


def word_count(lines: DataFrame, text: Column) -> DataFrame:
    """Occurrences of every whitespace-separated token: ``word, count``."""
    words = lines.select(F.explode(tokens(text)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def sorted_by_word(counts: DataFrame) -> DataFrame:
    return counts.orderBy("word")
