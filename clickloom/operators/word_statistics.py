"""Per-word statistics over paragraphs.

A paragraph lies within one row, so its word frequencies are counted inside
the row, on the sorted word array. Only one shuffle remains, by word, and it
carries partial sums instead of tokens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.text import clean_words, token_count

# Fixed value: the pseudo-word that carries the paragraph length.
PARAGRAPH_LENGTH = "paragraph length"


def _run_starts(ordered: Column) -> Column:
    """Positions at which a sorted array changes value."""
    return F.array_compact(
        F.transform(
            ordered,
            lambda word, i: F.when((i == 0) | (word != F.get(ordered, i - 1)), i),
        )
    )


def _with_sorted_words(lines: DataFrame, text: Column) -> DataFrame:
    """Add each row's sorted words and the positions where a new word starts."""
    return lines.withColumn("ordered", F.sort_array(clean_words(text))).withColumn(
        "starts", _run_starts(F.col("ordered"))
    )


def _frequencies() -> Column:
    """(word, occurrences) of each distinct word of a row with sorted words.

    Kept as an expression for ``inline``: over a plain array column the
    optimizer would add a filter that computes the whole array once more.
    """
    ordered, starts = F.col("ordered"), F.col("starts")
    return F.transform(
        starts,
        lambda at, i: F.struct(
            F.get(ordered, at).alias("word"),
            (F.coalesce(F.get(starts, i + 1), F.size(ordered)) - at)
            .cast("bigint")
            .alias("occurrences"),
        ),
    )


def paragraph_words(lines: DataFrame, text: Column, ids: list[str]) -> DataFrame:
    """Word frequencies per paragraph: ``ids, word, occurrences``."""
    rows = _with_sorted_words(lines.select(*ids, text.alias("text")), F.col("text"))
    return rows.select(*ids, F.inline(_frequencies()))


def paragraph_lengths(lines: DataFrame, text: Column) -> DataFrame:
    """Each paragraph's whitespace token count as an occurrence row."""
    return lines.select(
        F.lit(PARAGRAPH_LENGTH).alias("word"), token_count(text).alias("occurrences")
    )


def paragraph_records(lines: DataFrame, text: Column, with_length: bool = False) -> DataFrame:
    """One ``word, occurrences`` row per distinct word of each paragraph."""
    rows = _with_sorted_words(lines.select(text.alias("text")), F.col("text"))
    records = _frequencies()
    if with_length:
        length = F.struct(
            F.lit(PARAGRAPH_LENGTH).alias("word"),
            token_count(F.col("text")).alias("occurrences"),
        )
        records = F.concat(records, F.array(length))
    return rows.select(F.inline(records))


def partial_states(records: DataFrame) -> DataFrame:
    """Mergeable state per word; sums of integers, so merging order is irrelevant."""
    n = F.col("occurrences")
    return records.groupBy("word").agg(
        F.count(F.lit(1)).alias("document_count"),
        F.sum(n).alias("total_count"),
        F.min(n).alias("min"),
        F.max(n).alias("max"),
        F.sum(n * n).alias("sum_of_squares"),
    )


def merge_states(states: DataFrame) -> DataFrame:
    """Combine partial states of the same word, e.g. from several runs."""
    return states.groupBy("word").agg(
        F.sum("document_count").alias("document_count"),
        F.sum("total_count").alias("total_count"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.sum("sum_of_squares").alias("sum_of_squares"),
    )


def mean_and_variance(count: Column, total: Column, squares: Column) -> list[Column]:
    """Mean and population variance from integer sums."""
    mean = total / count
    return [mean.alias("mean"), (squares / count - mean * mean).alias("variance")]


def finish(states: DataFrame) -> DataFrame:
    return states.select(
        "*",
        *mean_and_variance(
            F.col("document_count"), F.col("total_count"), F.col("sum_of_squares")
        ),
    )


def word_statistics(lines: DataFrame, text: Column) -> DataFrame:
    """``word, document_count, mean, variance`` over paragraphs holding the word."""
    stats = finish(partial_states(paragraph_records(lines, text)))
    return stats.select("word", "document_count", "mean", "variance")


def word_statistics_full(lines: DataFrame, text: Column) -> DataFrame:
    """Adds totals, extremes, squares and the paragraph length row."""
    return finish(partial_states(paragraph_records(lines, text, with_length=True)))
