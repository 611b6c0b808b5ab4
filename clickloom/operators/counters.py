"""Row counters of a job."""

from __future__ import annotations

import threading

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from clickloom.functions.text import tokens


def word_counters(lines: DataFrame, text: Column) -> DataFrame:
    """``counter, value``: lines read, words out of the lines, groups out.

    One pass: every line gives its words, or one NULL where it has none, and
    its first row counts for the line. Numbers are added up per word, then over
    all words.
    """
    words = lines.select(F.posexplode_outer(tokens(text)).alias("place", "word"))
    first = F.coalesce(F.col("place"), F.lit(0)) == 0
    groups = words.groupBy("word").agg(F.count_if(first).alias("lines"), F.count("word").alias("n"))
    totals = groups.agg(
        F.coalesce(F.sum("lines"), F.lit(0)).alias("input_lines"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("words_out"),
        F.count("word").alias("groups_out"),
    )
    pairs = [F.struct(F.lit(c).alias("counter"), F.col(c).alias("value")) for c in totals.columns]
    return totals.select(F.inline(F.array(*pairs)))


class Counters:
    """Row counters of a job, taken by the actions that do its work anyway.

    ``rows`` marks a place in a plan; nothing is read twice for it. Mark rows
    behind a sort, not before it: sorting first reads a sample of what it gets.
    Like all task metrics the numbers may count rows twice after a stage was
    computed again for a lost executor.
    """

    def __init__(self) -> None:
        self._observations: list[Observation] = []

    def rows(self, df: DataFrame, name: str | None, **totals: Column) -> DataFrame:
        """``df``; its rows count as ``name``, and each aggregate under its keyword."""
        observation = Observation()
        self._observations.append(observation)
        columns = [F.coalesce(c, F.lit(0)).cast("bigint").alias(label) for label, c in totals.items()]
        if name:
            columns.insert(0, F.count(F.lit(1)).alias(name))
        return df.observe(observation, *columns)

    def values(self, wait: float = 20.0) -> dict[str, int]:
        """All counters, once the actions are done.

        A place that no action passed, such as the rows above an empty join, has
        no numbers and is left out.
        """
        found: dict[str, int] = {}
        for observation in self._observations:
            taken: list[dict[str, int]] = []
            reader = threading.Thread(target=_take, args=(observation, taken), daemon=True)
            reader.start()
            reader.join(wait)
            found |= taken[0] if taken else {}
        return found


def _take(observation: Observation, taken: list[dict[str, int]]) -> None:
    try:
        taken.append(observation.get)
    except Py4JError:  # the optimizer left the marked place out of the plan
        return
