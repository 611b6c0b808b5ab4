"""Posting lists from blocks: the sorted, distinct places of every word.

The task that reads the lines turns them, some million postings at a time, into
blocks: one per word and slice, its places in order and each of them once. Blocks
are shuffled, not postings, and the blocks of a word and slice are put together.
So what is done for every posting is done on arrays.

A small sample of the lines tells the crowded words, and borders that cut all
places into ranges. A slice of a crowded word is a run of neighbouring ranges, as
many as make its postings a few segments; a line is looked up among the borders
once for all its words. The sample decides about the layout only.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators import groups

# Postings that a task turns at a time.
HELD_POSTINGS = 1_000_000
# Blocks that a task passes on at a time.
BATCHED_BLOCKS = 10_000
BLOCK = "word string, crowded boolean, slice int, places string"
# Stands between the places of a block; in none of them a character 0 is followed by a 7.
BETWEEN = "\0\7"


@dataclass
class Layout:
    """Borders between the ranges of places, and the crowded words.

    A slice of ``words[i]`` is two to the power ``shifts[i]`` ranges.
    """

    borders: list[str]
    words: list[str]
    shifts: list[int]


def posting_lists(lines: DataFrame, *, segment_size: int, sample: DataFrame) -> DataFrame:
    """``word, segment, group_size, items``: the distinct places of every word, in order.

    Both tables have a row ``words, place`` per line: its words, and a text
    without ``BETWEEN`` in it, which does not end with a character 0.
    ``sample`` holds the lines of ``groups.sampled`` sources.
    """
    layout = _layout(groups.written(sample.select("words", "place")), segment_size)
    pieces = _pieces(_blocks(lines, layout))
    if not layout.words:
        return groups._whole_groups(pieces, ["word"], [], segment_size)
    pieces = groups.written(pieces)
    whole = groups._whole_groups(pieces.filter(~F.col("crowded")), ["word"], [], segment_size)
    # Equal places are in one range, so pieces share none.
    stitched = groups._stitched_groups(pieces.filter("crowded"), ["word"], [], segment_size, False)
    return whole.unionByName(stitched)


def _layout(sample: DataFrame, segment_size: int) -> Layout:
    """The layout for words of more than ``PIECE_SEGMENTS`` segments.

    At most ``MOST_BORDERS`` borders, and twice as many words; with more
    segments than that, slices grow.
    """
    share = groups.probe_share(segment_size)
    expected = groups.PIECE_SEGMENTS * segment_size * share
    counts = sample.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    least = expected if share == 1 else expected / 2
    crowded = groups.written(counts.filter(F.col("n") > least))
    total = crowded.agg(F.sum("n")).first()[0]
    if not total:
        return Layout([], [], [])
    step = max(1, int(expected), -(-total // groups.MOST_BORDERS))
    # At most twice MOST_BORDERS words.
    found = crowded.filter(F.col("n") > max(least, step / 2)).collect()
    powers = [max(0, (-(-r.n // step) - 1).bit_length()) for r in found]
    bits = min(max(powers, default=0), groups.MOST_BORDERS.bit_length() - 1)
    places = sample.select("place").dropna()
    taken = min(1.0, groups.MOST_BORDERS / max(1, places.count()))
    # About MOST_BORDERS places.
    drawn = sorted(r.place for r in (places.sample(taken, seed=2) if taken < 1 else places).collect())
    borders = sorted({drawn[len(drawn) * i >> bits] for i in range(1, 1 << bits)}) if drawn else []
    return Layout(borders, [r.word for r in found], [max(0, bits - p) for p in powers])


def _blocks(lines: DataFrame, layout: Layout) -> DataFrame:
    """Rows of ``BLOCK``; a word and slice have one from every turn of a task that holds it."""
    # All that the tasks run is inside this function, so that they need not import the library.
    shared = lines.sparkSession.sparkContext.broadcast((layout.borders, layout.words, layout.shifts))

    def turn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, postings = [], 0
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column("place")))
            held.append(batch)
            postings += len(batch.column("words").flatten())
            if postings >= HELD_POSTINGS:
                yield from blocks(held)
                held, postings = [], 0
        if postings:
            yield from blocks(held)

    def blocks(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        borders, listed_words, shifts = shared.value
        lines = pa.Table.from_batches(held).combine_chunks()
        places, words = lines["place"].combine_chunks(), lines["words"].combine_chunks()
        order = pc.sort_indices(places).to_numpy()
        places = places.take(pa.array(order))
        new = np.ones(len(places), bool)
        new[1:] = pc.not_equal(places[1:], places[:-1]).to_numpy(zero_copy_only=False)
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        places = places.filter(pa.array(new))

        coded = words.flatten().dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64)
        postings = code * len(places) + number[pc.list_parent_indices(words).to_numpy()]
        postings = np.unique(postings)
        code, at = np.divmod(postings, len(places))

        listed = pc.index_in(coded.dictionary, value_set=pa.array(listed_words, pa.string()))
        crowded = pc.is_valid(listed).to_numpy(zero_copy_only=False)
        slices = np.zeros(len(postings), np.int32)
        if crowded.any():
            shift = np.zeros(len(crowded), np.int64)
            shift[crowded] = np.array(shifts)[listed.drop_null().to_numpy()]
            ranges = np.array([bisect_right(borders, place) for place in places.to_pylist()])
            slices = np.where(crowded[code], ranges[at] >> shift[code], 0).astype(np.int32)

        begins = np.ones(len(postings), bool)
        begins[1:] = (code[1:] != code[:-1]) | (slices[1:] != slices[:-1])
        first = np.append(np.flatnonzero(begins), len(postings))
        for low in range(0, len(first) - 1, BATCHED_BLOCKS):
            cut = first[low : low + BATCHED_BLOCKS + 1]
            taken = places.take(pa.array(at[cut[0] : cut[-1]]))
            listed_places = pa.ListArray.from_arrays(pa.array((cut - cut[0]).astype(np.int32)), taken)
            yield pa.RecordBatch.from_arrays(
                [
                    coded.dictionary.take(pa.array(code[cut[:-1]])),
                    pa.array(crowded[code[cut[:-1]]]),
                    pa.array(slices[cut[:-1]]),
                    # One text a block: an array would take as much again for its offsets.
                    pc.binary_join(listed_places, BETWEEN),
                ],
                names=["word", "crowded", "slice", "places"],
            )

    return lines.select("words", "place").mapInArrow(turn, BLOCK)


def _pieces(blocks: DataFrame) -> DataFrame:
    """``word, crowded, slice, n, items``: the distinct places of every slice, in order."""
    by = ["word", "crowded", "slice"]
    gathered = blocks.repartition(*by).groupBy(*by).agg(F.collect_list("places").alias("blocks"))
    # Blocks in order are most often one sorted run, which costs the sort a single pass.
    joined = F.array_join(F.sort_array("blocks"), BETWEEN)
    items = F.array_distinct(F.sort_array(F.split(joined, r"\x00\x07")))
    places = gathered.select(*by, items.alias("items"))
    return places.select(*by, F.size("items").cast("bigint").alias("n"), "items")
