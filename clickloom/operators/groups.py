"""Sorted groups that stay bounded however large a key grows.

Posting lists and sessions both gather all items of a key into a sorted array.
A small sample of the rows tells which keys are crowded, and where their items
can be cut into slices of a few segments. All rows are then shuffled
once, by key and slice, and gathered into sorted pieces; the pieces of a key
follow each other in slice order. Most keys are one piece, which is the result.
For the others, prefix counts over the pieces place every piece in its key, and
pieces are cut at the segment borders; only what a border leaves over of a
piece is shuffled again. So a crowded key becomes rows of exactly
``segment_size`` items, numbered in order, and reading them in order gives the
whole list.

The sample decides about the layout only. Whatever it misses, the result is
the same.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.session import written

# Segments that a piece holds; a key of no more is gathered as one piece.
PIECE_SEGMENTS = 8
# Rows that the sample is expected to hold of a key that just fills a piece.
PROBED = 10
# Slice borders of all crowded keys together, which every task is sent.
MOST_BORDERS = 1 << 17

ITEM = "item"

# Columns the operator makes; keys and flags need other names.
OWN_COLUMNS = frozenset(
    "item items segment group_size slice entry borders crowded again before part parts place n".split()
)


def probe_share(segment_size: int) -> float:
    """Share of the rows that has to be sampled to lay out segments of this size."""
    return min(1.0, PROBED / (PIECE_SEGMENTS * segment_size))


def sampled(rows: DataFrame, segment_size: int) -> DataFrame:
    """The sample for ``ordered_groups``, taken before dear columns are derived."""
    return rows.sample(probe_share(segment_size), seed=1)


def _join(left: DataFrame, right: DataFrame, names: list[str], how: str) -> DataFrame:
    """Equi-join on the named columns, with NULL equal to NULL."""
    renamed = right.withColumnsRenamed({n: f"other_{n}" for n in names})
    same = [F.col(n).eqNullSafe(F.col(f"other_{n}")) for n in names]
    return left.join(renamed, same, how).drop(*[f"other_{n}" for n in names])


def ordered_groups(
    rows: DataFrame,
    keys: list[str],
    item: Column,
    *,
    distinct: bool,
    segment_size: int,
    any_of: Mapping[str, Column] | None = None,
    keep: Column | None = None,
    max_items: int | None = None,
    sample: DataFrame | None = None,
    unobserved: DataFrame | None = None,
    ordered: bool = False,
) -> DataFrame:
    """Sorted item arrays per key: ``keys, segment, group_size, flags, items``.

    ``item`` is an orderable column; its natural order sorts the group.
    ``distinct`` drops equal items. ``any_of`` names row conditions; each
    becomes a column telling whether any row of the whole group meets it.
    ``keep`` is a condition on keys and flags, and ``max_items`` the largest
    size: groups that fail either are left out before any of their items is
    gathered. ``sample`` may give rows derived from ``sampled`` sources, where
    sampling the rows themselves would derive all of them. ``unobserved`` may
    give the same rows without a job's counters, for the passes that prepare the
    last one. ``ordered`` gives the result in the order of keys and segments: the
    rows are shuffled by range, so that the gathered arrays need not be.

    The rows should come out of a scan: a task that is repeated has to draw the
    same numbers for copies of a row.
    """
    if max_items is not None and max_items > segment_size:
        raise ValueError(f"max_items is at most {segment_size}, the size of one row")
    conditions = dict(any_of or {})
    flags = list(conditions)
    if taken := OWN_COLUMNS.intersection([*keys, *flags]):
        raise ValueError(f"column names used inside: {sorted(taken)}")

    def derived(df: DataFrame) -> DataFrame:
        marks = [F.coalesce(c, F.lit(False)).alias(name) for name, c in conditions.items()]
        return df.select(*keys, item.alias(ITEM), *marks)

    plain = rows if unobserved is None else unobserved
    if sample is None:
        sample = sampled(plain, segment_size)
    rows, plain = derived(rows), derived(plain)
    if keep is not None:
        states = plain.groupBy(*keys).agg(*[F.bool_or(f).alias(f) for f in flags])
        dropped = states.filter(F.coalesce(~keep, F.lit(False))).select(*keys)
        rows = _join(rows, written(dropped), keys, "left_anti")
    borders = None
    if max_items is not None:
        rows = _without_large(rows, plain, keys, max_items, distinct)
    else:
        borders = _slice_borders(derived(sample), keys, segment_size)
    if borders is None:
        pieces = _pieces(rows.withColumn("slice", F.lit(0)), keys, [], flags, distinct, ordered)
        result = _whole_groups(pieces, keys, flags, segment_size)
        return result.sortWithinPartitions(*keys, "segment") if ordered else result
    placed = _in_slices(rows, borders, keys)
    layout = written(_pieces(placed, keys, ["crowded"], flags, distinct))
    whole = _whole_groups(layout.filter(~F.col("crowded")), keys, flags, segment_size)
    stitched = _stitched_groups(layout.filter("crowded"), keys, flags, segment_size, distinct)
    result = whole.unionByName(stitched)
    return result.orderBy(*keys, "segment") if ordered else result


def _without_large(
    rows: DataFrame, plain: DataFrame, keys: list[str], most: int, distinct: bool
) -> DataFrame:
    """The rows of keys that have at most ``most`` items."""
    counts = plain.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    large = written(counts.filter(F.col("n") > most).select(*keys))
    if large.isEmpty():
        return rows
    if distinct:
        several = _join(plain.select(*keys, ITEM), large, keys, "left_semi").distinct()
        counts = several.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        large = written(counts.filter(F.col("n") > most).select(*keys))
    return _join(rows, large, keys, "left_anti")


def _with_entry(rows: DataFrame) -> DataFrame:
    """Add what rows of a key are sliced by: the item, and a number drawn for each row.

    Copies of one item thus spread over slices.
    """
    return rows.withColumn("entry", F.struct(F.col(ITEM), F.rand(seed=7).alias("salt")))


def _slice_borders(sample: DataFrame, keys: list[str], segment_size: int) -> DataFrame | None:
    """``keys, borders``: entries that cut the crowded keys into slices, or None.

    All borders together are at most ``MOST_BORDERS``; with more segments than
    that, slices grow.
    """
    share = probe_share(segment_size)
    expected = PIECE_SEGMENTS * segment_size * share
    counts = sample.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    crowded = written(counts.filter(F.col("n") > (expected if share == 1 else expected / 2)))
    total = crowded.agg(F.sum("n")).first()[0]
    if not total:
        return None
    step = max(1, int(expected), -(-total // MOST_BORDERS))
    entries = _join(_with_entry(sample), crowded.drop("n"), keys, "left_semi")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("entry"))
    picked = entries.select(*keys, "entry").withColumn("place", place).filter(F.col("place") % step == 0)
    return written(
        picked.groupBy(*keys).agg(F.sort_array(F.collect_list("entry")).alias("borders"))
    )


def _in_slices(rows: DataFrame, borders: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``crowded`` and ``slice``, the number of borders up to the row's entry."""
    # At most MOST_BORDERS entries.
    rows = _join(_with_entry(rows), F.broadcast(borders), keys, "left")
    most = borders.agg(F.max(F.size("borders"))).first()[0] or 0
    steps = [1 << b for b in reversed(range(max(1, most.bit_length())))]
    searched = F.aggregate(
        F.array(*map(F.lit, steps)),
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= F.size("borders")) & (F.get("borders", at + step - 1) <= F.col("entry")),
            at + step,
        ).otherwise(at),
    )
    crowded = F.col("borders").isNotNull()
    placed = rows.withColumn("slice", F.when(crowded, searched).otherwise(0))
    return placed.withColumn("crowded", crowded).drop("entry", "borders")


def _pieces(
    rows: DataFrame,
    keys: list[str],
    marks: list[str],
    flags: list[str],
    distinct: bool,
    ordered: bool = False,
) -> DataFrame:
    """``keys, marks, slice, n, flags, items``: the sorted items of every slice."""
    gather = F.collect_set if distinct else F.collect_list
    by = keys if not marks else [*keys, *marks, "slice"]
    # Shuffled first: arrays made before the shuffle would only be made twice.
    rows = rows.repartitionByRange(*by) if ordered else rows.repartition(*by)
    gathered = rows.groupBy(*by).agg(
        gather(ITEM).alias("items"), *[F.bool_or(f).alias(f) for f in flags]
    )
    return gathered.select(
        *by,
        F.size("items").cast("bigint").alias("n"),
        *flags,
        F.sort_array("items").alias("items"),
    )


def _segments(first: Column, last: Column, size: int) -> Column:
    """``segment, part`` rows: the items at places ``first`` to ``last`` of a key, cut at borders."""

    def part(segment: Column) -> Column:
        start = F.greatest(first, segment * size)
        end = F.least(last, segment * size + (size - 1))
        items = F.slice("items", (start - first + 1).cast("int"), (end - start + 1).cast("int"))
        return F.struct(segment.alias("segment"), items.alias("part"))

    low = F.floor(first / size)
    high = F.floor(F.greatest(first, last) / size)
    return F.inline(F.transform(F.sequence(low, high), part))


def _whole_groups(
    pieces: DataFrame, keys: list[str], flags: list[str], size: int
) -> DataFrame:
    """Result rows of keys with one piece."""
    first, last = F.lit(0).cast("bigint"), F.col("n") - 1
    whole = F.array(F.struct(first.alias("segment"), F.col("items").alias("part")))
    several = F.transform(
        F.sequence(first, F.floor(last / size)),
        lambda s: F.struct(
            s.alias("segment"), F.slice("items", (s * size + 1).cast("int"), F.lit(size)).alias("part")
        ),
    )
    cut = F.inline(F.when(F.col("n") <= size, whole).otherwise(several))
    return pieces.select(*keys, F.col("n").alias("group_size"), *flags, cut).select(
        *keys, "segment", "group_size", *flags, F.col("part").alias("items")
    )


def _stitched_groups(
    pieces: DataFrame, keys: list[str], flags: list[str], size: int, distinct: bool
) -> DataFrame:
    """Result rows of keys with several pieces.

    Of distinct items, one that a piece ends with may begin the next pieces, too;
    it counts in the first of them only.
    """
    # Few narrow rows per key: one for every piece.
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("slice")
    again = F.get("items", 0).eqNullSafe(F.lag(F.get("items", F.size("items") - 1)).over(earlier))
    again = F.when(again, 1).otherwise(0) if distinct else F.lit(0)
    places = pieces.select(*keys, "slice", "n", again.alias("again"), *flags)
    held = F.col("n") - F.col("again")
    places = places.select(
        *keys,
        "slice",
        "again",
        (F.sum(held).over(earlier) - held).alias("before"),
        F.sum(held).over(whole).alias("group_size"),
        *[F.bool_or(f).over(whole).alias(f) for f in flags],
    )
    # A piece ends at a border or is the last of its key: at most twice the borders.
    places = F.broadcast(places)
    placed = _join(pieces.select(*keys, "slice", "n", "items"), places, [*keys, "slice"], "inner")
    placed = placed.withColumn("n", held).filter(F.col("n") > 0)
    kept = F.slice("items", 2, F.size("items"))
    placed = placed.withColumn("items", F.when(F.col("again") == 1, kept).otherwise(F.col("items")))
    first = F.col("before")
    parts = placed.select(
        *keys, "slice", "group_size", *flags, _segments(first, first + F.col("n") - 1, size)
    )
    full = F.size("part") == F.least(F.lit(size), F.col("group_size") - F.col("segment") * size)
    done = parts.filter(full).select(
        *keys, "segment", "group_size", *flags, F.col("part").alias("items")
    )
    rest = (
        parts.filter(~full)
        .groupBy(*keys, "segment", "group_size", *flags)
        .agg(F.sort_array(F.collect_list(F.struct("slice", "part"))).alias("parts"))
        .select(
            *keys, "segment", "group_size", *flags, F.flatten(F.col("parts.part")).alias("items")
        )
    )
    return done.unionByName(rest)
