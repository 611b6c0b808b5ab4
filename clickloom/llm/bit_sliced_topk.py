"""Exact top-k inner products with a bit-sliced index.

Components are quantised to integers. A block of rows keeps, for each
attribute, one bitmap per binary digit of its values. A query's score is a sum
of attributes times constants: every slice is shifted by the digits of the
constant and all are added with bitmap arithmetic (full adders on whole
bitmaps), which gives the slices of the scores of all rows of the block at
once. The best rows are then selected from the most significant slice down; at
the boundary the rows still in question have equal scores and the smaller ids
are taken.

Rows and queries are dealt to cells of bounded size, a cell to a task. A task
indexes its rows block by block and gets k rows per query from each, which a
window ranks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.session import written

SCALE = 256
# Rows of an index block, and rows and queries that a task is dealt at most.
BLOCK_ROWS, CELL_ROWS, CELL_QUERIES = 16_384, 1 << 16, 1024


def usable(vector: Column) -> Column:
    """Neither NULL nor holding NULL or non-finite components."""
    bad = F.exists(
        vector,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")),
    )
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def quantised(vector: Column) -> Column:
    """``floor(256 x)`` of each component, x as double; an error where that needs over 64 bits."""

    def one(x: Column) -> Column:
        scaled = x.cast("double") * SCALE
        error = F.raise_error(F.lit("a component does not fit 64 bits")).cast("bigint")
        return F.when(F.abs(scaled) >= float(1 << 63), error).otherwise(F.floor(scaled).cast("bigint"))

    return F.transform(vector, one)


class Index:
    """Slices of a block of integer rows; row r is bit r of every bitmap."""

    def __init__(self, values: np.ndarray) -> None:
        self.rows, self.attributes = values.shape
        self.words = (self.rows + 63) // 64
        self.low = values.min(axis=0) if self.rows else np.zeros(self.attributes, np.int64)
        high = values.max(axis=0) if self.rows else self.low
        # The digits follow the range of the block, whatever it is.
        self.bits = [(int(h) - int(l)).bit_length() for h, l in zip(high, self.low)]
        self.slices: list[list[np.ndarray]] = []
        for j, n in enumerate(self.bits):
            offset = values[:, j].astype(np.uint64) - self.low[j].astype(np.uint64)
            self.slices.append([self.bitmap((offset >> np.uint64(b)) & np.uint64(1)) for b in range(n)])
        self.all = self.bitmap(np.ones(self.rows, np.uint8))

    def bitmap(self, flags: np.ndarray) -> np.ndarray:
        padded = np.zeros(self.words * 64, np.uint8)
        padded[: self.rows] = flags
        return np.packbits(padded, bitorder="little").view(np.uint64)

    def rows_of(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little")[: self.rows])

    def score_slices(self, query: Iterable[int]) -> tuple[list[np.ndarray], int]:
        """Slices of every row's score, and the number to add to all of them.

        A negative constant adds the complement of an attribute instead, so
        that only non-negative numbers are added.
        """
        columns: list[list[np.ndarray]] = []
        constant = 0
        for j, factor in enumerate(map(int, query)):
            constant += factor * int(self.low[j])
            slices = self.slices[j]
            if factor < 0:
                constant += factor * ((1 << len(slices)) - 1)
                slices = [~s for s in slices]
            factor, shift = abs(factor), 0
            while factor:
                if factor & 1:
                    while len(columns) < shift + len(slices):
                        columns.append([])
                    for b, s in enumerate(slices):
                        columns[shift + b].append(s)
                factor >>= 1
                shift += 1
        return self.added(columns), constant

    def added(self, columns: list[list[np.ndarray]]) -> list[np.ndarray]:
        """Binary digits of a sum given as bitmaps per digit, by full adders."""
        out, place = [], 0
        while place < len(columns):
            column = columns[place]
            carries: list[np.ndarray] = []
            while len(column) > 2:
                waiting = column[: len(column) % 3]
                for i in range(len(column) % 3, len(column), 3):
                    a, b, c = column[i : i + 3]
                    half = a ^ b
                    waiting.append(half ^ c)
                    half &= c
                    half |= a & b
                    carries.append(half)
                column = waiting
            if len(column) == 2:
                carries.append(column[0] & column[1])
                column = [column[0] ^ column[1]]
            out.append(column[0] if column else np.zeros(self.words, np.uint64))
            if carries:
                if place + 1 == len(columns):
                    columns.append([])
                columns[place + 1] = columns[place + 1] + carries
            place += 1
        return out

    def top(self, slices: list[np.ndarray], k: int, allowed: np.ndarray) -> list[tuple[int, int]]:
        """``row, score`` of the k best allowed rows, ties to the smaller row."""
        sure = np.zeros(self.words, np.uint64)
        open_rows, missing = allowed, k
        for s in reversed(slices):
            have = open_rows & s
            n = int(np.bitwise_count(have).sum())
            if n > missing:
                open_rows = have
            else:
                sure = sure | have
                missing -= n
                open_rows = open_rows & ~s
        # The rows still open all have the score of the boundary.
        chosen = np.concatenate([self.rows_of(sure), self.rows_of(open_rows)[:missing]])
        scores = np.zeros(len(chosen), object)
        words, bits = chosen // 64, (chosen % 64).astype(np.uint64)
        for b, s in enumerate(slices):
            scores += ((s[words] >> bits) & np.uint64(1)).astype(object) << b
        return sorted(zip(chosen.tolist(), scores.tolist()), key=lambda r: (-r[1], r[0]))


def _searched(
    block: list[tuple[int, list[int]]], queries: list[tuple[int, list[int]]], k: int
) -> Iterator[tuple[int, int, int]]:
    """``query, row, score``: the k best rows of a block for each query, not of its own id."""
    block.sort(key=lambda r: r[0])
    ids = np.array([i for i, _ in block], np.int64)
    index = Index(np.array([v for _, v in block], np.int64).reshape(len(block), -1))
    for query_id, query in queries:
        slices, constant = index.score_slices(query)
        allowed = index.all
        own = np.searchsorted(ids, query_id, "left"), np.searchsorted(ids, query_id, "right")
        if own[0] < own[1]:
            mine = np.zeros(index.rows, np.uint8)
            mine[own[0] : own[1]] = 1
            allowed = allowed & ~index.bitmap(mine)
        for at, score in index.top(slices, k, allowed):
            yield query_id, int(ids[at]), score + constant


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best other rows of each query row.

    The score is the integer inner product of the quantised vectors; a component
    or a score in a list that needs more than 64 bits raises an error. Rows
    without an id, and vectors that are NULL or hold NULL or non-finite
    components, take no part, nor do vectors of another length than the query's.
    A row is never compared with rows of its own id; repeated ids count as often
    as they occur, and of queries with one id the smallest vector is asked for.
    With fewer than k candidates all are given; an empty table on either side
    gives an empty result.
    """

    def prepare(rows: DataFrame) -> DataFrame:
        vector = F.col("vector")
        return (
            rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("vector"))
            .filter(F.col("id").isNotNull() & usable(vector))
            .select("id", quantised(vector).alias("values"))
        )

    index = written(prepare(vectors).withColumn("place", F.monotonically_increasing_id()))
    asked = prepare(queries).groupBy("id").agg(F.min("values").alias("values"))
    asked = written(asked.withColumn("place", F.monotonically_increasing_id()))
    # Each cell of queries meets each cell of rows: the stated queries against
    # all rows, in blocks. A task gets one cell; rows are dealt by their place.
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    query_cells = max(1, -(-asked.count() // CELL_QUERIES))
    row_cells = max(1, -(-index.count() // CELL_ROWS), -(-tasks // query_cells))

    def dealt(rows: DataFrame, own: int, others: int, place: Column, is_row: bool) -> DataFrame:
        other = F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias("other")
        rows = rows.select("id", "values", F.pmod("place", F.lit(own)).alias("own"), other)
        return rows.select(place.cast("int").alias("cell"), F.lit(is_row).alias("is_row"), "id", "values")

    first = dealt(asked, query_cells, row_cells, F.col("own") * row_cells + F.col("other"), False)
    then = dealt(index, row_cells, query_cells, F.col("other") * row_cells + F.col("own"), True)
    cells = first.unionByName(then).repartitionById(query_cells * row_cells, F.col("cell"))
    cells = cells.sortWithinPartitions("is_row").select("is_row", "id", "values")

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted: dict[int, list[tuple[int, list[int]]]] = {}  # by length
        held: dict[int, list[tuple[int, list[int]]]] = {}

        def found(length: int) -> pa.RecordBatch:
            rows = list(_searched(held.pop(length), wanted.get(length, []), k))
            columns = list(zip(*rows)) or [(), (), ()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"]
            )

        for batch in batches:  # the queries first
            for is_row, row_id, values in zip(*(c.to_pylist() for c in batch.columns)):
                block = (held if is_row else wanted).setdefault(len(values), [])
                block.append((row_id, values))
                if is_row and len(block) == BLOCK_ROWS:
                    yield found(len(values))
        for length in list(held):
            yield found(length)

    best = cells.mapInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
