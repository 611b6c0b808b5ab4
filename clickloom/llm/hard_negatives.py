"""Hard negatives by spanning-tree bounds over the anchors.

Anchors of one label are joined to a minimum spanning tree that hangs from the
origin, where every score is zero. Going down an edge of length d, the score of
a candidate with norm n moves by at most d * n, so the scores at the parent
give every candidate an interval at the child. Only candidates whose interval
overlaps what is asked for are scored there; their interval shrinks to a point
and the children start from it.

First every anchor gets its positives, the best rows of its own label: asked
for are intervals that reach the k-th best lower bound. Then the positives'
scores set the windows for the rows of other labels.

Anchors and candidates meet in cells, a bounded number of anchors against a
bounded number of rows; rows are dealt to cells by their place, so neither a
frequent label nor a frequent vector fills one cell.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.session import written

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
# A negative scores from 50 to 95 hundredths of its positive.
FROM_PERCENT, TO_PERCENT = 50, 95
# Largest cell, and anchors of a tree.
CELL_ANCHORS, CELL_ROWS, TREE_ANCHORS = 8192, 32_768, 128
# Cells for every configured task, so that all of them have some.
CELLS_PER_TASK = 3
# Integers up to here are exact as floating numbers; the slack covers rounding beyond.
EXACT, SLACK = 1 << 53, 1e-9
KEYS = ["length", "anchor_cell", "row_cell"]


def usable(vector: Column) -> Column:
    """Neither NULL nor holding NULL or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def inner_products(rows: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Exact inner products of integers held as floating numbers."""
    if not len(rows):
        return np.zeros(0, np.int64)
    if (np.abs(rows).max(axis=0) * np.abs(vector)).sum() < EXACT:
        return (rows @ vector).astype(np.int64)
    whole = [int(x) for x in vector]
    return np.array([sum(int(a) * b for a, b in zip(row, whole)) for row in rows.tolist()], object)


def spanning_tree(vectors: np.ndarray) -> list[tuple[int, int, float]]:
    """``node, parent, edge length``, parents first; the parent of a root edge is -1, the origin."""
    n = len(vectors)
    distance = np.sqrt((vectors * vectors).sum(axis=1))
    parent, open_nodes, edges = np.full(n, -1), np.ones(n, bool), []
    for _ in range(n):
        node = int(np.argmin(np.where(open_nodes, distance, np.inf)))
        edges.append((node, int(parent[node]), float(distance[node])))
        open_nodes[node] = False
        away = vectors - vectors[node]
        away = np.sqrt((away * away).sum(axis=1))
        closer = open_nodes & (away < distance)
        distance[closer], parent[closer] = away[closer], node
    return edges


def walk(
    anchors: np.ndarray, rows: np.ndarray, wanted: Callable[[int, np.ndarray, np.ndarray], np.ndarray]
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``anchor, places of rows, their scores`` for the rows that may be wanted.

    ``wanted`` gets an anchor and the bounds of all rows and returns the places
    of the rows to score. The bounds of an anchor are held until its children
    are done.
    """
    norms = np.sqrt((rows * rows).sum(axis=1)) * (1 + SLACK)
    lengths = np.sqrt((anchors * anchors).sum(axis=1))
    children: dict[int, list[tuple[int, float]]] = {}
    for node, parent, edge in spanning_tree(anchors):
        children.setdefault(parent, []).append((node, edge))
    zero = np.zeros(len(rows))
    stack = [(node, edge, 0.0, zero, zero) for node, edge in children.get(-1, [])]
    while stack:
        node, edge, above, low, high = stack.pop()
        moved = (edge * (1 + SLACK) + SLACK * above) * norms + 1
        low, high = low - moved, high + moved
        places = wanted(node, low, high)
        scores = inner_products(rows[places], anchors[node])
        low[places] = high[places] = scores.astype(float)
        yield node, places, scores
        stack += [(child, e, lengths[node], low, high) for child, e in children.get(node, [])]


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> list[int]:
    """Places of the k highest scores, ties to smaller ids."""
    if len(scores) > 4 * k and scores.dtype != object:  # leave out what is surely not among them
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        near = np.arange(len(scores))
    return sorted(near.tolist(), key=lambda i: (-int(scores[i]), int(ids[i])))[:k]


def _kth(values: np.ndarray, k: int) -> float:
    """The k-th largest value, minus infinity where there are fewer."""
    return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else -np.inf


def _vectors(table: pa.Table) -> np.ndarray:
    """The quantised vectors of a cell, all of one length."""
    values = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    length = table.column("length")[0].as_py() if table.num_rows else 0
    return np.floor(SCALE * values.astype(np.float64)).reshape(table.num_rows, length)


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64)


def _trees(labels: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """``label, places`` of the anchors of each tree."""
    for label in np.unique(labels).tolist():
        own = np.flatnonzero(labels == label)
        for at in range(0, len(own), TREE_ANCHORS):
            yield label, own[at : at + TREE_ANCHORS]


def cell_positives(
    anchor_ids: np.ndarray, anchor_labels: np.ndarray, anchors: np.ndarray,
    ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, k: int,
) -> Iterator[tuple[int, int, int]]:
    """``anchor, row, score``: for each anchor the k best other rows of its label in a cell."""
    for label, tree in _trees(anchor_labels):
        own = np.flatnonzero(labels == label)
        if not len(own):
            continue
        own_ids = ids[own]

        def wanted(node: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            others = own_ids != anchor_ids[tree[node]]
            return np.flatnonzero(others & (high >= _kth(low[others], k)))

        for node, places, scores in walk(anchors[tree], rows[own], wanted):
            for i in _best(scores, own_ids[places], k):
                yield int(anchor_ids[tree[node]]), int(own_ids[places[i]]), int(scores[i])


def window(positive: int) -> tuple[int, int]:
    """Lowest and highest score of a positive's negatives."""
    return -(-FROM_PERCENT * positive // 100), TO_PERCENT * positive // 100


def cell_negatives(
    anchor_ids: np.ndarray, anchor_labels: np.ndarray, anchors: np.ndarray, positives: list[list[int]],
    ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, k: int,
) -> Iterator[tuple[int, int, int, int]]:
    """``anchor, positive's place, row, score``: the k best rows of other labels per window."""
    for label, tree in _trees(anchor_labels):
        other = np.flatnonzero(labels != label)
        if not len(other):
            continue

        def wanted(node: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
            hit = np.zeros(len(low), bool)
            for positive in positives[tree[node]]:
                least, most = window(positive)
                surely = (low >= least) & (high <= most)
                hit |= (low <= most) & (high >= max(float(least), _kth(low[surely], k)))
            return np.flatnonzero(hit)

        for node, places, scores in walk(anchors[tree], rows[other], wanted):
            for number, positive in enumerate(positives[tree[node]]):
                least, most = window(positive)
                inside = np.flatnonzero((scores >= least) & (scores <= most))
                for i in _best(scores[inside], ids[other[places[inside]]], k):
                    place = inside[i]
                    yield int(anchor_ids[tree[node]]), number, int(ids[other[places[place]]]), int(scores[place])


def _table(rows: Iterator[tuple], names: list[str]) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.table({name: pa.array(c, pa.int64()) for name, c in zip(names, columns)})


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score``.

    ``is_anchor`` chooses the anchors by the columns of ``vectors``. Rows
    without an id or a label, and vectors that are NULL or hold NULL or
    non-finite components, take no part; vectors meet those of their own length
    only. An anchor is never compared with rows of its own id. Repeated rows
    count as often as they occur, but of anchor rows with one id the smallest by
    label and vector stands for all. Scores are exact; one beyond 64 bits raises
    an error. Anchors without positives or negatives have no rows; an empty
    table gives an empty result. Other columns are not read, whatever their names.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(label_col).cast("bigint").alias("label"),
        F.col(vector_col).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    ).filter(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")))
    rows = written(
        rows.withColumn("length", F.size("vector")).withColumn("place", F.monotonically_increasing_id())
    )
    asked = rows.filter("anchor").groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row"))
    asked = written(
        asked.select(
            "id", "row.label", "row.vector", F.size("row.vector").alias("length"),
            F.monotonically_increasing_id().alias("place"),
        )
    )
    # Cells are as large as a task can hold, but enough of them for all tasks.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    anchor_cells = max(1, -(-asked.count() // CELL_ANCHORS))
    row_cells = max(-(-rows.count() // CELL_ROWS), -(-CELLS_PER_TASK * tasks // anchor_cells))

    def dealt(table: DataFrame, own: str, n: int, other: str, others: int) -> DataFrame:
        """Each row in its cell, once for every cell of the other side."""
        every = F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other)
        return table.select("*", F.pmod("place", F.lit(n)).cast("int").alias(own), every)

    candidates = dealt(rows.select("id", "label", "vector", "length", "place"), "row_cell", row_cells, "anchor_cell", anchor_cells)

    def meet(anchors: DataFrame, compute: Callable, schema: str) -> DataFrame:
        left = dealt(anchors, "anchor_cell", anchor_cells, "row_cell", row_cells)
        return left.groupBy(*KEYS).cogroup(candidates.groupBy(*KEYS)).applyInArrow(compute, schema)

    def sides(left: pa.Table, right: pa.Table) -> list[tuple[np.ndarray, ...]] | None:
        if not (left.num_rows and right.num_rows):
            return None
        return [(_numbers(t, "id"), _numbers(t, "label"), _vectors(t)) for t in (left, right)]

    def find_positives(left: pa.Table, right: pa.Table) -> pa.Table:
        found = sides(left, right)
        rows = cell_positives(*found[0], *found[1], positives) if found else iter(())
        return _table(rows, ["anchor_id", "positive_id", "positive_score"])

    def find_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        found = sides(left, right)
        scores = left.column("scores").to_pylist()
        rows = cell_negatives(*found[0], scores, *found[1], negatives) if found else iter(())
        return _table(rows, ["anchor_id", "number", "negative_id", "negative_score"])

    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    known = meet(asked, find_positives, "anchor_id bigint, positive_id bigint, positive_score bigint")
    known = known.withColumn("positive_rank", F.row_number().over(best)).filter(F.col("positive_rank") <= positives)
    known = written(known)
    # At most `positives` entries each, in rank order.
    entry = F.struct("positive_rank", "positive_score")
    listed = known.groupBy("anchor_id").agg(F.sort_array(F.collect_list(entry)).alias("listed"))
    listed = listed.select("anchor_id", F.col("listed.positive_score").alias("scores"))
    windows = asked.join(listed, asked["id"] == listed["anchor_id"]).drop("anchor_id")
    found = meet(windows, find_negatives, "anchor_id bigint, number bigint, negative_id bigint, negative_score bigint")
    found = found.withColumn("positive_rank", (F.col("number") + 1).cast("int"))
    order = Window.partitionBy("anchor_id", "positive_rank").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return ranked.join(known, ["anchor_id", "positive_rank"]).select(
        "anchor_id", "positive_id", "positive_rank", "rank", "negative_id", "positive_score", "negative_score"
    )
