"""Ranked lexical search by presence-mask grouping.

A task reads its documents in blocks. In a block every query term has its
postings: the documents that hold it, how often, and the greatest share of a
score that it gives any of them. For an item the presence bitmaps of its terms
are laid side by side, so that every document gets a mask of the terms it
holds. Documents with one mask are a group, and the terms of the mask bound
what any of them can score. Groups are evaluated exactly by descending bound
until the next bound is below the k-th best score that the task has found for
the item; the rest of the block then cannot enter its list.

The documents are scanned twice, first for the statistics (documents, terms,
documents per query term), then for the ranking; no text and no posting is
shuffled or stored. What goes to the tasks are the terms of a block of items,
whose number is bounded by ``BLOCK_TERMS``; more items take several rounds.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.session import written

# Fixed values of the score.
UNIT, TF_WEIGHT, LENGTH_WEIGHT, LENGTH_SHARE = 1_000_000_000, 1000, 8, 75
# Item terms sent to the tasks at once.
BLOCK_TERMS = 1 << 20
# Documents and postings of a block.
BLOCK_DOCS, BLOCK_POSTINGS = 1 << 14, 1 << 22
# Bytes of a text that are cut into terms at a time.
PIECE = 1 << 20
# Bytes of the masks of one item made at a time.
MASK_BYTES = 1 << 26

# Every byte to itself where it belongs to a term, A-Z to a-z, all else to a blank.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_DOCS, _TERMS = -1, -2  # stand for a term where totals are meant


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in order, some at a time."""
    plain, at = text.translate(_TERM_BYTES), 0
    while at < len(plain):
        stop = plain.find(b" ", at + PIECE)
        stop = len(plain) if stop < 0 else stop
        yield plain[at:stop].split()
        at = stop


@dataclass
class Asked:
    """A block of items: their terms by number, and how often each item has them."""

    vocabulary: dict[bytes, int]
    item_ids: list[int | None]
    item_terms: list[np.ndarray]
    item_counts: list[np.ndarray]
    # Known after the first scan.
    docs: int = 0
    total: int = 0
    weights: np.ndarray | None = None

    def postings(self, text: bytes) -> tuple[np.ndarray, np.ndarray, int]:
        """Query terms of a text, how often each occurs, and the number of all its terms."""
        found, n = [], 0
        get = self.vocabulary.get
        for words in terms(text):
            n += len(words)
            numbers = np.fromiter(map(get, words, repeat(-1)), np.int32, len(words))
            found.append(numbers[numbers >= 0])
        numbers, counts = np.unique(np.concatenate(found) if found else np.zeros(0, np.int32), return_counts=True)
        return numbers, counts, n


def _texts(column: pa.Array) -> Iterator[bytes]:
    return (t.as_py() or b"" for t in column.cast(pa.binary()))


class Block:
    """Documents of a task with the postings of the query terms."""

    def __init__(self, asked: Asked) -> None:
        self.asked = asked
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, doc_id: int | None, text: bytes) -> None:
        numbers, counts, n = self.asked.postings(text)
        if len(numbers):
            self.ids.append(doc_id)
            self.lengths.append(n)
            self.parts.append((numbers, counts))
            self.size += len(numbers)

    def full(self, most: int) -> bool:
        return len(self.ids) >= most or self.size >= BLOCK_POSTINGS

    def index(self) -> None:
        """Sort the postings by term and work out what each gives a score."""
        asked = self.asked
        number = np.concatenate([p for p, _ in self.parts])
        tf = np.concatenate([c for _, c in self.parts])
        doc = np.repeat(np.arange(len(self.ids), dtype=np.int32), [len(p) for p, _ in self.parts])
        order = np.argsort(number, kind="stable")
        self.parts = []
        self.doc, tf, number = doc[order], tf[order], number[order]
        self.start = np.searchsorted(number, np.arange(len(asked.vocabulary) + 1))
        # Python's integers: the product may pass 64 bits in a large corpus.
        m = np.array(
            [100 - LENGTH_SHARE + LENGTH_SHARE * n * asked.docs // asked.total for n in self.lengths], np.int64
        )
        self.share = UNIT * tf // (TF_WEIGHT * tf + LENGTH_WEIGHT * m[self.doc])
        filled = np.flatnonzero(np.diff(self.start))
        self.most = np.zeros(len(asked.vocabulary), np.int64)
        self.most[filled] = np.maximum.reduceat(self.share, self.start[filled])

    def rows_of(self, term: int) -> slice:
        return slice(self.start[term], self.start[term + 1])

    def scores(self, docs: np.ndarray, numbers: np.ndarray, factors: np.ndarray) -> np.ndarray:
        """Exact scores of some documents."""
        out = np.zeros(len(docs), np.int64)
        for term, factor in zip(numbers.tolist(), factors.tolist()):
            rows = self.rows_of(term)
            holders = self.doc[rows]
            at = np.searchsorted(holders, docs)
            at[at == len(holders)] = 0
            held = holders[at] == docs
            out[held] += factor * self.share[rows][at[held]]
        return out

    def search(self, item: int, best: Best) -> None:
        """Offer ``best`` every document of the block that may be in the item's list."""
        numbers = self.asked.item_terms[item]
        factors = self.asked.item_counts[item] * self.asked.weights[numbers]
        used = (np.diff(self.start)[numbers] > 0) & (factors > 0)
        numbers, factors = numbers[used], factors[used]
        gains = factors * self.most[numbers]
        if not len(numbers) or gains.sum() < best.least():
            return
        width = -(-len(numbers) // 64) * 8
        step = max(1, MASK_BYTES // (8 * width))
        for first in range(0, len(self.ids), step):
            self._search_part(first, min(first + step, len(self.ids)), numbers, factors, gains, width, best)

    def _search_part(
        self, first: int, stop: int, numbers: np.ndarray, factors: np.ndarray, gains: np.ndarray, width: int, best: Best
    ) -> None:
        # One presence bitmap per term; read across, they are the masks of the documents.
        present = np.zeros((8 * width, stop - first), np.uint8)
        for row, term in enumerate(numbers.tolist()):
            holders = self.doc[self.rows_of(term)]
            inside = slice(*np.searchsorted(holders, (first, stop)))
            present[row, holders[inside] - first] = 1
        masks = np.ascontiguousarray(np.packbits(present, axis=0).T)
        kind = np.uint64 if width == 8 else np.dtype((np.void, width))
        groups, group = np.unique(masks.view(kind).ravel(), return_inverse=True)
        bits = np.unpackbits(groups.view(np.uint8).reshape(len(groups), width), axis=1)[:, : len(numbers)]
        bounds = bits.astype(np.int64) @ gains
        members = np.argsort(group, kind="stable")
        start = np.searchsorted(group[members], np.arange(len(groups) + 1))
        order = np.argsort(-bounds, kind="stable")
        at, wanted = 0, best.k
        # A group whose bound equals the k-th score may still hold a smaller id.
        while at < len(order) and bounds[order[at]] >= max(best.least(), 1):
            taken, n = [], 0
            while at < len(order) and n < wanted and bounds[order[at]] >= max(best.least(), 1):
                taken.append(members[start[order[at]] : start[order[at] + 1]])
                n += len(taken[-1])
                at += 1
            docs = np.concatenate(taken) + first
            scores = self.scores(docs, numbers, factors)
            near = np.flatnonzero(scores >= max(best.least(), 1))
            best.offer([(-int(scores[i]), *_place(self.ids[docs[i]])) for i in near.tolist()])
            wanted *= 2


def _place(doc_id: int | None) -> tuple[bool, int]:
    """Order of ids: ascending, no id last."""
    return doc_id is None, doc_id or 0


class Best:
    """The k best documents of an item so far, as ``-score, no id, id``."""

    def __init__(self, k: int) -> None:
        self.k, self.rows = k, []

    def least(self) -> int:
        """The score that a further document must reach."""
        return -self.rows[-1][0] if len(self.rows) == self.k else 0

    def offer(self, rows: list[tuple[int, bool, int]]) -> None:
        self.rows = sorted(self.rows + rows)[: self.k]


def _items(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item, term, n`` of each item; its different texts add up."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), _texts(batch.column(1))):
                for words in terms(text):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(words), pa.int64()), pa.array(words, pa.binary())],
                        names=["item", "term"],
                    )

    rows = items.select(F.col(id_col).cast("bigint").alias("item"), F.col(text_col).alias("text")).distinct()
    found = rows.mapInArrow(cut, "item bigint, term binary")
    return written(found.groupBy("item", "term").agg(F.count(F.lit(1)).alias("n")))


def _asked(rows: list) -> Asked:
    vocabulary = {t: i for i, t in enumerate(sorted({bytes(r.term) for r in rows}))}
    held: dict[int | None, list[tuple[int, int]]] = {}
    for r in rows:
        held.setdefault(r["item"], []).append((vocabulary[bytes(r.term)], r.n))
    pairs = [np.array(sorted(p), np.int64) for p in held.values()]
    return Asked(vocabulary, list(held), [p[:, 0] for p in pairs], [p[:, 1] for p in pairs])


def _with_statistics(asked: Asked, docs: DataFrame) -> Asked:
    """Scan the documents for their number, their terms and the holders of each query term."""
    shared = docs.sparkSession.sparkContext.broadcast(asked)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holders = np.zeros(len(shared.value.vocabulary), np.int64)
        n_docs = total = 0
        for batch in batches:
            for text in _texts(batch.column(1)):
                numbers, _, n = shared.value.postings(text)
                holders[numbers] += 1
                n_docs += n > 0
                total += n
        seen = np.flatnonzero(holders)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([_DOCS, _TERMS, *seen.tolist()], pa.int32()),
                pa.array([n_docs, total, *holders[seen].tolist()], pa.int64()),
            ],
            names=["term", "n"],
        )

    found = docs.mapInArrow(count, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    counts = {r.term: r.n for r in found.collect()}  # at most a row per query term
    asked.docs, asked.total = counts.get(_DOCS, 0), counts.get(_TERMS, 0)
    asked.weights = np.array(
        [
            math.floor(1000 * math.log((2 * asked.docs + 2) / (2 * counts.get(t, 0) + 1)))
            for t in range(len(asked.vocabulary))
        ],
        np.int64,
    )
    return asked


def _ranked_by_tasks(asked: Asked, docs: DataFrame, k: int, block_docs: int) -> DataFrame:
    """``item_id, doc_id, score``: the k best of each task for each item."""
    shared = docs.sparkSession.sparkContext.broadcast(asked)

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        best = [Best(k) for _ in asked.item_ids]

        def evaluate(block: Block) -> None:
            if block.ids:
                block.index()
                for item, found in enumerate(best):
                    block.search(item, found)

        block = Block(asked)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), _texts(batch.column(1))):
                block.add(doc_id, text)
                if block.full(block_docs):
                    evaluate(block)
                    block = Block(asked)
        evaluate(block)
        rows = [
            (item, None if no_id else doc_id, -score)
            for item, found in zip(asked.item_ids, best)
            for score, no_id, doc_id in found.rows
        ]
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["item_id", "doc_id", "score"]
        )

    return docs.mapInArrow(search, "item_id bigint, doc_id bigint, score bigint")


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_terms: int = BLOCK_TERMS,
    block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents with a score above 0.

    Whole texts count. Every row of ``docs`` is a document; repeated rows stand
    in the list as often as they occur, a document without an id stands behind
    those of its score, and a NULL or empty text has no terms. Rows of ``items``
    with one id are one item: equal rows count once, different texts add up. An
    item without terms, or whose terms no document holds, has no rows; an empty
    table on either side gives an empty result. Other columns are not read,
    whatever their names.
    """
    corpus = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    queries = _items(items, item_col, item_text_col)
    # Twice the blocks that would do on average: items are dealt by a hash.
    n = queries.count()
    blocks = 1 if n <= block_terms else 2 * -(-n // block_terms)
    place = F.pmod(F.xxhash64("item"), F.lit(blocks))
    found = []
    for block in range(blocks):
        rows = queries.filter(place == block).collect()  # about block_terms rows
        if rows:
            asked = _with_statistics(_asked(rows), corpus)
            found.append(_ranked_by_tasks(asked, corpus, k, block_docs))
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
