"""Near duplicates by SimHash and meet-in-the-middle ball hashing.

Two fingerprints within the radius meet in a variant that both emit. The radius
is three, an odd number: one of three blocks is erased, and of the other bits
at most one, half of the two differences left, is flipped. So a fingerprint
emits 131 variants instead of the 2,081 of a ball of radius two.

* Two fingerprints at distance one or two agree in some block; with it erased
  they meet with equal erased blocks.
* At distance three either some block holds exactly one difference: with it
  erased they meet, and their erased blocks differ in one bit. Or one block
  holds all three: with it erased they meet without any flip.

Rows of one variant whose erased blocks are equal are within distance two, so a
chain joins them without emitting pairs; whatever else may be linked is found
by looking up the neighbours of an erased block. Every link is verified on the
whole fingerprints. The work per variant is linear in its rows, and a variant
has at most 44 rows for each of the two million values of an erased block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.components import connected_components
from clickloom.session import written

RADIUS = 3
SHINGLE_WORDS = 3
SEED = 42
# Blocks of the fingerprint as first bit and width.
BLOCKS = ((0, 22), (22, 21), (43, 21))
# Up to this many rows of a variant are compared directly.
DIRECT_ROWS = 64
# Hashes of a long text are counted in pieces of this size.
COUNT_ROWS = 1 << 16


def shingle_hashes(text: bytes, words: int = SHINGLE_WORDS) -> list[int]:
    """XXH64 of every run of ``words`` words, repeats included.

    A text with fewer words has one run, the whole of it; without words none.
    """
    tokens = text.lower().split()  # bytes: A-Z only, and the six ASCII blanks
    if len(tokens) <= words:
        return [xxhash.xxh64_intdigest(b" ".join(tokens), SEED)] if tokens else []
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens])
    starts = (ends - [len(t) + 1 for t in tokens]).tolist()
    stops = (ends[words - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts, stops)]


def simhash(hashes: list[int]) -> int:
    """Bit by bit, whether over half of the hashes have it; as a signed number."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), COUNT_ROWS):
        piece = np.array(hashes[at : at + COUNT_ROWS], np.uint64)
        bits = np.unpackbits(piece.view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.uint32)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, fp``: one row per input row; a NULL text has no words."""

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [simhash(shingle_hashes(t.as_py() or b"")) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values, pa.int64())], names=["id", "fp"]
            )

    rows = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("binary").alias("text")
    )
    return rows.mapInArrow(compute, "id bigint, fp bigint").withColumnRenamed("id", id_col)


def _outside(block: int) -> np.uint64:
    first, width = BLOCKS[block]
    return np.uint64(((1 << 64) - 1) ^ (((1 << width) - 1) << first))


def variants(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``block, variant, fp`` of every variant of unsigned fingerprints."""
    blocks, keys, owners = [], [], []
    for block, (first, width) in enumerate(BLOCKS):
        bits = [b for b in range(64) if not first <= b < first + width]
        flips = np.array([0] + [1 << b for b in bits], np.uint64)
        found = (fps & _outside(block))[:, None] ^ flips[None, :]
        keys.append(found.ravel())
        blocks.append(np.full(found.size, block, np.int8))
        owners.append(np.repeat(fps, len(flips)))
    return np.concatenate(blocks), np.concatenate(keys), np.concatenate(owners)


def _close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= RADIUS


def _run_links(block: int, key: np.uint64, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all close fingerprints of one variant."""
    if len(fps) <= DIRECT_ROWS:
        i, j = np.triu_indices(len(fps), 1)
        near = _close(fps[i], fps[j])
        return fps[i[near]], fps[j[near]]
    first, width = BLOCKS[block]
    inner = (fps >> np.uint64(first)) & np.uint64((1 << width) - 1)
    order = np.argsort(inner, kind="stable")
    fps, inner = fps[order], inner[order].astype(np.int64)
    same = inner[1:] == inner[:-1]
    left, right = [fps[:-1][same]], [fps[1:][same]]
    firsts = np.concatenate([[True], ~same])

    def look(values: np.ndarray, owners: np.ndarray, masks: list[int]) -> None:
        """Link rows whose erased blocks, sorted and distinct, differ by a mask."""
        for mask in masks:
            wanted = values ^ mask
            found = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
            hit = (values[found] == wanted) & (wanted > values)
            left.append(owners[hit])
            right.append(owners[found[hit]])

    one = [1 << b for b in range(width)]
    look(inner[firsts], fps[firsts], one)
    plain = (fps & _outside(block)) == key  # these met without a flip
    if plain.sum() > 1:
        look(inner[plain], fps[plain], [a | b | c for a, b, c in combinations(one, 3)])
    a, b = np.concatenate(left), np.concatenate(right)
    near = _close(a, b)
    return a[near], b[near]


class Forest:
    """Union-find over the fingerprints of a task; keeps links that join trees."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while (up := parent[x]) != top:
            parent[x], x = top, up
        return top

    def joining(self, pairs: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
        kept = []
        for a, b in pairs:
            x, y = self.root(a), self.root(b)
            if x != y:
                self.parent[max(x, y)] = min(x, y)
                kept.append((a, b))
        return kept


def _sorted_links(block: np.ndarray, key: np.ndarray, fps: np.ndarray) -> np.ndarray:
    """Links of whole runs of equal ``(block, key)``, as rows of two."""
    change = np.flatnonzero((key[1:] != key[:-1]) | (block[1:] != block[:-1])) + 1
    starts = np.concatenate([[0], change])
    sizes = np.diff(np.concatenate([starts, [len(key)]]))
    twos = starts[sizes == 2]
    a, b = fps[twos], fps[twos + 1]
    near = _close(a, b)
    left, right = [a[near]], [b[near]]
    for at, size in zip(starts[sizes > 2], sizes[sizes > 2]):
        x, y = _run_links(int(block[at]), key[at], fps[at : at + size])
        left.append(x)
        right.append(y)
    pairs = np.stack([np.concatenate(left), np.concatenate(right)], axis=1)
    return np.unique(pairs, axis=0)


def _emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        for at in range(0, len(fps), 2048):
            block, key, fp = variants(fps[at : at + 2048])
            yield pa.RecordBatch.from_arrays(
                [pa.array(block), pa.array(key.view(np.int64)), pa.array(fp.view(np.int64))],
                names=["block", "variant", "fp"],
            )


def _verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links out of variants sorted by block and key; a run may span batches."""
    forest = Forest()
    held: tuple[np.ndarray, ...] | None = None

    def links(rows: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        found = _sorted_links(*rows).view(np.int64)
        kept = forest.joining(zip(found[:, 0].tolist(), found[:, 1].tolist()))
        return pa.RecordBatch.from_arrays(
            [pa.array([p[side] for p in kept], pa.int64()) for side in (0, 1)], names=["a", "b"]
        )

    for batch in batches:
        block, key, fps = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        rows = (block, key.view(np.uint64), fps.view(np.uint64))
        if held is not None:
            rows = tuple(np.concatenate(pair) for pair in zip(held, rows))
        last = (rows[1] != rows[1][-1]) | (rows[0] != rows[0][-1])
        whole = int(last.sum())  # rows before the last run
        held = tuple(c[whole:] for c in rows)
        if whole:
            yield links(tuple(c[:whole] for c in rows))
    if held is not None and len(held[0]):
        yield links(held)


def close_links(fps: DataFrame) -> DataFrame:
    """``a, b``: links that connect all of the distinct ``fp`` within the radius."""
    emitted = fps.mapInArrow(_emit, "block tinyint, variant bigint, fp bigint")
    return (
        emitted.repartition("block", "variant")
        .sortWithinPartitions("variant", "block")
        .mapInArrow(_verify, "a bigint, b bigint")
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_root: bool = False
) -> DataFrame:
    """``id_col, fp, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links of fingerprints
    that differ in at most three bits. NULL texts and texts without words have
    fingerprint zero and link like any other. Repeated rows give equal rows. A
    row without an id keeps its fingerprint and takes its group's component,
    but no component is named after it. An empty table gives an empty result.
    ``with_root`` adds the ``root``, one fingerprint of the component: where rows of
    one id have different texts, two components may be named after the same id.
    """
    own = ["root"] if with_root else []
    prints = written(fingerprints(docs, id_col, text_col))
    groups = written(prints.groupBy("fp").agg(F.min(id_col).alias("smallest")))
    roots = connected_components(close_links(groups.select("fp")), "a", "b")
    labelled = groups.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "smallest", F.coalesce("root", "fp").alias("root")
    )
    labelled = written(labelled)
    # A component may hold very many fingerprints, so its smallest id is merged
    # in an aggregation and joined back to a written table.
    least = written(labelled.groupBy("root").agg(F.min("smallest").alias("component_id")))
    named = written(labelled.join(least, "root").select("fp", "component_id", *own))
    return prints.join(named, "fp").select(id_col, "fp", "component_id", *own)


def fingerprint_text(fp: str = "fp"):
    """A fingerprint as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
