"""Benchmark passages in documents, by SimHash windows and Hamming blocks.

1. Documents are cut into windows as long as a benchmark item. A window that
   shares no five-word shingle with any item has similarity zero, so windows
   begin only where a shared shingle puts the first word of an item.
2. Each window gets a 64-bit SimHash of its shingles, as each item does.
3. Multi-index search: fingerprints within the radius agree up to three bits in
   at least one of five blocks. Items are listed under every such block value;
   windows look theirs up, together with their length.
4. Pairs within the radius are verified on the words themselves: the weighted
   Jaccard similarity of their shingles, each weighing as often as it occurs.

Everything is DataFrame and SQL functions. The documents are read twice, but
only ids, positions and the texts of suspicious documents are shuffled.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.session import written

SHINGLE_WORDS = 5
SIMILARITY = 0.8
# Blocks of the fingerprint as first bit and width, and the flips tried in each.
# Five blocks with three flips guarantee all pairs within 5 * (3 + 1) - 1 bits.
# At similarity 0.8 about ten bits differ, with a deviation of three.
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
FLIPS = 3
RADIUS = len(BLOCKS) * (FLIPS + 1) - 1


def words_of(text: Column) -> Column:
    """Lower-case runs of letters, marks and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+"), "")


def shingle_hashes(words: str) -> Column:
    """One hash per run of five words of the array column ``words``, repeats included."""
    parts = ", ".join(["w", *[f"get({words}, i + {k})" for k in range(1, SHINGLE_WORDS)]])
    return F.expr(
        f"transform(slice({words}, 1, greatest(size({words}) - {SHINGLE_WORDS - 1}, 0)), "
        f"(w, i) -> xxhash64({parts}))"
    )


def shingles(words: str) -> Column:
    """The runs of five words themselves."""
    return F.expr(
        f"transform(slice({words}, 1, greatest(size({words}) - {SHINGLE_WORDS - 1}, 0)), "
        f"(w, i) -> array_join(slice({words}, i + 1, {SHINGLE_WORDS}), ' '))"
    )


def simhash(hashes: str) -> Column:
    """Bit by bit, whether over half of the hashes in the array have it."""
    ones = f"aggregate({hashes}, 0, (n, h) -> n + CAST(shiftright(h, b) & 1 AS INT))"
    return F.expr(
        "aggregate(sequence(0, 63), 0L, (print, b) -> "
        f"IF(2 * {ones} > size({hashes}), print | shiftleft(1L, b), print))"
    )


def block_value(fingerprint: str, first: int, width: int) -> str:
    return f"(shiftrightunsigned({fingerprint}, {first}) & {(1 << width) - 1}L)"


def blocks_of(fingerprint: str) -> Column:
    """``block, value`` of each block."""
    parts = [
        f"struct({i} AS block, {block_value(fingerprint, first, width)} AS value)"
        for i, (first, width) in enumerate(BLOCKS)
    ]
    return F.expr(f"inline(array({', '.join(parts)}))")


def near_blocks_of(fingerprint: str) -> Column:
    """``block, value`` of each block with up to three bits flipped."""

    def masks(width: int) -> str:
        found = [
            sum(1 << b for b in bits)
            for n in range(FLIPS + 1)
            for bits in combinations(range(width), n)
        ]
        return f"array({', '.join(f'{m}L' for m in found)})"

    parts = [
        f"transform({masks(width)}, m -> "
        f"struct({i} AS block, {block_value(fingerprint, first, width)} ^ m AS value))"
        for i, (first, width) in enumerate(BLOCKS)
    ]
    return F.expr(f"inline(concat({', '.join(parts)}))")


def similarity(a: str, b: str) -> Column:
    """Weighted Jaccard similarity of two arrays: summed minima over summed maxima."""
    shared = (
        f"aggregate(array_distinct({a}), 0, (n, s) -> n + "
        f"least(size(filter({a}, x -> x = s)), size(filter({b}, x -> x = s))))"
    )
    return F.expr(f"{shared} / (size({a}) + size({b}) - {shared})")


def windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``id, version, start, size``: windows that hold a shingle of an item in place.

    ``docs`` has ``id, text``, ``items`` ``words``. ``version`` tells rows of one
    id but different texts apart.
    """
    known = written(
        items.select(F.size("words").alias("size"), F.posexplode(shingle_hashes("words")).alias("item_pos", "hash"))
        .distinct()
    )
    placed = docs.select("id", F.xxhash64("text").alias("version"), words_of(F.col("text")).alias("words")).select(
        "id", "version", F.posexplode(shingle_hashes("words")).alias("pos", "hash")
    )
    return (
        placed.join(known, "hash")
        .select("id", "version", F.greatest(F.col("pos") - F.col("item_pos"), F.lit(0)).alias("start"), "size")
        .distinct()
    )


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = SIMILARITY,
) -> DataFrame:
    """``id_col, item_col, similarity, windows, first_word``: documents that hold an item.

    One row per document and item with a window of similarity ``threshold`` or
    more: the best similarity, the number of such windows, and the first word's
    place of the earliest one. Windows are clipped to the document. NULL texts,
    texts and items of fewer than five words hold no shingle and match nothing,
    rows without an id are not reported, repeated rows count once, and equal
    items are all reported. An empty table on either side gives an empty result.
    """
    items = written(
        benchmark.select(F.col(item_col).alias("item"), words_of(F.col(item_text_col)).alias("words"))
        .filter(F.col("item").isNotNull() & (F.size("words") >= SHINGLE_WORDS))
        .distinct()
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(
        F.col("id").isNotNull() & F.col("text").isNotNull()
    )
    found = written(windows(texts, items))
    # A document's own windows: no more than its words times the item lengths.
    per_document = found.groupBy("id", "version").agg(F.collect_list(F.struct("start", "size")).alias("places"))
    per_document = per_document.withColumnRenamed("id", "found_id")
    suspicious = (
        texts.join(
            per_document,
            (F.col("id") == F.col("found_id")) & (F.xxhash64("text") == F.col("version")),
        )
        .select("id", "version", words_of(F.col("text")).alias("words"), "places")
        .dropDuplicates(["id", "version"])
        .select("id", "version", "words", F.inline("places"))
        .select("id", "version", "start", "size", F.expr("slice(words, start + 1, size)").alias("words"))
    )
    prints = written(
        suspicious.withColumn("hashes", shingle_hashes("words")).select(
            "id", "version", "start", "size", "words", simhash("hashes").alias("print")
        )
    )
    item_prints = written(
        items.withColumn("hashes", shingle_hashes("words")).select(
            "item", "words", F.size("words").alias("size"), simhash("hashes").alias("print")
        )
    )
    listed = item_prints.select("item", "size", F.col("print").alias("item_print"), near_blocks_of("print"))
    asked = prints.select("id", "version", "start", "size", "print", blocks_of("print"))
    candidates = (
        asked.join(listed, ["size", "block", "value"])
        .filter(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
        .select("id", "version", "start", "size", "item")
        .distinct()
    )
    pairs = candidates.join(prints.drop("print"), ["id", "version", "start", "size"]).join(
        item_prints.select("item", F.col("words").alias("item_words"), F.col("size")), ["item", "size"]
    )
    compared = pairs.select(
        "id", "start", "item", shingles("words").alias("a"), shingles("item_words").alias("b")
    ).select("id", "start", "item", similarity("a", "b").alias("similarity"))
    return (
        compared.filter(F.col("similarity") >= threshold)
        .groupBy("id", "item")
        .agg(
            F.max("similarity").alias("similarity"),
            F.countDistinct("start").alias("windows"),
            F.min("start").cast("bigint").alias("first_word"),
        )
        .withColumnsRenamed({"id": id_col, "item": item_col})
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns, that hold no benchmark item."""
    found = written(contaminated(docs, benchmark).select(F.col("doc_id").alias("leaked")).distinct())
    return docs.join(found, docs["doc_id"] == found["leaked"], "left_anti")
