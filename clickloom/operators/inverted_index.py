"""Inverted indexes: header address to message ids, and word to verses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.text import first_token, line_letter_words, section, tokens
from clickloom.operators.groups import ordered_groups, sampled
from clickloom.operators.postings import posting_lists

# A posting list longer than this is split into several rows.
SEGMENT_POSTINGS = 100_000

# Header sections of an email line and the token ending each.
HEADER_SECTIONS = (
    ("From:", "To:"),
    ("To:", "Subject:"),
    ("Cc:", "Mime-Version:"),
    ("Bcc:", "X-From:"),
)
MESSAGE_ID = "Message-ID:"
END_OF_HEADERS = "X-From:"


def header_addresses(lines: DataFrame, text: Column) -> DataFrame:
    """``key, message_id`` per address; the key is the header and the address."""
    words = F.col("words")
    end = F.array_position(words, END_OF_HEADERS).cast("int")
    id_at = F.array_position(words, MESSAGE_ID).cast("int")
    headers = (
        lines.select(tokens(text).alias("words"))
        .select(F.when(end > 0, F.slice(words, F.lit(1), end)).otherwise(words).alias("words"))
        .select(
            F.when(id_at > 0, F.get(words, id_at)).alias("message_id"),
            *[section(words, start, stop).alias(start) for start, stop in HEADER_SECTIONS],
        )
    )

    def keyed(header: str) -> Column:
        return F.transform(F.col(header), lambda address: F.concat(F.lit(header), address))

    # A line without an id explodes to nothing. As a filter the same test would
    # be pushed down to the text and tokenize it a second time.
    entries = F.when(
        F.col("message_id").isNotNull(), F.concat(*[keyed(start) for start, _ in HEADER_SECTIONS])
    )
    return headers.select(F.explode(entries).alias("key"), "message_id").select(
        F.regexp_replace("key", ",$", "").alias("key"), "message_id"
    )


def header_index(
    lines: DataFrame,
    text: Column,
    *,
    distinct: bool = False,
    segment_size: int = SEGMENT_POSTINGS,
    unobserved: DataFrame | None = None,
) -> DataFrame:
    """Sorted message ids per key: ``key, segment, postings, message_ids``.

    ``unobserved`` may give the lines without a job's counters.
    """
    plain = lines if unobserved is None else unobserved
    groups = ordered_groups(
        header_addresses(lines, text),
        ["key"],
        F.col("message_id"),
        distinct=distinct,
        segment_size=segment_size,
        sample=header_addresses(sampled(plain, segment_size), text),
    )
    return groups.select(
        "key",
        "segment",
        F.col("group_size").alias("postings"),
        F.array_join("items", ",").alias("message_ids"),
    )


def message_postings(entries: DataFrame) -> DataFrame:
    """``key, message_id, postings``: how often a message names a key, as a map.

    The map numbers the occurrences from 1, each with the id of the message.
    """
    counted = entries.groupBy("key", "message_id").agg(F.count(F.lit(1)).cast("int").alias("n"))
    numbers = F.sequence(F.lit(1), F.col("n"))
    ids = F.array_repeat(F.col("message_id"), F.col("n"))
    return counted.select("key", "message_id", F.map_from_arrays(numbers, ids).alias("postings"))


def _reference(lines: DataFrame, text: Column) -> DataFrame:
    """``rest, book, chapter, verse`` and labels per line, read once a line."""
    reference = F.col("reference")
    head, rest = first_token(text)

    def number(place: int) -> Column:
        return F.get(reference, place).try_cast("bigint")

    def label(place: int) -> Column:
        return F.when(number(place).isNull(), F.get(reference, place))

    return lines.select(F.split(head, ":").alias("reference"), rest.alias("rest")).select(
        "rest",
        F.get(reference, 0).alias("book"),
        number(1).alias("chapter"),
        label(1).alias("chapter_label"),
        number(2).alias("verse"),
        label(2).alias("verse_label"),
    )


def verse_words(lines: DataFrame, text: Column) -> DataFrame:
    """``word, book, chapter, verse`` and labels for the distinct words of each verse line.

    A chapter or verse that is no number stands in ``chapter_label`` or
    ``verse_label``; it sorts before the numbers and prints as written.
    """
    # The words stay inside the explosion: for a column of arrays the optimizer
    # adds a filter that cuts every line a second time.
    return _reference(lines, text).select(
        F.explode(line_letter_words(F.col("rest"))).alias("word"),
        "book",
        "chapter",
        "chapter_label",
        "verse",
        "verse_label",
    )


def _text_order(value: Column) -> Column:
    """Sorts as ``value``, whatever follows: no other character is below the closing one."""
    return F.concat(F.replace(value, F.lit("\0"), F.lit("\0\2")), F.lit("\0\1"))


def _number_order(number: Column, label: Column) -> Column:
    """A text that sorts as the number, or before all numbers as the label, or first without both."""
    digits = number.cast("string")
    # Without its sign bit a negative number is counted from the smallest one.
    below = F.lpad(F.hex(number.bitwiseAND(F.lit((1 << 63) - 1))), 16, "0")
    return (
        F.when(number >= 0, F.concat(F.lit("\0\6"), F.lpad(F.length(digits).cast("string"), 2, "0"), digits))
        .when(number < 0, F.concat(F.lit("\0\5"), below, digits))
        .when(label.isNotNull(), F.concat(F.lit("\0\4"), _text_order(label)))
        .otherwise(F.lit("\0\3"))
    )


def _printed(places: Column) -> Column:
    """Places of ``verse_lines`` in a text as they are written: parts joined by colons.

    What a place holds for its order only begins with the character 0.
    """
    text = F.regexp_replace(places, r"(?:\x00\x01)?\x00(?:\x06..|\x04|\x05.{16})", ":")
    plain = F.replace(F.replace(text, F.lit("\0\1"), F.lit("")), F.lit("\0\3"), F.lit(""))
    rare = F.replace(plain, F.lit("\0\2"), F.lit("\0"))
    return F.when(F.contains(text, F.lit("\0")), rare).otherwise(text)


def verse_lines(lines: DataFrame, text: Column) -> DataFrame:
    """``words, place`` of each verse line: its distinct words, and its reference as a text that sorts alike."""
    return _reference(lines, text).select(
        line_letter_words(F.col("rest")).alias("words"),
        F.concat(
            _text_order(F.col("book")),
            _number_order(F.col("chapter"), F.col("chapter_label")),
            _number_order(F.col("verse"), F.col("verse_label")),
        ).alias("place"),
    )


def verse_index(
    lines: DataFrame,
    text: Column,
    *,
    segment_size: int = SEGMENT_POSTINGS,
    unobserved: DataFrame | None = None,
) -> DataFrame:
    """Verses per word by book, chapter, verse: ``word, segment, postings, verses``.

    ``unobserved`` may give the lines without a job's counters.
    """
    plain = lines if unobserved is None else unobserved
    lists = posting_lists(
        verse_lines(lines, text),
        segment_size=segment_size,
        sample=verse_lines(sampled(plain, segment_size), text),
    )
    return lists.select(
        "word",
        "segment",
        F.col("group_size").alias("postings"),
        _printed(F.array_join("items", ", ")).alias("verses"),
    )
