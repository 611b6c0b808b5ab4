"""Tokenizing and word-cleaning expressions.

Cleaning works on a whole line at a time: every rule is one regular
expression over the line, so it stays in generated code and needs no
per-token lambda.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token delimiters, and the punctuation stripped from words.
DELIMITERS = r" \t\n\r\f"
LEADING_PUNCTUATION = r"\"_\-"
TRAILING_PUNCTUATION = r".,;\"!?_\-:"
FOOTNOTE_LENGTH = 5

_GAP = f"[{DELIMITERS}]+"
_IN_TOKEN = f"[^{DELIMITERS}]"
# Letters one by one: a class without ranges is a single table lookup.
_LETTER = f"[{string.ascii_lowercase}]"


def _leading_run(kind: str) -> str:
    """Run of characters of a class at the start of a token.

    The class is tried before the lookbehind: most characters fail it at once.
    """
    return f"{kind}(?<!{_IN_TOKEN}{kind}){kind}*+"


def _trailing_run(kind: str) -> str:
    """Run of characters of a class at the end of a token.

    A match starts only at the head of a run, so a long run in mid-token is
    scanned once and not once per character.
    """
    return f"{kind}(?<!{kind}{kind}){kind}*+(?!{_IN_TOKEN})"


_LEADING = _leading_run(f"[{LEADING_PUNCTUATION}]")
_TRAILING = _trailing_run(f"[{TRAILING_PUNCTUATION}]")
# What is left of a token between its stripped ends. Tried at the head of a token
# only, so a long token without such a word is scanned once.
_WORD = rf"(?<!{_IN_TOKEN})[{LEADING_PUNCTUATION}]*+({_IN_TOKEN}*[^{DELIMITERS}{TRAILING_PUNCTUATION}])"
# From the first letter of a token to its last.
_LETTER_WORD = rf"{_LETTER}(?:{_IN_TOKEN}*{_LETTER})?"
_FOOTNOTE = rf"({_IN_TOKEN}{{{FOOTNOTE_LENGTH}}})(?<=\])(?!{_IN_TOKEN})"
_DOUBLE_DASH = rf"(?<!{_IN_TOKEN})(?<!\n)({_IN_TOKEN}*?)--({_IN_TOKEN}*)"


def tokens(line: Column) -> Column:
    """Non-empty whitespace-separated tokens of a line, in order."""
    return F.array_remove(F.split(line, _GAP), "")


def token_count(line: Column) -> Column:
    return F.regexp_count(line, F.lit(f"[^{DELIMITERS}]+")).cast("long")


def strip_punctuation(line: Column) -> Column:
    """Drop the listed punctuation at the ends of every token of a line."""
    return F.regexp_replace(F.regexp_replace(line, _LEADING, ""), _TRAILING, "")


def stripped_words(line: Column) -> Column:
    """The tokens of a line, stripped like that; empty ones are dropped."""
    return F.regexp_extract_all(line, F.lit(_WORD), F.lit(1))


def split_footnotes(line: Column) -> Column:
    """Cut the last five characters off tokens that end in ``]``.

    The cut is marked with a newline, which no input line holds, so that
    ``split_double_dash`` can tell a footnote from a word.
    """
    return F.regexp_replace(line, _FOOTNOTE, "\n$1")


def split_double_dash(line: Column) -> Column:
    """Cut every token (footnotes aside) at its first ``--``."""
    return F.regexp_replace(line, _DOUBLE_DASH, "$1 $2")


def clean_words(line: Column) -> Column:
    """Lower-case words of a line with punctuation, footnotes and dashes resolved."""
    plain = F.lower(F.translate(line, "\n", " "))
    cut = split_double_dash(strip_punctuation(split_footnotes(strip_punctuation(plain))))
    has_cuts = F.contains(line, F.lit("]")) | F.contains(line, F.lit("--"))
    return F.when(has_cuts, stripped_words(cut)).otherwise(stripped_words(plain))


def line_letter_words(line: Column) -> Column:
    """Distinct lower-case words of a line, everything but A-Z and a-z stripped at the ends."""
    return F.array_distinct(F.regexp_extract_all(F.lower(line), F.lit(_LETTER_WORD), F.lit(0)))


def letter_words(line_tokens: Column) -> Column:
    """The same of a token array."""
    return line_letter_words(F.array_join(line_tokens, " "))


def first_token(line: Column) -> tuple[Column, Column]:
    """The first token of a line, empty if there is none, and what follows it."""
    head = F.regexp_extract(line, f"{_IN_TOKEN}+", 0)
    return head, F.substr(line, F.instr(line, head) + F.length(head))


def section(line_tokens: Column, start: str, stop: str) -> Column:
    """Tokens between the first ``start`` and the next ``stop``; empty if either lacks."""
    begin = F.array_position(line_tokens, start).cast("int")
    rest = F.slice(line_tokens, begin + 1, F.size(line_tokens))
    length = F.array_position(rest, stop).cast("int")
    return F.when(
        (begin > 0) & (length > 0), F.slice(rest, F.lit(1), F.greatest(length - 1, F.lit(0)))
    ).otherwise(F.array().cast("array<string>"))
