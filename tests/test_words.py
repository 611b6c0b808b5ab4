import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom.functions.rendering import posting_map_text, statistics_text
from clickloom.functions.text import clean_words, letter_words, tokens
from clickloom.operators import counters, word_statistics
from clickloom.operators.word_count import sorted_by_word, word_count



def rows(df):
    return [tuple(r) for r in df.collect()]


def test_word_count(lines):
    assert rows(word_count(lines("Yadayada"), F.col("value"))) == [("Yadayada", 1)]
    assert rows(word_count(lines(*["Yadayada"] * 3), F.col("value"))) == [("Yadayada", 3)]


def test_tokens_use_five_delimiters_and_keep_no_blanks(lines):
    got = lines(" a\tb\r\fc  d\x0be ").select(tokens(F.col("value"))).first()[0]
    assert got == ["a", "b", "c", "d\x0be"]
    assert lines("").select(tokens(F.col("value"))).first()[0] == []


def test_sorted_word_count(lines):
    assert rows(sorted_by_word(word_count(lines("b a b", "C"), F.col("value")))) == [
        ("C", 1),
        ("a", 1),
        ("b", 2),
    ]


@pytest.mark.parametrize(
    "text, words",
    [
        ("Yadayada", ["yadayada"]),
        ('"_Hello,_"', ["hello"]),
        ("foo--bar", ["foo", "bar"]),
        ("a--b", ["a", "b"]),
        ("a--b--c", ["a", "b--c"]),
        ("word.[123]", ["word", "[123]"]),
        ("word[123].", ["word", "[123]"]),
        ("[123]", ["[123]"]),
        ("x]", ["x]"]),
        ("--", []),
        ("...", []),
        ("", []),
        ("a--b[123] c", ["a", "b", "[123]", "c"]),
        ("x[a--]", ["x", "[a--]"]),
        ("it's well-known", ["it's", "well-known"]),
        ("-.-x.-.", [".-x"]),
    ],
)
def test_cleaning(lines, text, words):
    got = lines(text).select(clean_words(F.col("value"))).first()[0]
    assert sorted(got) == sorted(words)


def model_words(line):
    """Token-by-token statement of the cleaning rules."""

    def strip(word):
        return word.lstrip('"_-').rstrip('.,;"!?_-:')

    found = []
    for token in re.split("[ \t\n\r\f]+", line.lower()):
        word = strip(token)
        if word.endswith("]") and len(word) >= 5:
            found.append(strip(word[-5:]))
            word = strip(word[:-5])
        head, dashes, tail = word.partition("--")
        found.append(strip(head))
        if dashes:
            found.append(strip(tail))
    return sorted(w for w in found if w)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet='aB[]-_".,: \t', max_size=25), min_size=1, max_size=25))
def test_cleaning_matches_token_model(lines, texts):
    got = lines(*texts).select("value", F.sort_array(clean_words(F.col("value")))).collect()
    for text, words in got:
        assert words == model_words(text), text


def test_letter_words(lines):
    got = lines("(The) 'end'  12 the, x-1y é").select(letter_words(tokens(F.col("value")))).first()[0]
    assert got == ["the", "end", "x-1y"]


def test_statistics_of_one_word(lines):
    got = word_statistics.word_statistics(lines("Yadayada"), F.col("value"))
    assert rows(got) == [("yadayada", 1, 1.0, 0.0)]
    record = word_statistics.paragraph_records(lines("Yadayada"), F.col("value"))
    assert rows(record) == [("yadayada", 1)]


def test_merging_partial_states(spark):
    states = spark.createDataFrame(
        [("w", 1, 1, 1, 1, 2), ("w", 5, 4, 1, 2, 3), ("w", 1, 1, 1, 1, 4)],
        "word string, document_count long, total_count long, min long, max long, "
        "sum_of_squares long",
    )
    got = word_statistics.finish(word_statistics.merge_states(states)).first()
    assert (got["document_count"], got["total_count"], got["sum_of_squares"]) == (7, 6, 9)
    assert got["mean"] == 0.8571428571428571
    assert got["variance"] == 0.5510204081632655


def test_full_statistics_and_paragraph_length(lines):
    texts = ["a a b", "a", "", "b--b a. x y"]
    got = {r[0]: tuple(r)[1:] for r in word_statistics.word_statistics_full(lines(*texts), F.col("value")).collect()}
    assert got["a"][:5] == (3, 4, 1, 2, 6)
    assert got["b"][:5] == (2, 3, 1, 2, 5)
    # The length counts whitespace tokens, so ``b--b`` is one; a blank line is 0.
    assert got["paragraph length"][:5] == (4, 8, 0, 4, 26)
    lengths = word_statistics.paragraph_lengths(lines(*texts), F.col("value"))
    alone = word_statistics.finish(word_statistics.partial_states(lengths)).first()
    assert tuple(alone)[1:] == got["paragraph length"]


def test_paragraph_words_against_counting(lines):
    text = "b a c a b a the the"
    got = word_statistics.paragraph_words(lines(text), F.col("value"), [])
    assert dict(rows(got)) == Counter(text.split())


def test_counters(lines):
    source = lines("a b", "", "b")
    got = counters.word_counters(source, F.col("value"))
    assert dict(rows(got)) == {"input_lines": 3, "words_out": 3, "groups_out": 2}


def test_observed_counters(lines):
    taken = counters.Counters()
    blank = F.count_if(F.col("value") == "")
    df = taken.rows(lines("a", "", "b"), "read", blank=blank)
    assert df.count() == 3
    assert taken.values() == {"read": 3, "blank": 1}


def test_renderings(spark):
    row = spark.range(1).select(
        statistics_text(F.lit(7), F.lit(0.5), F.lit(0.25)),
        posting_map_text(F.create_map(F.lit(1), F.lit("x"), F.lit(2), F.lit("y"))),
    )
    assert tuple(row.first()) == ("7,0.5,0.25", "x y")


def test_words_of_odd_letters(lines):
    # A letter beyond 16 bits inside a word stays; one that is no a-z ends at the borders.
    got = lines("z-𝒜z é𝒜kKé ---- a" + "-" * 50_000 + "b").select(letter_words(tokens(F.col("value")))).first()[0]
    assert got == ["z-𝒜z", "kk", "a" + "-" * 50_000 + "b"]
    got = lines("." * 200_000, '_"a.' + "." * 100_000, "x" * 100_000).select(clean_words(F.col("value"))).collect()
    assert [r[0] for r in got] == [[], ["a"], ["x" * 100_000]]
