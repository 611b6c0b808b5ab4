import pytest
from pyspark.sql import functions as F

from clickloom.operators.inverted_index import (
    header_addresses,
    header_index,
    verse_index,
    verse_words,
)

EMAIL = (
    "Message-ID: <100.200.Mail@host>\t From: ann@example.org\t"
    "To: bo@example.org\tSubject: Re: a subject"
)


def addresses(df):
    return sorted(tuple(r) for r in header_addresses(df, F.col("value")).collect())


def test_email_from_and_to(lines):
    message = "<100.200.Mail@host>"
    assert addresses(lines(EMAIL)) == [
        ("From:ann@example.org", message),
        ("To:bo@example.org", message),
    ]


@pytest.mark.parametrize(
    "text, keys",
    [
        ("Message-ID: 1 From: a To: b, c, Subject: s", ["From:a", "To:b", "To:c"]),
        (
            "Message-ID: 1 From: a To: b Subject: s Cc: c d Mime-Version: 1 Bcc: e X-From: f",
            ["Bcc:e", "Cc:c", "Cc:d", "From:a", "To:b"],
        ),
        ("Message-ID: 1 From: a Subject: s X-From: f", []),
        ("Message-ID: 1 From: To: b Subject: s", ["To:b"]),
        ("Message-ID: 1 From: a To: b Subject: s X-From: To: q Subject: Cc: z Mime-Version:", ["From:a", "To:b"]),
        ("Message-ID: 1 From: a To: b Subject: To: c Subject: s", ["From:a", "To:b"]),
        ("From: a To: b Subject: s", []),
        ("Message-ID:", []),
        ("", []),
    ],
)
def test_header_sections(lines, text, keys):
    assert [k for k, _ in addresses(lines(text))] == keys


def test_repeated_address(lines):
    df, text = lines("Message-ID: 1 From: a To: b, b Subject: s"), F.col("value")
    kept = {r["key"]: r["message_ids"] for r in header_index(df, text).collect()}
    assert kept == {"From:a": "1", "To:b": "1,1"}
    once = {r["key"]: r["message_ids"] for r in header_index(df, text, distinct=True).collect()}
    assert once == {"From:a": "1", "To:b": "1"}


def test_ids_are_sorted_and_long_lists_split(lines):
    texts = [f"Message-ID: m{i} From: a To: b Subject: s" for i in (3, 1, 2)]
    rows = header_index(lines(*texts), F.col("value"), segment_size=2).collect()
    got = {(r["key"], r["segment"]): (r["postings"], r["message_ids"]) for r in rows}
    assert got["To:b", 0] == (3, "m1,m2")
    assert got["To:b", 1] == (3, "m3")


def test_verses_sort_by_book_chapter_verse(lines):
    df = lines(
        "Gen:1:1 In the beginning",
        "Gen:1:10 the dry the land",
        "Gen:1:2 (The) earth",
        "Exo:2:1 the man 12 --",
        "Gen:1:2 the earth",
        "Gen:1:3",
    )
    got = {r["word"]: r["verses"] for r in verse_index(df, F.col("value")).collect()}
    assert got["the"] == "Exo:2:1, Gen:1:1, Gen:1:2, Gen:1:10"
    assert got["earth"] == "Gen:1:2"
    assert set(got) == {"in", "the", "beginning", "dry", "land", "earth", "man"}


def test_large_and_wordy_references_stay_apart(lines):
    df = lines("Gen:3000000001:1 x", "Gen:3000000000:1 x", "Gen:1:12b x", "Gen:1:12a x", "Gen:1:7 x")
    (row,) = verse_index(df, F.col("value")).collect()
    assert row["verses"] == "Gen:1:12a, Gen:1:12b, Gen:1:7, Gen:3000000000:1, Gen:3000000001:1"
