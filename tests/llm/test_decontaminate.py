"""Benchmark passages against a brute force over every window."""

import re
from collections import Counter

import pytest

from clickloom.llm import decontaminate as dc

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def runs(found):
    return Counter(" ".join(found[i : i + 5]) for i in range(len(found) - 4))


def best(text, item):
    doc, item = words(text), words(item)
    b = runs(item)
    if not b:
        return 0.0
    top = 0.0
    for start in range(max(1, len(doc) - len(item) + 1)):
        a = runs(doc[start : start + len(item)])
        top = max(top, sum((a & b).values()) / max(1, sum((a | b).values())))
    return top


def test_against_every_window(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = {(r.doc_id, r.item_id): r.similarity for r in dc.contaminated(docs, items).collect()}
    known = items.collect()
    expected = {}
    for d in docs.collect():
        for item in known:
            if runs(words(item.text)) & runs(words(d.text)):  # else zero
                if (value := best(d.text, item.text)) >= 0.8:
                    expected[d.doc_id, item.item_id] = value
    assert expected and got == pytest.approx(expected)


ITEM = "the quick brown fox jumps over a lazy dog while seven clever owls keep watch from the old oak"
LONG = " ".join(f"filler{i}" for i in range(30_000))


def test_edits_and_odd_rows(spark):
    changed = ITEM.split()
    near = " ".join(["a", *changed[1:]])
    far = " ".join([*changed[:9], "cat", *changed[10:]])
    rows = [
        (1, ITEM.upper() + "!", "x"), (2, f"{LONG} {ITEM}, {LONG}", "x"), (3, f"pre {near} post", "x"),
        (4, far, "x"), (5, None, "x"), (6, "", "x"), (7, "the quick brown fox", "x"), (None, ITEM, "x"),
        (1, ITEM.upper() + "!", "x"), (8, f"{ITEM} {ITEM}", "x"), (9, " ".join(changed[:-1]), "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, words string")
    items = [(1, ITEM), (2, "too short"), (3, None), (None, ITEM), (4, ITEM), (1, ITEM)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): round(r.similarity, 4) for r in dc.contaminated(docs, bench).collect()}
    n = len(changed) - 4
    expected = {(d, i): s for i in (1, 4) for d, s in
                ((1, 1.0), (2, 1.0), (3, round((n - 1) / (n + 1), 4)), (8, 1.0), (9, round((n - 1) / n, 4)))}
    assert got == expected
    kept = sorted(r.doc_id for r in dc.without_benchmark(docs, bench).collect() if r.doc_id)
    assert kept == [4, 5, 6, 7]
    assert dc.contaminated(docs.limit(0), bench).collect() == []
    assert dc.contaminated(docs, bench.limit(0)).collect() == []
    assert dc.without_benchmark(docs, bench.limit(0)).count() == len(rows)


def test_blocks_meet_within_the_radius(spark):
    import random

    rnd = random.Random(2)
    pairs = []
    for i in range(200):
        a = rnd.getrandbits(64) - (1 << 63)
        flips = rnd.sample(range(64), rnd.randrange(dc.RADIUS + 1))
        b = (a & (2**64 - 1)) ^ sum(1 << f for f in flips)
        pairs.append((i, a, b - (1 << 64) if b >= 1 << 63 else b))
    df = spark.createDataFrame(pairs, "i long, a long, b long")
    left = df.select("i", dc.blocks_of("a"))
    right = df.select("i", dc.near_blocks_of("b"))
    assert left.join(right, ["i", "block", "value"]).select("i").distinct().count() == 200


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = dc.without_benchmark(docs, spark.read.parquet(f"{SF}/benchmark.parquet"))
    text = plan._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text and "Cartesian" not in text
