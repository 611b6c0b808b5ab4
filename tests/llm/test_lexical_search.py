"""Lexical search against a plain evaluation of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from clickloom.llm import lexical_search as ls

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, item_id int, score int"
ITEMS = "item_id long, text string, rank int, doc_id int"


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k=10):
    held = [(i, Counter(words(t))) for i, t in docs]
    n_docs, total = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for item, text in set(items):
        asked.setdefault(item, Counter()).update(words(text))
    out = []
    for item, query in asked.items():
        found = []
        for doc_id, c in held:
            score = 0
            for term, times in query.items():
                if tf := c[term]:
                    m = 25 + 75 * sum(c.values()) * n_docs // total
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += times * w * (10**9 * tf // (1000 * tf + 8 * m))
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, no_id, doc_id) in enumerate(sorted(found)[:k], 1):
            out.append((item, rank, None if no_id else doc_id, -score))
    return sorted(out, key=repr)


def found(rows):
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def test_odd_rows(spark):
    docs = [
        (1, "The cat sat. The CAT ran"), (2, "a dog"), (3, "cat"), (4, None), (5, ""), (6, " .,;"), (7, "cat"),
        (7, "cat"), (None, "cat"), (8, "Été été ÉTÉ x1 2"), (9, "word " * 50_000 + "cat"), (10, "x" * 100_000),
        (-3, "cat"), (0, "dog dog"),
    ]
    items = [
        (1, "cat the"), (2, None), (3, "unseen words"), (4, "CAT cat dog"), (4, "CAT cat dog"), (5, "dog"), (5, "été x1"),
        (None, "cat"), (6, "..."), (7, "word"),
    ]
    d = spark.createDataFrame([(*r, 1, 2) for r in docs], DOCS)
    i = spark.createDataFrame([(*r, 1, 2) for r in items], ITEMS)
    assert found(ls.rank_documents(d, i)) == plain(docs, items)
    assert found(ls.rank_documents(d, i, k=2, block_terms=2)) == plain(docs, items, 2)
    assert found(ls.rank_documents(d.limit(0), i)) == found(ls.rank_documents(d, i.limit(0))) == []


@pytest.mark.parametrize("seed", range(3))
def test_random_documents(spark, seed):
    """Many ties and groups, several blocks, and items of over 64 terms."""
    draw = random.Random(seed)
    names = [f"w{n}" for n in range(150)]
    docs = [(n, " ".join(draw.choices(names[: draw.choice((5, 40, 150))], k=draw.randint(0, 60)))) for n in range(600)]
    items = [(n, " ".join(draw.choices(names, k=draw.choice((1, 3, 12, 200))))) for n in range(12)]
    d = spark.createDataFrame([(*r, 1, 2) for r in docs], DOCS)
    i = spark.createDataFrame([(*r, 1, 2) for r in items], ITEMS)
    assert found(ls.rank_documents(d, i)) == plain(docs, items)
    assert found(ls.rank_documents(d, i, block_docs=20)) == plain(docs, items)


def test_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(ls, "PIECE", 7)
    text = "Some words,of ÄÖ different length AND1 a " * 9
    assert [w.decode() for part in ls.terms(text.encode()) for w in part] == words(text)


def test_groups_beyond_the_bound_are_not_scored(monkeypatch):
    """Of documents with one common term, only the group with a rare one is scored."""
    asked = ls.Asked({b"common": 0, b"rare": 1}, [1], [np.array([0, 1])], [np.array([1, 1])])
    asked.docs, asked.total, asked.weights = 5000, 10_000, np.array([10, 8000])
    block = ls.Block(asked)
    for n in range(5000):
        block.add(n, b"common x" if n % 100 else b"common rare")
    block.index()
    scored = []
    plain_scores = ls.Block.scores
    monkeypatch.setattr(ls.Block, "scores", lambda self, docs, *a: scored.append(len(docs)) or plain_scores(self, docs, *a))
    best = ls.Best(10)
    block.search(0, best)
    assert [doc for *_, doc in best.rows] == list(range(0, 1000, 100)) and sum(scored) < 200
