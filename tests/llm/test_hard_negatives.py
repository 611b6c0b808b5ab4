"""Hard negatives against plain inner products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, id int, place string, vector int"


def plain(rows, is_anchor, positives=5, negatives=3):
    good = [
        (i, label, [math.floor(256 * x) for x in v]) for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    raw = {}
    for i, v, label in rows:
        if any(g[0] == i for g in good) and is_anchor(i) and (label is not None and v is not None):
            raw.setdefault(i, []).append((label, v))
    out = []
    for anchor, versions in raw.items():
        label, vector = min(versions)
        vector = [math.floor(256 * x) for x in vector]
        scored = [(-sum(a * b for a, b in zip(vector, v)), i, l) for i, l, v in good if i != anchor and len(v) == len(vector)]
        own = sorted(s for s in scored if s[2] == label)[:positives]
        for place, (score, positive, _) in enumerate(own, 1):
            fits = sorted(s for s in scored if s[2] != label and 50 * -score <= 100 * -s[0] <= 95 * -score)
            for rank, (negative_score, negative, _) in enumerate(fits[:negatives], 1):
                out.append((anchor, positive, place, rank, negative, -score, -negative_score))
    return sorted(out)


def mined(spark, rows, is_anchor, **more):
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    return sorted(tuple(r) for r in hn.hard_negatives(table, is_anchor, **more).collect())


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_against_inner_products(spark, spread):
    """Loose vectors, and tight clusters in which most bounds decide."""
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(4, 6))
    rows = [
        (i, (centres[i % 4] + spread * draw.normal(size=6)).round(2).tolist(), int(draw.integers(0, 3))) for i in range(300)
    ]
    got = mined(spark, rows, F.col("vec_id") % 10 == 0)
    assert got == plain(rows, lambda i: i % 10 == 0) and len(got) > 100


def test_odd_rows_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (1, [1.0, 0.5], 1), (2, [1.0, 0.5], 1), (3, [0.9, -0.5], 2), (4, None, 1), (5, [1.0, None], 1),
        (6, [nan, 1.0], 2), (7, [inf, 1.0], 2), (8, [0.7, 2.0], 2), (8, [0.7, 2.0], 2), (9, [], 1), (10, [1.0], 1),
        (11, [0.9], 2), (None, [1.0, 1.0], 1), (12, [0.0, 0.0], 2), (13, [0.8, 0.0], None), (14, [0.6, 1.0], 3),
        (15, [0.6, 1.0], 3), (0, [1.0, 0.0], 1), (16, [-1.0, 0.0], 1), (17, [-0.6, 0.0], 2), (18, [3e6, 3e6], 4),
        (19, [2e6, 2e6], 5), (20, [3e6, 3e6], 4),
    ]
    got = mined(spark, rows, F.lit(True))
    assert got == plain(rows, lambda i: True) and got
    assert mined(spark, rows, F.lit(False)) == mined(spark, [], F.lit(True)) == []
    assert mined(spark, rows[:3], F.lit(True)) == []
    assert mined(spark, rows, F.lit(True), positives=1, negatives=1) == plain(rows, lambda i: True, 1, 1)


def test_scores_beyond_64_bits_are_an_error(spark):
    rows = [(i, [1e30, 1e30], i % 2) for i in range(6)]
    with pytest.raises(Exception, match="(?i)overflow|too large|convert|out of bounds|long"):
        mined(spark, rows, F.lit(True))


def test_bounds_spare_scores(monkeypatch):
    """In tight clusters most candidates are settled by their bounds."""
    draw = np.random.default_rng(5)
    centres = 300 * draw.normal(size=(8, 16))
    anchors = np.floor(centres[np.arange(64) % 8] + 3 * draw.normal(size=(64, 16)))
    rows = np.floor(centres[np.arange(2000) % 8] + 3 * draw.normal(size=(2000, 16)))
    scored = []
    plain_products = hn.inner_products
    monkeypatch.setattr(hn, "inner_products", lambda r, v: scored.append(len(r)) or plain_products(r, v))
    ids, labels = np.arange(2000), np.zeros(2000, int)
    got = sorted(hn.cell_positives(-1 - np.arange(64), np.zeros(64, int), anchors, ids, labels, rows, 5))
    expected = []
    for a in range(64):
        s = rows @ anchors[a]
        expected += [(-1 - a, i, int(s[i])) for i in sorted(range(2000), key=lambda i: (-s[i], i))[:5]]
    assert got == sorted(expected)
    assert sum(scored) < 0.5 * 64 * 2000


def test_spanning_tree():
    draw = random.Random(2)
    points = np.array([[draw.randint(-50, 50) for _ in range(3)] for _ in range(40)], float)
    edges = hn.spanning_tree(points)
    seen = {-1}
    for node, parent, length in edges:
        assert parent in seen
        seen.add(node)
        assert length == pytest.approx(np.linalg.norm(points[node] - (points[parent] if parent >= 0 else 0)))
    assert seen == {-1, *range(40)}
    # No tree is shorter: compare with Kruskal's.
    nodes = [np.zeros(3), *points]
    pairs = sorted((np.linalg.norm(a - b), i, j) for i, a in enumerate(nodes) for j, b in enumerate(nodes) if i < j)
    group, total = list(range(41)), 0.0
    for length, i, j in pairs:
        if group[i] != group[j]:
            total += length
            group = [group[i] if g == group[j] else g for g in group]
    assert sum(e[2] for e in edges) == pytest.approx(total)
