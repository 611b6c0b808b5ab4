"""Bit-sliced top-k against plain inner products."""

import math

import numpy as np
import pytest

from clickloom.llm import bit_sliced_topk as bt

SF = "/root/testdata/sf0.001"


def plain(rows, queries, k=5):
    good = {i: [math.floor(256 * x) for x in v] for i, v in rows if i is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q in queries:
        if q in good:
            scores = [(-sum(a * b for a, b in zip(good[q], v)), i) for i, v in good.items()
                      if i != q and len(v) == len(good[q])]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])}
    return out


def test_against_inner_products(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = bt.top_k(vectors, vectors.filter("vec_id % 7 = 0")).collect()
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    assert {tuple(r) for r in got} == plain(rows, [i for i, _ in rows if i % 7 == 0])


def test_odd_rows_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (3, [1.0, -0.5]), (4, None), (5, [1.0, None]),
        (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [-3.0, 2.0]), (9, []), (10, [1.0]), (None, [1.0, 1.0]), (11, [0.0, 0.0]),
        (12, [1000.0, -1000.0]), (13, [1e-9, -1e-9]),
    ]
    vectors = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int")
    got = bt.top_k(vectors, vectors).collect()
    assert {tuple(r) for r in got} == plain(rows, [i for i, _ in rows])
    assert bt.top_k(vectors.limit(0), vectors).collect() == []
    assert bt.top_k(vectors, vectors.limit(0)).collect() == []


def test_large_components(spark):
    """Scores beyond what floating numbers hold exactly, and vectors of other lengths."""
    rows = [(0, [1e6, 1.0]), (1, [2e6, 1.0]), (2, [1e6, 1.0]), (50, [3e6, 0.0]), (3, [1e6, 1.00390625]), (51, [1.0, -3e6])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = bt.top_k(vectors, vectors).collect()
    assert {tuple(r) for r in got} == plain(rows, [i for i, _ in rows])
    assert (50, 1, 1, 393216000000000000) in {tuple(r) for r in got}


@pytest.mark.parametrize("x", [1e30, 1e12])
def test_what_does_not_fit_is_an_error(spark, x):
    vectors = spark.createDataFrame([(0, [x, x]), (1, [x, x])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits|too large|overflow|Overflow"):
        bt.top_k(vectors, vectors).collect()


def test_repeated_query_ids(spark):
    rows = [(1, [2.0]), (1, [1.0]), (2, [3.0]), (3, [-1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {tuple(r) for r in bt.top_k(vectors, vectors.filter("vec_id < 3")).collect()}
    assert got == {(1, 1, 2, 196608), (1, 2, 3, -65536), (2, 1, 1, 393216), (2, 2, 1, 196608), (2, 3, 3, -196608)}


@pytest.mark.parametrize("n", [1, 3, 64, 65, 500])
def test_index(n):
    rng = np.random.default_rng(n)
    values = rng.integers(-200, 200, (n, 9))
    values[:, 3] = 7
    index = bt.Index(values)
    for query in (rng.integers(-300, 300, 9), np.zeros(9, int), -np.arange(9)):
        slices, constant = index.score_slices(query)
        scores = values @ query
        order = sorted(range(n), key=lambda r: (-scores[r], r))[:5]
        assert index.top(slices, 5, index.all) == [(r, scores[r] - constant) for r in order]
