"""The toxicity chain on a small corpus, and on odd rows."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from clickloom.llm import toxicity_chain as tc

DOCS = "doc_id long, text string, words int"
LABELS = "doc_id long, quality int, toxic int"


def test_learns_a_word_and_takes_odd_rows(spark):
    rows = [(i, f"some plain words {'vile' if i % 4 == 0 else 'kind'}", 1) for i in range(80)]
    rows += [(100, None, 1), (101, "", 1), (102, "A VILE thing", 1), (102, "A VILE thing", 1), (None, "kind words", 1)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(80)] + [(200, None, 1), (None, 1, 1)], LABELS)
    got = tc.judge_documents(spark.createDataFrame(rows, DOCS), labels).collect()
    assert len(got) == len(rows) and all(0 <= r.p_toxic <= 1 for r in got)
    toxic = {r.doc_id for r in got if r.toxic}
    assert toxic == {i for i in range(80) if i % 4 == 0} | {102}


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "x", 1)], DOCS)
    (row,) = tc.judge_documents(docs, spark.createDataFrame([], LABELS)).collect()
    assert row.p_toxic == 0 and not row.toxic
    assert tc.judge_documents(docs.limit(0), spark.createDataFrame([], LABELS)).collect() == []


def test_rare_insults_are_found(spark):
    """Eight insults, each in 0.4 % of the documents."""
    rows = [(i, f"some plain words {f'vile{chr(97 + i % 8)}' if i < 48 else 'kind'}", 1) for i in range(1500)]
    labels = spark.createDataFrame([(i, 1, int(i < 48)) for i in range(1500)], LABELS)
    got = tc.judge_documents(spark.createDataFrame(rows, DOCS), labels).collect()
    assert {r.doc_id for r in got if r.toxic} == set(range(48))


def test_sample_keeps_rare_labels(spark):
    rows = [(i, "some words", 1) for i in range(2000)]
    labels = spark.createDataFrame([(i, 1, int(i < 20)) for i in range(2000)], LABELS)
    got = tc.labelled_sample(spark.createDataFrame(rows, DOCS), labels, most=200).collect()
    assert sum(r.toxic for r in got) == 20 and 120 < len(got) < 280
    assert abs(sum(r.weight for r in got) - 2000) < 500


def plain_fit(x, y, w):
    """The same minimum by many small proximal steps on a dense matrix."""
    n, m = x.shape
    beta, ahead, t, b = np.zeros(m + 1), np.zeros(m + 1), 1.0, np.concatenate([np.ones((n, 1)), x], axis=1)
    step = 4 / np.linalg.eigvalsh(b.T @ (b * w[:, None])).max()
    for _ in range(20_000):
        p = 1 / (1 + np.exp(-(b @ ahead)))
        to = ahead - step * (b.T @ (w * (p - y)))
        to[1:] = np.sign(to[1:]) * np.maximum(np.abs(to[1:]) - step * tc.EVIDENCE * math.sqrt(w.sum()), 0)
        later = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead, beta, t = to + (t - 1) / later * (to - beta), to, later
    return beta


def documents(n, seed):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        bad, low = draw.random() < 0.3, draw.random() < 0.4
        text = [draw.choice("some plain words about rivers hills and towns".split()) for _ in range(6)]
        text += ["vile"] * (bad and draw.random() < 0.9) + ["spam"] * (low and draw.random() < 0.8)
        rows.append((i, " ".join(text), int(bad), int(low)))
    return rows


def test_against_a_plain_chain(spark):
    rows = documents(120, 1)
    names = ("toxic", "low")
    frame = spark.createDataFrame(rows, "id long, text string, toxic int, low int")
    chain = tc.fit(frame, names)
    got = {r.doc_id: (r.p_toxic, r.p_low) for r in tc.predict(frame, chain, "id").withColumnRenamed("id", "doc_id").collect()}
    folds = {r.id: r.f for r in frame.selectExpr("id", "pmod(xxhash64(id, 'fold'), 3) AS f").collect()}
    words = sorted({w for _, t, *_ in rows for w in t.split()})
    x = np.array([[float(w in t.split()) for w in words] for _, t, *_ in rows])
    toxic, low = (np.array([r[c] for r in rows], float) for c in (2, 3))
    fold, ones = np.array([folds[r[0]] for r in rows]), np.ones(len(rows))

    def p(beta, m):
        return 1 / (1 + np.exp(-(beta[0] + m @ beta[1:])))

    first = plain_fit(x, toxic, ones)
    out_of_fold = np.zeros(len(rows))
    for f in range(3):
        beta = plain_fit(x[fold != f], toxic[fold != f], ones[fold != f])
        out_of_fold[fold == f] = p(beta, x[fold == f])
    second = plain_fit(np.column_stack([out_of_fold, x]), low, ones)
    expected = p(first, x)
    for i, (row, a) in enumerate(zip(rows, expected)):
        b = p(second, np.column_stack([expected, x])[i : i + 1])[0]
        assert got[row[0]] == pytest.approx((a, b), abs=0.02)


def test_sparse_rows():
    lists = pa.array([[1, 5], [], [5], [7, 9, 1]], pa.list_(pa.int32()))
    rows = tc.Sparse.of(lists)
    assert rows.times(rows.places.astype(float)).tolist() == [6, 0, 5, 17]
    some = rows.only(np.array([True, False, False, True]))
    assert some.n == 2 and some.times(some.places.astype(float)).tolist() == [6, 17]
    assert tc.Sparse.of(lists[2:]).times(np.ones(4)).tolist() == [1, 3]


def test_packed_model():
    words = np.zeros(1 << tc.HASH_BITS)
    words[[3, 77]] = 1.5, -2.0
    again = tc.Linear.unpacked(tc.Linear(-1.0, np.array([0.5]), words).packed())
    assert again.intercept == -1 and again.earlier.tolist() == [0.5] and (again.words == words).all()


def test_contradicting_labels_and_repeated_ids(spark):
    docs = spark.createDataFrame([(1, "b", 0), (1, "a", 0), (2, None, 0), (None, "x", 0)], DOCS)
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (1, 0, 0), (1, None, 1), (2, 1, 0), (None, 1, 1)], LABELS)
    got = {r.id: (r.text, r.toxic, r.low_quality) for r in tc.labelled_sample(docs, labels).collect()}
    assert got == {1: ("a", 1, 1), 2: (None, 0, 0)}
