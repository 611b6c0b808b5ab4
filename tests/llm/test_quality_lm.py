"""Quality by perplexity on a small corpus, and odd rows."""

import math
import random
from collections import Counter

import pytest

from clickloom.llm import char_models as cm
from clickloom.llm import quality_lm

DOCS = "doc_id long, text string, lang string, cls string, perplexity int, threshold int"
WORDS = "the a house river runs slow under old bridge and small birds sing over green hills".split()


def prose(seed, n=60):
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    return [(i, prose(i), "en", "x", 1, 1) for i in range(80)]


def test_odd_rows(spark, corpus):
    odd = [
        (100, None, "en", "x", 1, 1),
        (101, " \n ", "en", "x", 1, 1),
        (102, "#$%& 9876 {}[] <<>> ~~ ^^ == @@" * 20, "en", "x", 1, 1),
        (103, prose(103, 40_000), "en", "x", 1, 1),
        (104, prose(104), None, None, None, None),
        (105, prose(105), "fr", "x", 1, 1),
        (106, prose(106), "en", "x", 1, 1),
        (106, prose(106), "en", "x", 1, 1),
        (None, prose(107), "en", "x", 1, 1),
    ]
    docs = spark.createDataFrame(corpus + odd, DOCS)
    trusted = spark.createDataFrame([(i,) for i in range(60)] + [(3,), (None,), (999,)], "doc_id long")
    rows = quality_lm.judge_quality(docs, trusted).collect()
    assert len(rows) == len(corpus) + len(odd)
    found = {}
    for r in rows:
        found.setdefault(r.doc_id, []).append(r)
    for doc_id in (100, 101):
        assert found[doc_id][0].perplexity is None and not found[doc_id][0].keep
    assert not found[102][0].keep
    assert all(found[d][0].keep for d in (103, 104, 105, 106, None))
    assert len(found[106]) == 2 and found[106][0] == found[106][1]
    assert sum(found[i][0].keep for i in range(80)) >= 78


def test_nothing_trusted_or_to_judge(spark, corpus):
    docs = spark.createDataFrame(corpus[:3], DOCS)
    nobody = spark.createDataFrame([], "doc_id long")
    rows = quality_lm.judge_quality(docs, nobody).collect()
    assert len(rows) == 3 and not any(r.keep for r in rows)
    everyone = docs.select("doc_id")
    assert quality_lm.judge_quality(docs.limit(0), everyone).collect() == []


def plain_model(texts):
    """Modified Kneser-Ney by the definition: three discounts per order from counts of counts."""
    table, counts = cm.all_symbols(), {4: Counter()}
    for text in texts:
        whole = [cm.START] * 3 + cm.symbols(text, table).tolist()
        counts[4].update(tuple(whole[i - 3 : i + 1]) for i in range(3, len(whole)))
    for n in (3, 2, 1):
        counts[n] = Counter(gram[1:] for gram in counts[n + 1])
    cuts = {}
    for n, found in counts.items():
        n1, n2, n3, n4 = (sum(v == k for v in found.values()) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        three = [y] * 3
        if min(n1, n2, n3) > 0:
            three = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
        cuts[n] = [min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), three)]
    after = {}
    for n, found in counts.items():
        for gram, v in found.items():
            after.setdefault(gram[:-1], []).append(min(cuts[n][min(v, 3) - 1], v))

    def probability(gram):
        if not gram:
            return 1 / (len(counts[1]) + 1)
        found, lower = counts[len(gram)], probability(gram[1:])
        if gram[:-1] not in after or not any(g[:-1] == gram[:-1] for g in found):
            return lower
        total = sum(v for g, v in found.items() if g[:-1] == gram[:-1])
        v = found.get(gram, 0)
        own = (v - min(cuts[len(gram)][min(v, 3) - 1], v)) / total if v else 0.0
        return own + sum(after[gram[:-1]]) / total * lower

    known = {}

    def perplexity(text):
        whole = [cm.START] * 3 + cm.symbols(text, table).tolist()
        total = 0.0
        for i in range(3, len(whole)):
            gram = tuple(whole[i - 3 : i + 1])
            if gram not in known:
                known[gram] = -math.log(probability(gram))
            total += known[gram]
        return math.exp(total / (len(whole) - 3))

    return perplexity


def test_against_a_plain_model(spark):
    """Perplexities, and the threshold as a quantile over the texts left out."""
    rows = [(i, prose(i, 12) + (" Ünlike 42!" if i % 7 == 0 else ""), "en") for i in range(24)]
    rows += [(i, rows[3][1], "en") for i in (24, 25)] + [(30, "quite §§ different", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trusted = spark.createDataFrame([(i,) for i in range(26)], "doc_id long")
    got = {r.doc_id: r for r in quality_lm.judge_quality(docs, trusted).collect()}
    texts = [t for i, t, _ in rows if i < 26]
    whole = plain_model(texts)
    for doc_id, text, _ in rows:
        assert got[doc_id].perplexity == pytest.approx(whole(text), rel=1e-3)
    keys = [cm.text_key(cm.symbols(t, cm.all_symbols())) for t in texts]
    folds = [cm.fold_of(k, quality_lm.FOLDS) for k in keys]
    models = [plain_model([t for t, f in zip(texts, folds) if f != fold]) for fold in range(quality_lm.FOLDS)]
    votes = {k: models[f](t) for k, t, f in zip(keys, texts, folds)}
    ranked = sorted(votes.values())
    limit = ranked[math.ceil(quality_lm.QUANTILE * len(ranked)) - 1]
    assert len(votes) == 24
    (threshold,) = {r.threshold for r in got.values()}
    assert threshold == pytest.approx(limit, rel=1e-3)


def test_only_trusted_rows_train(spark):
    """The filter lets no trusted row go and the join no other one through."""
    rows = [(i, f"text {i}", "en") for i in [*range(300), 5, 5, None]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trusted = spark.createDataFrame([(i,) for i in range(0, 400, 3)] + [(None,), (3,)], "doc_id long")
    got = sorted(r.text for r in quality_lm.trusted_rows(docs, trusted).collect())
    assert got == sorted(f"text {i}" for i in range(0, 300, 3))
    assert quality_lm.trusted_rows(docs, trusted.limit(0)).collect() == []


def test_untrusted_rows_are_left_out_below_the_shuffle(spark):
    docs = [(i, prose(i), "en", "x", 1, 1) for i in (1, 2, 2, 3)] + [(None, "a", "en", "x", 1, 1)]
    trusted = spark.createDataFrame([(2,), (2,), (3,), (None,), (9,)], "doc_id long")
    found = quality_lm.trusted_rows(spark.createDataFrame(docs, DOCS), trusted)
    assert sorted(r.text for r in found.collect()) == sorted(prose(i) for i in (2, 2, 3))
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("SortMergeJoin") < plan.index("BroadcastHashJoin")
