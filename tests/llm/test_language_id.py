"""Character models against a plain computation, and language identification of odd rows."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import char_models as cm
from clickloom.llm import language_id

ROWS = [
    ("aa", "abab abc cab"),
    ("aa", "bac abba"),
    ("aa", "Abab ABC"),
    ("bb", "xyz xx zyx"),
    ("bb", "zab xyzzy"),
    ("bb", None),
    (None, "nothing counts"),
]
DOCS = "doc_id long, text string, lang string, kept_id int, id int, cls string, score int"


def brute_force(texts):
    """Probability of a gram by the definition, over dictionaries of counts."""
    table, counts = cm.letters_only(), {4: Counter()}
    for text in texts:
        whole = [cm.START] * 3 + cm.symbols(text, table).tolist()
        counts[4].update(tuple(whole[i - 3 : i + 1]) for i in range(3, len(whole)))
    for n in (3, 2, 1):
        counts[n] = Counter(gram[1:] for gram in counts[n + 1])
    base = {}
    for n, found in counts.items():
        once, twice = (sum(v == k for v in found.values()) for k in (1, 2))
        base[n] = once / (once + 2 * twice) if once else 0.5

    def probability(gram):
        n = len(gram)
        if not n:
            return 1 / (len(counts[1]) + 1)
        lower = probability(gram[1:])
        same = {g: v for g, v in counts[n].items() if g[:-1] == gram[:-1]}
        if not same:
            return lower

        def cut(v):
            return min(max(base[n], 0.05), min(v, 3) - 0.05)

        total, v = sum(same.values()), same.get(gram, 0)
        own = (v - cut(v)) / total if v else 0.0
        return own + sum(map(cut, same.values())) / total * lower

    return probability


@pytest.fixture(scope="module")
def model(spark):
    return cm.train(spark.createDataFrame(ROWS, "cls string, text string"), cm.letters_only)


@pytest.mark.parametrize("text", ["abab", "cab xyz", "q", "zzyx bac abq"])
def test_probabilities_by_definition(model, text):
    assert model.classes == ["aa", "bb"]
    symbols = cm.symbols(text, cm.letters_only())
    packed, lengths = cm.grams([symbols])
    assert lengths.tolist() == [len(symbols)]
    found = cm.log_probabilities(model, packed)
    whole = [cm.START] * 3 + symbols.tolist()
    for column, cls in enumerate(model.classes):
        probability = brute_force([t for c, t in ROWS if c == cls and t is not None])
        for i in range(len(symbols)):
            expected = math.log(probability(tuple(whole[i : i + 4])))
            assert found[i, column] == pytest.approx(expected, abs=1e-4)


def test_unseen_grams_do_not_take_the_place_of_others(spark):
    """The second text's letter pairs lie 4,194,301 above those of the first."""
    text, other = "бгд бгб вбг", "ѱа ѱа"
    model = cm.train(spark.createDataFrame([("aa", text)], "cls string, text string"), cm.letters_only)
    probability = brute_force([text])
    for wanted in (text, other):
        symbols = cm.symbols(wanted, cm.letters_only())
        found = cm.log_probabilities(model, cm.grams([symbols])[0])[:, 0]
        whole = [cm.START] * 3 + symbols.tolist()
        expected = [math.log(probability(tuple(whole[i : i + 4]))) for i in range(len(symbols))]
        assert found == pytest.approx(expected, abs=1e-4)


def test_probabilities_add_up_to_less_than_one(model):
    """Over all known symbols; the rest is for unknown ones."""
    known = sorted({s for c, t in ROWS if c == "aa" for s in cm.symbols(t, cm.letters_only()).tolist()})
    for context in ([1, 1, 1], cm.symbols("aba", cm.letters_only()).tolist()):
        grams = [sum(int(s) << 16 * (3 - i) for i, s in enumerate([*context, k])) for k in known]
        total = np.exp(cm.log_probabilities(model, np.array(grams, np.uint64))[:, 0]).sum()
        assert 0.5 < total < 1


def test_costs_do_not_depend_on_the_batch(model):
    texts = [cm.symbols(t, cm.letters_only()) for t in ("abab", "", "xyz " * 200, "q")]
    together = cm.text_costs(model, texts)
    alone = np.concatenate([cm.text_costs(model, [t]) for t in texts])
    assert np.allclose(together, alone, rtol=1e-5)


def corpus():
    words = {"aa": "la casa del sol y la luna ", "bb": "der hund und das haus im wald "}
    return [(i, words[k] * (1 + i % 3), k, 1, 2, "c", 3) for i in range(60) for k in [("aa", "bb")[i % 2]]]


def test_odd_rows(spark):
    odd = [
        (100, None, "aa", 1, 2, "c", 3),
        (101, "", "aa", 1, 2, "c", 3),
        (102, "12 !! 34", "aa", 1, 2, "c", 3),
        (103, "la casa del sol y la luna " * 20_000, None, 1, 2, "c", 3),
        (104, "zqxjk vvwq xkcd qqzz jjxx " * 20, None, 1, 2, "c", 3),
        (105, "Der Hund und das Haus", "aa", 1, 2, "c", 3),
        (105, "Der Hund und das Haus", "aa", 1, 2, "c", 3),
        (None, "der hund und das haus", "bb", None, None, None, None),
    ]
    docs = spark.createDataFrame(corpus() + odd, DOCS)
    model = language_id.train_languages(
        spark.createDataFrame(corpus(), DOCS), F.col("lang"), F.col("text")
    )
    rows = language_id.identify(docs, model).collect()
    assert len(rows) == 68 and all(0 <= r.score <= 1 for r in rows)
    found = {}
    for r in rows:
        found.setdefault(r.doc_id, []).append((r.lang_pred, r.rejected))
    assert found[100] == found[101] == found[102] == [("und", True)]
    assert found[103] == [("aa", False)] and found[104][0][1]
    assert found[105] == [("bb", False)] * 2 and found[None] == [("bb", False)]


def test_rejected_documents_go_and_columns_stay(spark):
    odd = [
        (100, None, "aa", 1, 2, "c", 3),
        (101, "der hund und das haus", "bb", 7, 8, "d", 9),
        (101, "!!!", "bb", 7, 8, "d", 9),
        (None, "der hund und das haus im wald", "bb", None, None, None, None),
    ]
    docs = spark.createDataFrame(corpus() + odd, DOCS)
    kept = language_id.keep_identified(docs)
    assert kept.columns == docs.columns
    rows = sorted(map(tuple, kept.collect()), key=str)
    assert rows == sorted([*corpus(), odd[1], odd[3]], key=str)


def test_nothing_to_learn_or_to_judge(spark):
    docs = spark.createDataFrame([(1, "la casa", None, 1, 2, "c", 3)], DOCS)
    empty = language_id.learn_from_documents(docs)
    (row,) = language_id.identify(docs, empty).collect()
    assert (row.lang_pred, row.score, row.rejected) == ("und", 0.0, True)
    assert language_id.keep_identified(docs).collect() == []
    assert language_id.identify(docs.limit(0), empty).collect() == []


WORDS = {
    "fr": "le la maison rivière coule sous vieux pont petits oiseaux chantent dans les collines vertes matin soleil "
    "enfants jouent près du jardin chaque jour avec leurs amis pendant que nous mangeons du pain".split(),
    "en": "the house river runs slow under old bridge small birds sing over green hills morning sun children "
    "play near garden every day with their friends while we eat bread and talk about work".split(),
}


def prose(lang, seed, n=120):
    draw = random.Random(f"{lang}{seed}")
    return " ".join(draw.choice(WORDS[lang]) for _ in range(n))


@pytest.mark.parametrize("near", [False, True])
def test_copies_do_not_drop_clean_documents(spark, near):
    """Nearly all French text is one short text over and over, or near copies of it."""
    same = " ".join(WORDS["fr"][:6] * 20)
    copies = [same + (f" {prose('fr', i, 3)}" if near else "") for i in range(1500)]
    rows = [(i, prose(k, i), k) for i in range(40) for k in ("fr", "en")]
    rows += [(1000 + i, text, "fr") for i, text in enumerate(copies)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train_languages(train, F.col("lang"), F.col("text"))
    clean = [(i, prose(k, i)) for i in range(5000, 5040) for k in ("fr", "en")]
    junk = [(9000 + i, "zqxjk vvwq xkcd qqzz jjxx wvkq " * 20) for i in range(3)]
    docs = spark.createDataFrame(clean + junk, "doc_id long, text string")
    found = language_id.identify(docs, model).collect()
    assert {r.doc_id for r in found if r.rejected} == {9000, 9001, 9002}


def test_repeated_sentence_does_not_reject_new_words(spark):
    """One sentence is all there is to learn from: nothing can be left out of the counts."""
    text = "the river runs slow under the old bridge and small birds sing over green hills "
    train = spark.createDataFrame([(text * 2, "en")] * 30, "text string, lang string")
    model = language_id.train_languages(train, F.col("lang"), F.col("text"))
    docs = spark.createDataFrame(
        [(1, "the children sing under the green bridge and birds rest"), (2, "zqxjk vvwq xkcd qqzz jjxx " * 20)],
        "doc_id long, text string",
    )
    assert {r.doc_id: r.rejected for r in language_id.identify(docs, model).collect()} == {1: False, 2: True}
