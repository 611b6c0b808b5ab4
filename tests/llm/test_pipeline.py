"""The pipeline stage by stage against plain computations, and odd rows."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tokenizers
import xxhash

import corpus_pipeline
from clickloom.llm import decontaminate, id_filter, language_id
from clickloom.llm.queries import VOCABULARY
from clickloom.session import written

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """The rows before and after each stage."""
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF)))
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_columns_and_rows(spark, steps):
    docs = steps[0]
    for before, after in zip(steps, steps[1:-1]):
        assert after.columns == docs.columns
        assert 0 < after.count() <= before.count()
    final = sorted(map(tuple, steps[-1].collect()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == final
    assert ids(steps[-1]) == ids(steps[4])


def test_languages(spark, steps):
    model = language_id.learn_from_documents(steps[0])
    found = language_id.identify(steps[0], model).collect()
    assert ids(steps[1]) == {r.doc_id for r in found if not r.rejected}


def simhash(text):
    words = text.lower().split() if text else []
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    found = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in found) > len(found))


def test_near_duplicates(steps):
    rows = [(r.doc_id, simhash(r.text)) for r in steps[1].collect()]
    root = {d: d for d, _ in rows}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(rows):
        for b, y in rows[:i]:
            if (x ^ y).bit_count() <= 3:
                low, high = sorted((top(a), top(b)))
                root[high] = low
    assert ids(steps[2]) == {d for d in root if top(d) == d}


def test_benchmark(spark, steps):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    found = ids(decontaminate.contaminated(steps[2], benchmark))
    assert ids(steps[3]) == ids(steps[2]) - found


def test_pseudonyms_keep_everything_but_digits_and_mail(steps):
    before = {r.doc_id: r for r in steps[3].collect()}
    after = {r.doc_id: r for r in steps[4].collect()}
    assert before.keys() == after.keys()
    for doc_id, row in after.items():
        old = before[doc_id]
        assert (row.lang, row.source) == (old.lang, old.source)
        assert row.n_chars == (None if row.text is None else len(row.text))


def test_tokens(steps):
    library = tokenizers.Tokenizer.from_file(str(public_tokenizers.path(VOCABULARY)))
    library.no_truncation()
    library.no_padding()
    found = {r.doc_id: r for r in steps[5].collect()}
    for row in steps[4].collect():
        encoded = library.encode(row.text or "", add_special_tokens=False).ids
        text = library.decode(encoded, skip_special_tokens=False)
        got = found[row.doc_id]
        assert got.n_tokens == len(encoded)
        assert got.ids_sha256 == hashlib.sha256(np.array(encoded, "<u4").tobytes()).hexdigest()
        assert got.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_odd_documents(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, copy int, leaked int, kept_id int"
    text = "the river runs slow under the old bridge and small birds sing over green hills "
    docs = [(i, f"{text}{i} {text}", "en", "s", 1, 1, 1) for i in range(30)]
    docs += [(40, None, None, None, None, None, None), (41, "", "en", "s", 1, 1, 1)]
    docs += [(None, f"{text}7 {text}", "en", "s", 1, 1, 1), (3, f"{text}3 {text}", "en", "s", 1, 1, 1)]
    spark.createDataFrame(docs, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    found = [r.doc_id for r in rows]
    assert 40 not in found and 41 not in found
    assert None in found and len(found) == len(set(found)) and 0 in found


def test_empty_documents(spark, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_rows_of_one_id_are_judged_by_their_own_text(spark):
    def text(seed):
        return " ".join(f"w{seed}x{i}" for i in range(60))

    rows = [(1, text(1)), (2, text(1)), (2, text(2)), (3, text(3)), (3, text(4)), (3, text(4)), (4, text(4)), (5, None)]
    docs = written(spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, row int"))
    kept = sorted((r.doc_id, r.text or "") for r in corpus_pipeline.one_of_each_group(spark, docs, SF).collect())
    assert kept == [(1, text(1)), (2, text(2)), (3, text(3)), (3, text(4)), (5, "")]
    unique = written(docs.filter("row in (0, 3, 6, 7)"))
    assert {r.row for r in corpus_pipeline.one_of_each_group(spark, unique, SF).collect()} == {0, 3, 6, 7}


def test_filter_leaves_out_the_ids_and_nothing_else(spark):
    rows = spark.range(20_000).selectExpr("if(id % 100 = 99, null, id) AS id", "id AS n")
    ids = spark.range(0, 30_000, 3).selectExpr("if(id = 0, null, id) AS other")
    kept = sorted(r.n for r in id_filter.without_ids(rows, "id", ids, "other").collect())
    assert kept == [n for n in range(20_000) if n % 100 == 99 or n % 3 or n == 0]
    assert id_filter.without_ids(rows, "id", ids.limit(0), "other").count() == 20_000
