"""Byte-pair encoding against the tokenizers library."""

import hashlib
import random
import struct
import unicodedata

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clickloom.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
DOCS = "/root/testdata/sf0.001/documents.parquet"


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def codec():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Codec(bpe.Vocabulary(file.read()))


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    packed = struct.pack(f"<{len(ids)}I", *ids)
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_documents_match_the_library(spark, library):
    docs = spark.read.parquet(DOCS)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = bpe.token_digests(docs, PATH).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected(library, texts[r.doc_id])


ODD = [
    "", " ", "\n\t", "It's we'LL don't I'M", "a<|endoftext|>b <|startoftext|>", "<|ENDOFTEXT|>",
    "<|endoftext|><|endoftext|>", "1234 ٣٤ Ⅷ ½", "ΟΔΟΣ Σ ΣΑΣ", "İstanbul ẞ ǅ", "été",
    "a b c d\u0085e\u001cf​g", "日本語テキスト 漢字", "👩‍👩‍👧 🇩🇪!!", "\u0000\u0001x",
    "ab" * 5000, "q" * 3000, "the" * 4000, "!?" * 700, "áßçé" * 800,
]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts_match_the_library(library, codec, text):
    assert codec.encode(text) == library.encode(text, add_special_tokens=False).ids
    assert codec.digest(text) == expected(library, text)


def test_random_words_match_the_library(library, codec):
    rnd = random.Random(3)
    tokens = [t.removesuffix("</w>") for t in codec.vocabulary.ids if t.isascii() and t.replace("</w>", "").isalpha()]
    for _ in range(300):
        word = "".join(rnd.choice(tokens) for _ in range(rnd.randrange(1, 40)))
        assert codec.encode(word) == library.encode(word, add_special_tokens=False).ids
    for _ in range(300):
        # Code points of the same class in every Unicode version since 15.
        drawn = (chr(rnd.choice([rnd.randrange(32, 0x250), rnd.randrange(0x370, 0x3000)])) for _ in range(30))
        word = "".join(c for c in drawn if unicodedata.category(c) != "Cn")
        assert codec.encode(word) == library.encode(word, add_special_tokens=False).ids, word


def test_memory_stays_within_the_lookahead(codec):
    rnd = random.Random(4)
    transducer = bpe.Transducer(codec.vocabulary)
    v = codec.vocabulary
    for alphabet in ("ab", "etaoin", "the", "q", "lmno"):
        for _ in transducer.encode(rnd.choice(alphabet).encode() for _ in range(9000)):
            pass
    assert 0 < transducer.most_held <= 3 * v.lookahead + v.longest


def test_decoding_gives_the_words_back(spark):
    texts = [(1, "Éte naïve  日本 x."), (2, None), (3, "a<|endoftext|>b"), (1, "Éte naïve  日本 x.")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "1 AS ids")
    back = bpe.decode(bpe.encode(docs, PATH), PATH)
    got = sorted((r.doc_id, r.text) for r in back.collect())
    assert got == [(1, "éte naïve 日本 x ."), (1, "éte naïve 日本 x ."), (2, ""), (3, "a <|endoftext|>b")]
    assert bpe.token_digests(docs.limit(0), PATH).collect() == []
