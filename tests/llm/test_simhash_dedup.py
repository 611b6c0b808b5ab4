"""SimHash near duplicates against a plain brute force."""

import random

import numpy as np
import pytest
import xxhash

from clickloom.llm import simhash_dedup as sd
from clickloom.llm.components import connected_components


def plain_fingerprint(text):
    data = (text or "").encode()
    words, word = [], b""
    for byte in data + b" ":
        if byte == 0x20 or 0x09 <= byte <= 0x0D:
            if word:
                words.append(word)
            word = b""
        else:
            word += bytes([byte + 32 if 65 <= byte <= 90 else byte])
    if not words:
        return 0
    runs = [words[i : i + 3] for i in range(len(words) - 2)] or [words]
    hashes = [xxhash.xxh64_intdigest(b" ".join(r), 42) for r in runs]
    return sum(
        1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)
    )


def plain_components(prints):
    """Smallest id per row, by comparing everything with everything."""
    ids = sorted(prints)
    least = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i in ids:
            for j in ids:
                if (prints[i] ^ prints[j]).bit_count() <= 3 and least[i] < least[j]:
                    least[j], changed = least[i], True
    return least


def result(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int")
    return sd.near_duplicates(docs).collect()


def test_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    least = plain_components(prints)
    rows = sd.near_duplicates(docs).select(
        "doc_id", sd.fingerprint_text().alias("fp"), "component_id"
    ).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.fp == f"{prints[r.doc_id]:016x}"
        assert r.component_id == least[r.doc_id]


def test_odd_rows(spark):
    long_text = " ".join(f"w{i}" for i in range(70_000))
    rows = [
        (5, None, "x", 1), (3, "", "x", 1), (4, " \t\n", "x", 1), (9, "One two", "x", 1),
        (9, "one TWO", "x", 1), (None, "one two", "x", 1), (7, long_text, "x", 1),
    ]
    got = sorted(
        ((r.doc_id, r.component_id) for r in result(spark, rows)), key=lambda r: (r[0] is None, r)
    )
    assert got == [(3, 3), (4, 3), (5, 3), (7, 7), (9, 9), (9, 9), (None, 9)]
    assert result(spark, []) == []


def linked(fps):
    """Roots of the links found in this process, where settings can be changed."""
    block, key, fp = sd.variants(np.array(fps, np.uint64))
    order = np.lexsort((fp, block, key))
    forest = sd.Forest()
    forest.joining(sd._sorted_links(block[order], key[order], fp[order]).tolist())
    return {f: forest.root(f) for f in fps}


@pytest.mark.parametrize("direct", [1, 64])
def test_every_pair_within_the_radius_meets(monkeypatch, direct):
    monkeypatch.setattr(sd, "DIRECT_ROWS", direct)
    rnd = random.Random(1)
    fps = set()
    for _ in range(60):
        base = rnd.getrandbits(64)
        fps |= {base, base ^ (1 << rnd.randrange(64))}
        for places in (range(64), range(22), range(30, 43), range(43, 64)):
            flips = rnd.sample(places, 3)
            fps.add(base ^ sum(1 << b for b in flips))
    # A crowd in which every pair of neighbours is three bits apart.
    crowd, at = [], rnd.getrandbits(64)
    for _ in range(200):
        crowd.append(at)
        at ^= sum(1 << b for b in rnd.sample(range(16), 3))
    fps = sorted(fps | set(crowd))
    got = linked(fps)
    groups = {}
    for f in fps:
        groups.setdefault(got[f], set()).add(f)
    # the same partition as a brute-force search gives
    left = set(fps)
    while left:
        seen = front = {left.pop()}
        while front:
            front = {g for g in left - seen for f in front if (f ^ g).bit_count() <= 3}
            seen = seen | front
        left -= seen
        assert groups[got[next(iter(seen))]] == seen


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(1, 40)]
    star = [(1000, 1001 + i) for i in range(300)] + [(5000, 5000), (None, 7)]
    links = spark.createDataFrame(path + star, "a long, b long")
    roots = {r.node: r.root for r in connected_components(links, "a", "b").collect()}
    assert roots == {i: 1 for i in range(1, 41)} | {i: 1000 for i in range(1000, 1301)}


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 300)], "a long, b long")
    roots = {r.node: r.root for r in connected_components(links, "a", "b").collect()}
    assert roots == {i: 1 for i in range(1, 301)}
