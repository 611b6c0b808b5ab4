import random

import pytest
from pyspark.sql import functions as F

from clickloom.operators import groups, postings
from clickloom.operators.inverted_index import verse_index, verse_lines


def verse_rows(seed):
    """Lines in no order, some references repeated, chapters and verses of every kind."""
    draw = random.Random(seed)
    kinds = ["1", "2", "10", "007", "-3", "-20", "3000000000", "12b", "", "z"]
    lines = []
    for n in range(400):
        reference = ":".join([draw.choice(["Gen", "Ge", "Gen\0x", "É"]), draw.choice(kinds), str(n % 150)])
        words = " ".join(draw.sample(["hot", "warm", "cold", f"k{n}", f"k{n % 40}"], 3) + ["hot"])
        lines.append(f"{reference} {words}")
    return [*lines, *lines[:30], "", "Gen", "Gen hot", "Gen:1 hot", "Gen:1:1:9 hot", None]


def brute_force(lines, size):
    """Segments by plain sorting of book, chapter and verse; missing before labels before numbers."""

    def part(value):
        if value is None:
            return (0, "", 0)
        try:
            return (2, "", int(value))
        except ValueError:
            return (1, value, 0)

    lists = {}
    for line in filter(None, lines):
        head, _, rest = line.partition(" ")
        book, *more = head.split(":")
        chapter, verse = map(part, [*more, None, None][:2])
        shown = [book] + [str(p[2]) if p[0] == 2 else p[1] for p in (chapter, verse) if p[0]]
        for word in set(rest.split()):
            word = word.strip("0123456789")
            lists.setdefault(word, set()).add((book.encode(), chapter, verse, ":".join(shown)))
    found = {}
    for word, places in lists.items():
        texts = [p[-1] for p in sorted(places)]
        for at in range(0, len(texts), size):
            found[word, at // size] = (len(texts), ", ".join(texts[at : at + size]))
    return found


@pytest.mark.parametrize("size, held", [(100_000, 2_000_000), (7, 2_000_000), (7, 40), (1, 200), (30, 1)])
def test_segments_match_brute_force(spark, monkeypatch, size, held):
    monkeypatch.setattr(groups, "PIECE_SEGMENTS", 2)
    monkeypatch.setattr(postings, "HELD_POSTINGS", held)
    lines = verse_rows(size)
    df = spark.createDataFrame([(t,) for t in lines], "value string").repartition(5)
    rows = verse_index(df, F.col("value"), segment_size=size).collect()
    got = {(r["word"], r["segment"]): (r["postings"], r["verses"]) for r in rows}
    assert len(got) == len(rows)
    assert got == brute_force(lines, size)


@pytest.mark.parametrize("sampled", [[], ["Gen:1:1 hot"] * 9, [f"Gen:{n}:1 hot warm" for n in range(50)]])
def test_the_sample_decides_nothing_but_the_layout(spark, sampled):
    lines = verse_rows(5)
    df = spark.createDataFrame([(t,) for t in lines], "value string")
    sample = spark.createDataFrame([(t,) for t in sampled], "value string")
    rows = postings.posting_lists(
        verse_lines(df, F.col("value")), segment_size=20, sample=verse_lines(sample, F.col("value"))
    ).collect()
    got = {(r["word"], r["segment"]): (r["group_size"], len(r["items"])) for r in rows}
    expected = brute_force(lines, 20)
    assert got == {k: (n, verses.count(", ") + 1) for k, (n, verses) in expected.items()}
    for word in {w for w, _ in got}:
        places = [p for r in sorted(rows, key=lambda r: r["segment"]) if r["word"] == word for p in r["items"]]
        assert places == sorted(set(places))


def test_blocks_are_shuffled_and_crowded_words_are_cut(spark, monkeypatch):
    """A task passes on one row per word and slice, and no piece of a crowded word is large."""
    plans, tables, write = [], [], groups.written

    def keep(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        tables.append(write(df))
        return tables[-1]

    monkeypatch.setattr(groups, "written", keep)
    monkeypatch.setattr(groups, "PIECE_SEGMENTS", 1)
    texts = [f"Gen:{n // 50}:{n % 50} hot {'rare' if n % 500 == 0 else ''}" for n in range(4_000)]
    df = spark.createDataFrame([(t,) for t in texts], "value string").repartition(3)
    rows = verse_index(df, F.col("value"), segment_size=100).collect()
    assert sorted(r["segment"] for r in rows if r["word"] == "hot") == list(range(40))
    layout = next(t for t in tables if "slice" in t.columns)
    sizes = [r["n"] for r in layout.filter("word = 'hot'").collect()]
    assert sum(sizes) == 4_000 and len(sizes) > 20 and max(sizes) < 600
    plan = next(p for p in plans if "collect_list" in p)
    assert "Generate" not in plan and plan.index("Exchange hashpartitioning") < plan.index("MapInArrow")
    layout = postings._layout(verse_lines(df.sample(groups.probe_share(100)), F.col("value")), 100)
    assert postings._blocks(verse_lines(df, F.col("value")), layout).count() <= 3 * (len(sizes) * 2 + 1)
