"""URL verdicts against plain Python and a brute-force rule miner."""

from collections import Counter
from itertools import combinations, product

import pytest
from pyspark.sql import functions as F

from clickloom.llm import url_rules as ur

SF = "/root/testdata/sf0.01"


def plain(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [r for r in ur.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.verdict


ODD = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/1", "http://example.org/en/1?x#y", "http://a.com",
    "http://a.com/fr/", "https://com/de/x", "http://notexample.org/es/", "http://x.org?q=/es/", "ftp://ÄB.org/",
    "a://b://c.org/x", "http://x.example.org/en/12/3#/", "http://e.com/fr", "http://org/", "http://u@h.org:80/es/",
    "http://x.org/" + "a/" * 20_000, "http://x.com\n/de/",
]


def test_parts_and_given_rules(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(ODD)] + [(4, ODD[4], "x")], "page_id long, url string, host string")
    labels = spark.createDataFrame([], "page_id long, blocked boolean")
    rows = ur.judge_urls(pages, labels).collect()
    assert len(rows) == len(ODD) + 1
    for r in rows:
        host, path, rule, verdict = plain(ODD[r.page_id])
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow")
    assert ur.judge_urls(pages.limit(0), labels).collect() == []


def test_mined_rules_against_brute_force(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select(
        F.col("doc_id").alias("page_id"), (F.col("quality") == 0).alias("blocked")
    )
    url = F.col("url")
    data = pages.join(labels, "page_id").select(
        "url", "blocked", ur.host_of(url).alias("host"), ur.path_of(url).alias("path")
    ).select("url", ur.tokens_of(url, "host", "path").alias("tokens"), "blocked")
    rules, groups = ur.mine(data, 0.05, 0.6)
    members = {}
    for r in groups.collect():
        members.setdefault(r.item, []).append(r.token)
    # A rule stands for all that hold one or more tokens of each of its items.
    got = {}
    for r in rules.collect():
        choices = [
            [c for n in range(1, len(members[t]) + 1) for c in combinations(members[t], n)] for t in r.tokens
        ]
        for parts in product(*choices):
            got[tuple(sorted(sum(parts, ()))), r.mined_verdict] = (r.confidence, r.support)
    assert any(len(m) > 1 for m in members.values())
    rows = data.collect()
    total, blocked = Counter(), Counter()
    for r in rows:
        for n in range(1, len(r.tokens) + 1):
            for c in combinations(sorted(r.tokens), n):
                total[c] += 1
                blocked[c] += r.blocked
    expected = {}
    for c, n in total.items():
        for verdict, k in (("block", blocked[c]), ("allow", n - blocked[c])):
            if k >= 0.05 * len(rows) and k / n >= 0.6:
                expected[c, verdict] = (k / n, k / len(rows))
    assert got.keys() == expected.keys() and expected
    assert all(got[k] == pytest.approx(expected[k]) for k in got)
    verdicts = {r.url: r.confidence for r in ur.mined_verdicts(data.select("url", "tokens").distinct(), rules, groups).collect()}
    for r in rows:
        fits = [v[0] for (tokens, _), v in expected.items() if set(tokens) <= set(r.tokens)]
        assert verdicts.get(r.url) == (pytest.approx(max(fits)) if fits else None)


def test_a_mined_rule_blocks(spark):
    rows = [(i, f"http://bad.net/x{i}" if i % 2 else f"http://good.net/y{i}") for i in range(40)]
    pages = spark.createDataFrame([*rows, (99, "http://bad.net/new")], "page_id long, url string")
    labels = spark.createDataFrame([(i, bool(i % 2)) for i in range(40)], "page_id long, blocked boolean")
    got = {r.page_id: r.verdict for r in ur.judge_urls(pages, labels, min_support=0.1).collect()}
    assert got[99] == "block" and got[1] == "block" and got[2] == "allow"


def test_a_url_of_very_many_tokens(spark):
    """One url of forty tokens on a third of the rows is one item, not 2 ** 40 sets."""
    wide = "http://wide.net/" + "/".join(f"piece{n}" for n in range(40))
    rows = [(i, wide if i % 3 == 0 else f"http://other.net/y{i % 5}") for i in range(300)]
    pages = spark.createDataFrame([*rows, (999, "http://new.net/piece7")], "page_id long, url string")
    labels = spark.createDataFrame([(i, i % 3 == 0) for i in range(300)], "page_id long, blocked boolean")
    got = {r.page_id: r.verdict for r in ur.judge_urls(pages, labels).collect()}
    assert all(got[i] == ("block" if i % 3 == 0 else "allow") for i in range(300))
    assert got[999] == "block"
