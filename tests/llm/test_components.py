"""Connected components against union-find."""

import random

import pytest

from clickloom.llm.components import connected_components


def brute_force(pairs):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {x: root(x) for x in parent}


def random_pairs(n, nodes, seed):
    draw = random.Random(seed)
    return [(draw.randrange(-nodes, nodes), draw.randrange(-nodes, nodes)) for _ in range(n)]


CASES = {
    "chain": [(i, i + 1) for i in range(200)],
    "shuffled chain": random.Random(1).sample([(i + 1, i) for i in range(200)], 200),
    "star": [(500, i) for i in range(400)],
    "sparse": random_pairs(150, 120, 2),
    "dense": random_pairs(400, 60, 3),
    "odd": [(1, 1), (None, 2), (3, None), (None, None), (4, 5), (5, 4), (4, 5)],
    "empty": [],
}


@pytest.mark.parametrize("name", CASES)
def test_components(spark, name):
    links = spark.createDataFrame(CASES[name], "a long, b long")
    found = connected_components(links, "a", "b").collect()
    assert len(found) == len({r.node for r in found})
    assert {r.node: r.root for r in found} == brute_force(CASES[name])
