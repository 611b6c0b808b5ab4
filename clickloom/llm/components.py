"""Connected components of a link table, by alternating stars.

Every round points each node's larger neighbours, then its smaller ones, at the
smallest node it knows. All steps are joins and merged minima, so neither a
node with very many links nor a very large component lands in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.session import drop_tables, written

MAX_ROUNDS = 60


def with_minimum(edges: DataFrame, minima: DataFrame) -> DataFrame:
    """``edges`` with the ``least`` of their node ``u``.

    The minima come out of an aggregation by ``u``. Joining on an expression of
    ``u`` gives both sides an exchange of their own, which adaptive execution
    can split where a node has very many links.
    """
    other = minima.select(F.col("u").alias("node"), "least")
    return edges.join(other, F.bitwise_not("u") == F.bitwise_not("node")).drop("node")


def large_star(edges: DataFrame) -> DataFrame:
    """Connect the larger neighbours of each node to the smallest around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    minima = both.groupBy("u").agg(F.least("u", F.min("v")).alias("least"))
    larger = both.filter(F.col("v") > F.col("u"))
    return with_minimum(larger, minima).select(F.col("v").alias("u"), F.col("least").alias("v"))


def small_star(edges: DataFrame) -> DataFrame:
    """Connect each node and its smaller neighbours to the smallest of these."""
    minima = edges.groupBy("u").agg(F.min("v").alias("least"))
    smaller = with_minimum(edges, minima).filter(F.col("v") > F.col("least"))
    return minima.select("u", F.col("least").alias("v")).unionByName(
        smaller.select(F.col("v").alias("u"), F.col("least").alias("v"))
    )


def _state(edges: DataFrame) -> tuple:
    """Number of links and an order-free sum over them, to see a round change nothing."""
    digest = F.xxhash64("u", "v").cast("decimal(20,0)")
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(digest).alias("digest")).first()
    return row["n"], row["digest"]


def connected_components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node, root`` for every linked node; the root is its smallest node.

    Links may repeat, run either way or join a node to itself; a NULL end makes
    no link. Nodes without links to others do not appear. An empty link table
    gives an empty result.
    """
    a, b = F.col(left), F.col(right)
    edges = links.filter(a.isNotNull() & b.isNotNull() & (a != b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    edges = written(edges.distinct())
    state = _state(edges)
    for _ in range(MAX_ROUNDS):
        if state[0] == 0:
            break
        turned = written(small_star(large_star(edges).distinct()).distinct())
        before, state = state, _state(turned)
        drop_tables(edges.sparkSession, edges)
        edges = turned
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
