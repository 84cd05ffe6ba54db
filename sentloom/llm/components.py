"""Connected components of a graph that is only ever a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentloom.llm.common import Scratch

# Rounds after which something must be wrong: each one about halves the depth.
MAX_ROUNDS = 100


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to its smallest neighbour (or itself)."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.where("b > a").join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours, and itself, to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``label``: the smallest node reachable from each node of ``edges`` (columns a, b).

    Alternates large-star and small-star steps, O(log^2 n) rounds in theory and a few
    in practice. A round only moves edges: minima are combined before the shuffle
    and nothing is gathered per node, so a node with very many neighbours is a skewed
    join at worst. Every round is written out, so a lost executor costs one round at
    most. Loops are dropped: a node that only has an edge to itself is not returned.
    """
    scratch = Scratch(edges.sparkSession)
    now = scratch.write(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    state = _state(now)
    for _ in range(MAX_ROUNDS):
        after = scratch.write(_small_star(_large_star(now)), "edges")
        scratch.drop(now)
        now, before, state = after, state, _state(after)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        now.select("b", F.col("b").alias("label")).distinct()
    )
