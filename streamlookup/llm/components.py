"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlookup.sources.shared import written

# Rounds after which something must be wrong: the depth at least halves in each.
MAX_ROUNDS = 60


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node that can be reached, for every node of
    ``links`` (columns ``a``, ``b``).

    Alternates two steps until nothing changes: each node's larger neighbours are
    linked to its smallest neighbour, then its smaller ones and itself. Links are
    only ever replaced, so there are no more than at first, and a node with very
    many neighbours is worked on by aggregates that combine before the shuffle. A
    round's links are written to the shared folder; what reaches the driver is
    whether two rounds' links are the same.
    """
    links = links.where(F.col("a") != F.col("b"))
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = written(links, "links")
    before = _state(links)
    for _ in range(MAX_ROUNDS):
        links = written(_small_star(_large_star(links)), "links")
        if (now := _state(links)) == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = now
    raise RuntimeError(f"components are not found in {MAX_ROUNDS} rounds")


def _state(links: DataFrame) -> tuple:
    """Count and order-free hashes of the links."""
    first, second = (F.xxhash64(F.lit(i), "a", "b") for i in range(2))
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(first), F.bit_xor(second)).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Link the larger neighbours of each node to the smallest of it and its neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    # A shuffle of its own, so that a hub's links can be split when they are joined.
    least = least.select("a", F.least("a", "least").alias("least")).hint("rebalance")
    larger = both.where(F.col("b") > F.col("a"))
    return larger.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Link the smaller neighbours of each node, and itself, to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("least")).hint("rebalance")
    joined = links.join(least, "a")
    moved = joined.where(F.col("b") != F.col("least")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select("a", F.col("least").alias("b"))
    return moved.unionByName(own).distinct()
