"""Connected components by rounds of star joins, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cinderlog.session import freeze

MAX_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _least(pairs: DataFrame) -> DataFrame:
    """For each u its least neighbour, or u itself if that is less; a hot u is pre-aggregated."""
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """For each node that is linked to a smaller one: (node, label), label the least node it can reach.

    `edges` holds pairs of bigint columns; pairs with a null or with itself link nothing. Large-star rounds
    tie the larger neighbours of a node to its least one, small-star rounds the smaller ones; the rounds needed
    grow with the logarithm of the longest path. No node's neighbours are gathered in one row or task.
    """
    links = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
    ).distinct()
    links = freeze(links, "links")
    state = _state(links)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = freeze(large.distinct(), "large-star")
        least = _least(large)
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = freeze(small.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct(), "small-star")
        before, state = state, _state(links)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return links.select(F.col("u").alias("node"), F.col("v").alias("label"))
