"""Connected components of a link table, by alternating star steps.

Each round hangs every node's larger neighbours, then its smaller ones, on the smallest node it
knows. A round is two grouped minima and two joins; a node with very many links is a hot join key,
which adaptive execution splits, and its minimum is taken before the shuffle. No component is ever
gathered in one place, and every round ends in a table of the work folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import stored


def _hang(pairs: DataFrame) -> DataFrame:
    """Add to each pair (u, v) the smallest v of its u."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least, "u")


def _round(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = (_hang(both).where("v > u")
             .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
    hung = _hang(large)
    return (hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(hung.select("u", F.col("m").alias("v")))).distinct()


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """links(a, b) → (id, component): the smallest id reachable, for every id that has a link.

    Links may repeat, come in both directions or join an id with itself; rows with a null end are
    no links. An empty table gives an empty result.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"),
                                                F.least("a", "b").alias("v")).distinct(), label)
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before, edges = state, stored(_round(edges), label)
    return (edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
            .unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")))
            .distinct())
