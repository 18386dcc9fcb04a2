"""Connected components over an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._tables import materialize


def _point_to_least(pairs: DataFrame) -> DataFrame:
    """Join every pair (u, v) with the least neighbour of ``u``.

    The aggregate combines on the map side, so a node with very many
    neighbours reaches the shuffle as one row per task; in the join only its
    large side repeats the key, which skew-join handling splits.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least, "u")


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of the undirected graph with edges (u, v).

    Returns (node, component) for every node with an edge to another node;
    ``component`` is its smallest node.  Self loops, repeated edges and edges
    with a null end are ignored; no edges give an empty result.  Each round
    is written to the shared folder; the rounds grow with the logarithm of
    the graph's diameter.
    """
    def tidy(df: DataFrame) -> DataFrame:
        return df.where(F.col("u") != F.col("v")).select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def state(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % F.lit(2**40))).first())

    stars = materialize(tidy(edges.select("u", "v")), "components")
    before = state(stars)
    while before[0]:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: every larger neighbour moves to the least of the neighbourhood
        large = tidy(_point_to_least(both).where("v > u").select(
            F.col("v").alias("u"), F.least("u", "m").alias("v")))
        # small star: the node and its smaller neighbours move to the least of them
        low = _point_to_least(large)
        small = tidy(low.select(F.col("v").alias("u"), F.col("m").alias("v"))
                     .unionByName(low.select("u", F.col("m").alias("v"))))
        stars = materialize(small, "components")
        after = state(stars)
        if after == before:
            break
        before = after
    return stars.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
