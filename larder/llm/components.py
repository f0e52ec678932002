"""Connected components of a table of links by repeated contraction; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import stored


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of every node of the links ``a``, ``b``.

    In each round every node moves to the one among itself and its neighbours that comes first in an order drawn anew
    by hashing; links follow their ends, loops and repeated links go.  A fixed share of the nodes that still have links
    is expected to go in a round, on chains too, so rounds grow with the logarithm of the longest chain.
    """
    edges = stored(links.select("a", "b").where("a <> b").distinct(), f"{name}-links")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    place = nodes.select("node", F.col("node").alias("root"))
    turn = 0
    while not edges.isEmpty():
        rank = lambda c: F.struct(F.xxhash64(F.lit(turn), F.col(c)).alias("h"), F.col(c).alias("x"))
        both = edges.union(edges.select("b", "a"))
        move = stored(both.groupBy("a").agg(F.min(rank("b")).alias("m")).select("a", F.least(rank("a"), "m")["x"].alias("m")), f"{name}-moves")
        place = stored(
            place.join(move, F.col("root") == F.col("a"), "left").select("node", F.coalesce("m", "root").alias("root")), f"{name}-nodes"
        )
        to = move.select(F.col("a").alias("y"), F.col("m").alias("my"))
        moved = edges.join(move, "a").join(to, F.col("b") == F.col("y")).select(F.col("m").alias("a"), F.col("my").alias("b"))
        edges = stored(
            moved.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-links"
        )
        turn += 1
    first = place.groupBy("root").agg(F.min("node").alias("first"))
    return stored(place.join(first, "root").select("node", F.col("first").alias("root")), f"{name}-roots")
