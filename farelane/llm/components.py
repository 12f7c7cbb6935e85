"""Connected components of a link table by randomised contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.llm.common import sent_if_small, stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest id reachable) of all ends of the links ``a, b``.

    In each round every node moves to the neighbour (or itself) that is first in the order of
    that round; moved links that still join two nodes go on. The first order is that of the ids, which ends stars around their
    smallest node at once; later ones are random, so the number of nodes falls by a constant factor
    on average, chains included. Minima over a hub's links start in the map tasks. Null ends are ignored.
    """
    links = links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    links = stored(links.filter("a <> b").distinct(), "links")
    home: DataFrame | None = None
    turn = 0
    while True:
        rank = lambda c: F.struct((F.xxhash64(F.col(c), F.lit(turn)) if turn else F.lit(0)).alias("h"), F.col(c).alias("n"))  # noqa: B023, E731
        ends = links.select("a", rank("b").alias("r")).union(links.select(F.col("b").alias("a"), rank("a").alias("r")))
        first = ends.groupBy("a").agg(F.min("r").alias("r"))
        moves = stored(first.select(F.col("a").alias("node"), F.least("r", rank("a"))["n"].alias("to")), "moves")
        small = sent_if_small(moves)
        home = moves if home is None else (
            home.join(sent_if_small(moves.toDF("to", "next")), "to", "left").select("node", F.coalesce("next", "to").alias("to"))
        )
        moved = (
            links.join(small.toDF("a", "x"), "a").join(small.toDF("b", "y"), "b")
            .filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
        )
        links = stored(moved, "links")
        if links.isEmpty():
            break
        turn += 1
    home = stored(home, "homes")
    smallest = home.groupBy("to").agg(F.min("node").alias("component"))
    return home.join(sent_if_small(smallest), "to").select("node", "component")
