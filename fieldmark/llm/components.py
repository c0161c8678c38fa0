"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmark.session import settle


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every end of ``links`` (columns a, b); a component is named by its smallest id.

    Each round every node moves to the neighbour, or itself, whose hash under that
    round's seed is smallest, and links follow.  A chain shrinks by a constant factor
    a round and a star folds at once, so rounds grow with the logarithm of the longest
    path.  Nodes and links stay in tables; the driver sees only whether links remain.
    Links with a null end, loops and repeated links change nothing.
    """
    ends = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    links = settle(links.where("a != b").select(*ends).distinct())
    placed, seed = links.select(F.col("a").alias("id"), F.col("a").alias("at")).limit(0), 0
    while not links.isEmpty():
        seed += 1
        rank = lambda c: F.struct(F.xxhash64(F.lit(seed), c).alias("h"), F.col(c).alias("to"))
        both = links.union(links.select("b", "a"))
        moves = settle(
            both.groupBy("a").agg(F.min(rank("b")).alias("near")).select(F.col("a").alias("id"), F.least("near", rank("a"))["to"].alias("to"))
        )
        if seed == 1:
            placed = moves.select("id", F.col("to").alias("at"))
        else:
            step = moves.select(F.col("id").alias("at"), "to")
            placed = placed.join(step, "at", "left").select("id", F.coalesce("to", "at").alias("at"))
        placed = settle(placed)
        moved = (
            links.join(moves.select(F.col("id").alias("a"), F.col("to").alias("x")), "a")
            .join(moves.select(F.col("id").alias("b"), F.col("to").alias("y")), "b")
            .where("x != y")
        )
        links = settle(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    names = placed.groupBy("at").agg(F.min("id").alias("component"))
    return settle(placed.join(names, "at").select("id", "component"))
