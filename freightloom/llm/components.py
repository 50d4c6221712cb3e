"""Connected components by alternating large and small stars; every round is a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightloom.llm.common import kept


def _pull(edges: DataFrame) -> DataFrame:
    """Edges with the smallest neighbour of their first end, itself included."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def components(links: DataFrame, folder: str) -> DataFrame:
    """(u, root) for every end of ``links`` (two columns of one orderable type) but the roots themselves.

    Rounds grow with the logarithm of the longest chain.  Nothing is collected but a count and a checksum.
    """
    u, v = links.columns
    edges = kept(links.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u <> v").distinct(),
                 folder, "links")
    seen, turn = None, 0
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(state) == seen or not state[0]:
            return edges.select("u", F.col("v").alias("root"))
        seen = tuple(state)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _pull(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _pull(large)
        stars = (small.select("u", F.col("m").alias("v"))
                 .unionByName(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct())
        turn += 1
        edges = kept(stars, folder, f"stars_{turn}")
