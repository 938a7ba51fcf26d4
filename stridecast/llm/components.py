"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridecast.scratch import written


def components(links: DataFrame) -> DataFrame:
    """node, component for every node of ``links`` (a bigint, b bigint).

    Every round each node takes the place of its least neighbour, in an order that
    changes from round to round, and links are drawn between the places; rounds go
    on until no link is left. Least neighbours are maximum-free partial aggregates
    and the joins leave hot nodes to adaptive execution, so a node with very many
    links is never gathered. Each round is written, which cuts lineage.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(both.where("a <> b").distinct(), "links")
    place = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    turn = 0
    while not edges.isEmpty():
        flip = F.lit((turn * 0x9E3779B97F4A7C15 + (1 << 63)) % (1 << 64) - (1 << 63)).cast("bigint")
        least = edges.groupBy("a").agg(F.min(F.col("b").bitwiseXOR(flip)).alias("_b"))
        least = written(least.select("a", F.least("_b", F.col("a").bitwiseXOR(flip)).bitwiseXOR(flip).alias("to")), "places")
        place = written(
            place.join(least, place["component"] == least["a"], "left").select(
                "node", F.coalesce("to", "component").alias("component")
            ),
            "components",
        )
        moved = edges.join(least, "a").select(F.col("to").alias("a"), "b")
        other = least.select(F.col("a").alias("b"), F.col("to").alias("_to"))
        moved = moved.join(other, "b").select("a", F.col("_to").alias("b"))
        edges = written(moved.where("a <> b").distinct(), "links")
        turn += 1
    return place
