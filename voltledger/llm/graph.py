"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltledger.session import written


def fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links(a, b)``: the smallest node it can reach.

    Each round hangs the neighbours of every node on its smallest one, first the larger
    neighbours, then the smaller. The rounds grow with the logarithm of the longest path; each is
    written to the shared folder. Links with a null end are left out. Counts and smallest
    neighbours combine before they are shuffled, and a hub's links can be split over tasks.
    """
    a, b = F.col("a"), F.col("b")
    edges = written(
        links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
        "links",
    )
    before, now = None, fingerprint(edges)
    while now != before:
        before = now
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.where("v > u")
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").where("v <> m")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v"))
        lowest = lowest.select("u", F.col("m").alias("v"))
        edges = written(small.unionAll(lowest).distinct(), "links")
        now = fingerprint(edges)
    hung = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return hung.unionAll(roots)
