"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainpanel.llm.common import settled


def component_roots(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for every node of ``edges`` (``a``, ``b``: long).

    Each round points the larger neighbours of every node at its smallest neighbour, then the
    smaller ones (Kiveris and others, "Connected Components in MapReduce and Beyond", 2014). Edges
    never multiply, a hub's neighbours are combined before they are shuffled, and the rounds grow
    with the logarithm of the longest path. Every round is written to the checkpoint folder. Only
    two totals come to the driver.
    """
    links = settled(
        edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi <> lo").distinct())
    total = (F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")))
    before = links.agg(*total).first()
    while before[0]:
        both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            links.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = large.filter("hi <> lo").distinct()
        # Every node's smaller neighbours, and itself, now go to the smallest of them.
        down = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(down, "hi").select(
            F.explode(F.array(F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")),
                              F.struct(F.col("hi"), F.col("m").alias("lo")))).alias("e")).select("e.hi", "e.lo")
        links = settled(small.filter("hi <> lo").distinct())
        state = links.agg(*total).first()
        if state == before:
            break
        before = state
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionAll(
        links.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
