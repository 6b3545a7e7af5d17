"""Connected components of a graph given as links, as rounds of joins on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from discolake.llm.tables import stored


def _least(links: DataFrame) -> DataFrame:
    """For each node the least of itself and its neighbours."""
    return links.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """links a, b -> node, component, the least node that links reach; nodes without links are left out.

    Every round first hangs the larger neighbours of each node on the least one around
    it, then the smaller ones (Kiveris et al., Connected Components in MapReduce and Beyond).
    A hub's neighbours are a join on the hub, which adaptive execution splits; its least
    neighbour is combined before the shuffle.
    """
    current = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = stored(current.distinct(), "links", narrow=True)
    state = None
    while True:
        both = _both_ways(current)
        large = both.join(_least(both), "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = stored(large.filter("a <> b").distinct(), "links", narrow=True)
        small = large.join(_least(large), "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
        current = stored(small.filter("a <> b").distinct(), "links", narrow=True)
        seen = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.countDistinct("a")
        ).first()
        if seen == state or seen[0] == seen[2] and _is_star(current):
            break
        state = seen
    roots = current.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _is_star(links: DataFrame) -> bool:
    """No node hangs on one that itself hangs on another."""
    hung = links.select(F.col("a").alias("hung"))
    return links.select("b").distinct().join(hung, F.col("b") == F.col("hung"), "left_semi").isEmpty()
