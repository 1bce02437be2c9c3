"""Connected components by alternating large-star and small-star steps.

Each step is a minimum per node, combined before the shuffle, and an equi-join
that hands it to the node's links; a node with very many links is split by
Spark's skew join. Every round is written to the shared folder, which cuts the
lineage and survives lost executors. The number of rounds grows with the
logarithm of the longest chain.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsheaf.llm.common import staged


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
    return tuple(row)


def _linked(rows: DataFrame) -> DataFrame:
    return rows.filter("high <> low").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` of every node in ``links(a, b)`` but the smallest of its component.

    ``component`` is the smallest node that can be reached. Links to itself and
    repeated links change nothing; without links the result is empty.
    """
    now = staged(_linked(links.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))), "links")
    state = _state(now)
    while True:
        sides = now.select(F.col("high").alias("u"), F.col("low").alias("v")).union(
            now.select(F.col("low").alias("u"), F.col("high").alias("v"))
        )
        least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _linked(
            sides.join(least, "u").filter("v > u").select(F.col("v").alias("high"), F.col("m").alias("low"))
        )
        large = staged(large, "large-star")
        least = large.groupBy("high").agg(F.min("low").alias("m"))
        # every lower neighbour, and the node itself, goes to the least one
        small = large.join(least, "high").select(F.col("low").alias("high"), F.col("m").alias("low"))
        stars = least.select("high", F.col("m").alias("low"))
        now = staged(_linked(small.union(stars)), "small-star")
        before, state = state, _state(now)
        if state == before:
            return now.select(F.col("high").alias("node"), F.col("low").alias("component"))
