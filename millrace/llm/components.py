"""Connected components of an edge table, by alternating large-star and small-star rounds.

Each round links nodes to the smallest node they know of, with a minimum per node that is combined
before the shuffle, and ends as a table in the shared folder. Rounds stop when the edges no longer
change, which is when every node points at the smallest of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.scratch import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node of ``edges`` (columns
    ``a`` and ``b``) but the roots themselves."""
    low, high = F.least("a", "b"), F.greatest("a", "b")
    stars = edges.filter(F.col("a") != F.col("b")).select(high.alias("node"), low.alias("root"))
    stars = materialize(stars.distinct(), "links")
    before = None
    while True:
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(20,0)"))).first()
        if state == before:
            return stars
        before = state
        stars = materialize(_small_star(_large_star(stars)), "stars")


def _large_star(stars: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest one."""
    both = stars.select(F.col("node").alias("u"), F.col("root").alias("v")).unionAll(
        stars.select(F.col("root").alias("u"), F.col("node").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("_min"))
    larger = both.filter(F.col("v") > F.col("u")).join(least, "u")
    return larger.select(F.col("v").alias("node"), F.least("_min", "u").alias("root")).distinct()


def _small_star(stars: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    least = stars.groupBy("node").agg(F.min("root").alias("_min"))
    linked = stars.join(least, "node").select(F.col("root").alias("node"), F.col("_min").alias("root"))
    own = least.select("node", F.col("_min").alias("root"))
    return linked.filter(F.col("node") != F.col("root")).unionAll(own).distinct()
