"""Connected components of a table of links, by alternating star steps.

Each round hangs every node under the smallest of its neighbours: first the
larger neighbours of a node (large star), then the smaller ones (small star).
The links end as stars around the smallest node of each component, after a
number of rounds that grows with the logarithm of the longest path. Every round
is written to the shared folder, so lineage stays short and a lost executor
costs the tasks it ran.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.tables import join_salted
from salesloom.session import stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        links.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    larger = join_salted(both.where("v > u"), least, "u", "v", "inner")
    return larger.select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node hangs under smaller ones here: a > b."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = join_salted(links, least, "a", "b", "inner")
    return (
        moved.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select("a", F.col("m").alias("b")))
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is linked with, for all nodes of links.

    ``links`` has the columns a and b; order and repetition don't matter. Links
    of a node to itself and null ends are left out, as they join nothing.
    """
    def state(frame):
        return tuple(frame.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = stored(links.where("a <> b").select("a", "b"), "links")
    before = None
    while before != (before := state(now)):
        now = stored(_small_star(_large_star(now)), "links")
    roots = now.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
