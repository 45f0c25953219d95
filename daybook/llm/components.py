"""Connected components by alternating large-star and small-star steps.

Each step replaces the links of a node by links to the smallest node it knows,
so a component shrinks to a star around its smallest id in a number of rounds
that grows with the logarithm of its diameter.  Links stay in DataFrames; each
round cuts its lineage with a reliable checkpoint, and only a checksum of the
links reaches the driver, to see that nothing changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import cut


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (both.where("b > a").join(low, "a").where("b <> m")
            .select(F.col("m").alias("a"), "b").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    near = down.join(low, "a").where("b <> m").select(F.col("m").alias("a"), "b")
    return near.union(low.select(F.col("m").alias("a"), F.col("a").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 40))).first())


def connected(links: DataFrame) -> DataFrame:
    """(id, comp) of every node of links (a, b): comp is the smallest id reachable."""
    links = cut(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    state = _state(links)
    while state[0]:
        links = cut(_small_star(_large_star(links)))
        now = _state(links)
        if now == state:
            break
        state = now
    stars = links.select(F.col("b").alias("id"), F.col("a").alias("comp"))
    return stars.union(links.select(F.col("a").alias("id"), F.col("a").alias("comp"))).groupBy("id").agg(F.min("comp").alias("comp"))
