"""Connected components of a link table by alternating large-star and small-star steps.

Both steps are a minimum per node, merged on the map side, and a join back; no node's links
are ever gathered into a list, and nothing comes to the driver but one count per round. The
number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import settle


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    to = edges.join(least, "u")
    # one row per link: its smaller end goes to the minimum of the larger end
    return to.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        least.select("u", F.col("m").alias("v"))
    ).where("u <> v")


def _down(df: DataFrame) -> DataFrame:
    return df.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has a link; component is its smallest node."""
    edges = settle(_down(links.select(F.col(a).alias("u"), F.col(b).alias("v"))), "links")
    while True:
        new = settle(_down(_small(_down(_large(edges)))), "stars")
        # settled when every node hangs on a node that hangs on none
        low = new.select(F.col("v").alias("u")).distinct()
        more = new.join(low, "u", "left_semi").limit(1).count()
        twice = new.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
        edges = new
        if not more and not twice:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
