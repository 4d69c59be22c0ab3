"""Connected components of a link table, as Spark joins (large-star and small-star steps).

Every step takes, for each node, the smallest of its neighbours by an aggregate (pre-aggregated
before its shuffle) and joins it back to the links; no node's neighbours are ever gathered in one
task, and a node with very many links is a skewed join, which Spark splits. Nothing is collected
but two numbers a round. Each round's links are cut from their lineage by ``checkpoint()`` into
the folder that ``spark.checkpoint.dir`` names, so a lost executor costs at most one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import cut_lineage


def _down(links: DataFrame) -> DataFrame:
    """Distinct (a, b) with a > b."""
    return links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), "m")
    moved = links.join(least, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
    return _down(moved.union(least.select(F.col("k").alias("a"), F.col("m").alias("b"))))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for each node with a link to another, the smallest node reachable."""
    now = cut_lineage(_down(links.select(F.col(a).alias("a"), F.col(b).alias("b"))))
    mark = None
    while True:
        seen = now.agg(F.count("*").alias("n"), F.sum(F.hash("a", "b").cast("decimal(20,0)")).alias("s")).first()
        if seen == mark or not seen["n"]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        mark = seen
        now = cut_lineage(_small_star(_large_star(now)))
