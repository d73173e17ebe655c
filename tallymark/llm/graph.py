"""Connected components by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_parts, removed, written


def _with_least(links: DataFrame) -> DataFrame:
    """Links with m, the smallest v of their u; a hub's links are dealt over parts, so no task has all of them."""
    dealt, least = by_parts(links, ["u"], "v", {"m": F.min("v")}, {"m": F.min("m")})
    return dealt.join(least, ["u", "_part"]).drop("_part")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and component (the smallest node reachable) for every node of a link; null ends are no links.

    Each step is written to the shared folder, and the one before is removed. The number of steps grows with the
    logarithm of the longest chain.
    """
    spark = edges.sparkSession
    links = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    old: list[str] = []
    links = written(links, "links", held=old)
    was = None
    while True:
        now: list[str] = []
        # large star: every larger neighbour of u, and u's smallest neighbour or u itself
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        large = written(large, "links", held=now)
        # small star: every smaller neighbour of u, and u itself
        near = _with_least(large)
        links = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(large.groupBy("u").agg(F.min("v").alias("v"))).distinct()
        removed(spark, old)
        links = written(links, "links", held=old)
        removed(spark, now)
        state = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == was:
            break
        was = state
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
