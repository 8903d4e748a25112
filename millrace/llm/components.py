"""Connected components over a table of links, by alternating large and small stars.

Each round only joins a link with the least neighbour of its end (pre-aggregated per node) and is
written to the shared folder; no component is ever gathered in one place. Rounds grow with the
logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _toward_least(links: DataFrame, least: DataFrame) -> DataFrame:
    return links.join(least, "u")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    moved = _toward_least(both, least).filter(F.col("v") > F.col("u"))
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every link has u > v."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = _toward_least(links, least).filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected(links: DataFrame, a: str, b: str) -> DataFrame:
    """(`node`, `root`) for every node that has a link; the root is the least node of its component."""
    high, low = F.greatest(a, b), F.least(a, b)
    stars = materialize(links.filter(F.col(a) != F.col(b)).select(high.alias("u"), low.alias("v")).distinct(), "links")
    before = _state(stars)
    while before[0]:
        stars = materialize(_small_star(materialize(_large_star(stars), "large")), "small")
        now = _state(stars)
        if now == before:
            break
        before = now
    leaves = stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return leaves.unionByName(roots)
