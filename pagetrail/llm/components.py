"""Connected components of a link table by alternating large and small stars.

Each round replaces links by links to smaller ids: a node's larger neighbours are
hung on its smallest neighbour, then its smaller ones. Rounds grow with the
logarithm of the component size; minima are pre-aggregated, so a hub with very
many links costs one partial row per task, and no group is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetrail.llm.common import materialize


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b), the component being its smallest id.

    Self-links, repeated links and links with a null end are ignored; no links give no rows.
    """
    links = materialize(links.select("a", "b").where("a is not null and b is not null and a <> b").distinct(), "links")
    before = None
    while True:
        links = materialize(_small_star(_large_star(links)), "stars")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    node = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return node.unionByName(node.select(F.col("component").alias("node"), "component")).distinct()
