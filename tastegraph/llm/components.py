"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.plans.durable import durable


def components(edges: DataFrame) -> DataFrame:
    """``(a, b)`` links → ``(id, component)``, the smallest id that can be reached; ids without links are absent.

    Alternating stars: each node links its larger neighbours to its smallest one (large star), then its
    smaller neighbours and itself to the smallest (small star), until no link changes. A round is two
    aggregates with map-side combine and two joins whose other side has one row per node, so a node with
    very many links is a skewed join side, which can be split, and never a group. Rounds grow with the
    logarithm of the longest path.
    """
    links = durable(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    state = None
    while True:
        seen = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state or not seen[0]:
            return durable(
                links.select(F.col("u").alias("id"), F.col("v").alias("component"))
                .unionByName(links.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
            )
        state = seen
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v"))
        links = durable(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
