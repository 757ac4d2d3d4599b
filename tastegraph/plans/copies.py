"""Groups of identical members, so that joins run once per distinct content.

Copies are found by an order-free 128-bit fingerprint plus the size, aggregated map-side; a group
that holds a third of all members costs one row per member here and a single representative in the
join that follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegraph.plans.lookup import lookup
from tastegraph.plans.pairing import BLOCK_ROWS, pairs_within


def fingerprint(*content: Column) -> list[Column]:
    # A hash is seeded with the one before it, so a second hash must start from another seed.
    return [F.xxhash64(*content).alias("_f1"), F.xxhash64(F.lit(7), *content).alias("_f2")]


def group_copies(prints: DataFrame) -> DataFrame:
    """``(id, n, _f1, _f2)`` → ``(id, n, rep, copies)``; rep is the smallest id of the group."""
    key = ["n", "_f1", "_f2"]
    heads = prints.groupBy(*key).agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    return lookup(prints, heads, key, "copies").select("id", "n", "rep", "copies")


def set_copies(sets: DataFrame) -> DataFrame:
    """Copy groups of distinct ``(id, element)`` rows."""
    one, two = fingerprint(F.col("element"))
    prints = sets.groupBy("id").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(one).alias("_f1"), F.bit_xor(two).alias("_f2")
    )
    return group_copies(prints)


def has_copies(members: DataFrame) -> bool:
    return not members.where(F.col("copies") > 1).isEmpty()


def expand_copies(pairs: DataFrame, members: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Pairs of representatives ``(a, b, similarity)`` → pairs of all members, copies included."""
    if not has_copies(members):
        return pairs.select("a", "b", "similarity")
    a_side = members.select(F.col("rep").alias("a"), F.col("id").alias("_x"))
    b_side = members.select(F.col("rep").alias("b"), F.col("id").alias("_y"))
    across = (
        pairs.join(a_side, "a")
        .join(b_side, "b")
        .select(F.least("_x", "_y").alias("a"), F.greatest("_x", "_y").alias("b"), "similarity")
    )
    copied = members.where(F.col("copies") > 1)
    inside = pairs_within(copied, ["rep"], "id", block_rows=block_rows, size="copies").select(
        F.col("a_id").alias("a"), F.col("b_id").alias("b"), F.lit(1.0).alias("similarity")
    )
    return across.unionByName(inside)
