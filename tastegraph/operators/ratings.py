"""Rating preparation: de-duplication, hold-out, means, centring, degrees, density cut.

A rating table has the columns ``user``, ``item``, ``rating``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegraph.functions.hashing import text_id
from tastegraph.plans.durable import durable
from tastegraph.plans.lookup import lookup

PAIR = ["user", "item"]


def dedup(ratings: DataFrame, policy: str = "max") -> DataFrame:
    """One rating per (user, item): ``max``, ``min`` or ``avg`` of the duplicates."""
    pick = {"max": F.max, "min": F.min, "avg": F.avg}[policy]
    return ratings.groupBy(*PAIR).agg(pick("rating").alias("rating"))


def interactions(ratings: DataFrame, set_col: str = "item", element_col: str = "user") -> DataFrame:
    """Distinct ``(id, element)`` rows; by default each item is the set of its users."""
    return ratings.select(F.col(set_col).alias("id"), F.col(element_col).alias("element")).distinct()


def holdout(ratings: DataFrame, test: DataFrame, on: str = "pair") -> DataFrame:
    """Ratings without the test rows; ``on="triple"`` removes only rows whose rating matches too."""
    keys = PAIR if on == "pair" else [*PAIR, "rating"]
    return ratings.join(test.select(*keys), keys, "left_anti")


def with_test(train: DataFrame, test: DataFrame) -> DataFrame:
    """Union all of train and test ratings."""
    return train.select(*PAIR, "rating").unionByName(test.select(*PAIR, "rating"))


def means(ratings: DataFrame, by: str = "user") -> DataFrame:
    return ratings.groupBy(by).agg(
        F.avg("rating").alias("mean"), F.sum("rating").alias("total"), F.count(F.lit(1)).alias("n")
    )


def mean_center(ratings: DataFrame) -> DataFrame:
    """Each rating minus its user's mean. A join on aggregated means, not a window: a window would
    put all rows of one user in one task."""
    return lookup(ratings, means(ratings), "user", "n").select(
        *PAIR, "rating", "mean", (F.col("rating") - F.col("mean")).alias("centered")
    )


def presence(pairs: DataFrame, ratings: DataFrame) -> DataFrame:
    """``(user, item, present)``: 1.0 where the pair is rated, else 0.0; only for the pairs asked for."""
    rated = ratings.select(*PAIR).distinct().withColumn("hit", F.lit(1.0))
    return pairs.select(*PAIR).join(rated, PAIR, "left").select(*PAIR, F.coalesce("hit", F.lit(0.0)).alias("present"))


def degrees(ratings: DataFrame, by: str) -> DataFrame:
    return ratings.groupBy(by).agg(F.count(F.lit(1)).alias("degree"))


def distinct_count(df: DataFrame, column: str) -> Column:
    """Exact distinct count as a scalar subquery."""
    return df.select(column).distinct().agg(F.count(F.lit(1)).alias("n")).scalar()


def rating_lists(ratings: DataFrame, by: str = "user", part_rows: int = 256) -> DataFrame:
    """Adjacency lists in parts: ``(id, part, elements, ratings)``, ordered by element.

    A list is cut into ``ceil(degree / part_rows)`` parts by a hash of the element, so the busiest id
    becomes many rows instead of one that must fit in a task.
    """
    other = "item" if by == "user" else "user"
    parts = F.ceil(F.col("degree") / F.lit(float(part_rows))).cast("long")
    rows = lookup(ratings, degrees(ratings, by), by, "degree").select(
        F.col(by).alias("id"),
        F.pmod(text_id(F.col(other).cast("string")), parts).alias("part"),
        F.struct(F.col(other).alias("element"), F.col("rating").alias("rating")).alias("entry"),
    )
    return (
        rows.groupBy("id", "part")
        .agg(F.array_sort(F.collect_list("entry")).alias("entries"))
        .select("id", "part", F.col("entries.element").alias("elements"), F.col("entries.rating").alias("ratings"))
    )


def rating_maps(ratings: DataFrame, by: str = "user", part_rows: int = 256) -> DataFrame:
    """Sparse matrix rows as maps, in parts as in ``rating_lists``: ``(id, part, ratings)``."""
    lists = rating_lists(durable(dedup(ratings)), by, part_rows)
    return lists.select("id", "part", F.map_from_arrays("elements", "ratings").alias("ratings"))


def shape(ratings: DataFrame) -> DataFrame:
    """One row: users, items, ratings."""
    per_user = ratings.groupBy("user").agg(F.count(F.lit(1)).alias("d"))
    return per_user.agg(F.count(F.lit(1)).alias("users"), F.sum("d").alias("ratings")).select(
        "users", distinct_count(ratings, "item").alias("items"), "ratings"
    )


def gamma_expr(users: Column, items: Column, ratings: Column, numerator: int, denominator: int) -> Column:
    """Density cut ⌊factor·(m+n−1)·Σd / (m·n)⌋ in 38-digit integers."""

    def whole(value: Column) -> Column:
        return value.cast("decimal(18,0)")

    top = whole(F.lit(numerator) * (users + items - F.lit(1))) * whole(ratings)
    bottom = whole(users) * whole(items * F.lit(denominator))
    return F.call_function("div", top, bottom)


def density_gamma(ratings: DataFrame, numerator: int = 3, denominator: int = 1) -> DataFrame:
    return shape(ratings).select(
        "users",
        "items",
        "ratings",
        gamma_expr(F.col("users"), F.col("items"), F.col("ratings"), numerator, denominator).alias("gamma"),
    )
