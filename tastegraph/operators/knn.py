"""Neighbourhood predictors: user-based and item-based.

Test pairs, neighbour weights and ratings meet in long form (``plans.votes``), so nothing is held per
user or per item and all sums combine map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.functions.columns import ratio_or
from tastegraph.operators.pearson import pearson_of, pearson_pairs
from tastegraph.operators.ratings import PAIR, dedup, holdout, means, with_test
from tastegraph.operators.rescale import rescale as rescaled
from tastegraph.plans.durable import durable
from tastegraph.plans.lookup import lookup
from tastegraph.plans.pairing import BLOCK_ROWS, mirrored
from tastegraph.plans.votes import neighbor_votes


def top_neighbors(weights: DataFrame, k: int | None, group: list[str], cut: float = 0.0) -> DataFrame:
    """Rank by |weight| (ties by neighbour id) inside each group, keep k, then drop |weight| ≤ cut."""
    if k is not None:
        order = Window.partitionBy(*group).orderBy(F.abs("weight").desc(), F.col("neighbor"))
        weights = weights.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return weights.where(F.abs("weight") > cut)


def neighbor_lists(ratings: DataFrame, by: str = "user", k: int = 10, min_support: int = 1) -> DataFrame:
    """``(id, neighbor, weight, rank)``: the k strongest Pearson neighbours of every id."""
    return top_neighbors(mirrored(pearson_pairs(ratings, by, min_support)), k, ["id"])


def _training(ratings: DataFrame, test: DataFrame, leaky: bool) -> DataFrame:
    """The training table, written once: means, popularity, pairs and votes all read it."""
    return durable(dedup(with_test(ratings, test)) if leaky else holdout(ratings, test))


def _weights(train, pairs, by, min_support, candidates, block_rows, k=None):
    """Both directions of the weighted pairs, written once: both ways to the votes read them. With ``k`` only the
    strongest of each id, whatever they rated."""
    if candidates is not None:
        found = mirrored(pearson_of(candidates, train, by, min_support))
    else:
        only = pairs.select(by).distinct()
        found = mirrored(pearson_pairs(train, by, min_support, only=only, block_rows=block_rows))
    return durable(top_neighbors(found, k, ["id"]).select("id", "neighbor", "weight"))


def _reach(neighborhood: str, k: int | None) -> tuple[int | None, int | None]:
    """How many neighbours to keep per id, and how many per test pair."""
    if neighborhood not in ("target", "global"):
        raise ValueError(f"unknown neighborhood {neighborhood!r}")
    return (k, None) if neighborhood == "global" else (None, k)


def predict_user_knn(
    ratings: DataFrame,
    test: DataFrame,
    k: int | None = None,
    min_support: int = 1,
    cut: float = 0.0,
    candidates: DataFrame | None = None,
    leaky: bool = False,
    exclude_target_from_mean: bool = False,
    rescale: str | None = "clamp",
    default: float = 3.0,
    block_rows: int = BLOCK_ROWS,
    neighborhood: str = "target",
) -> DataFrame:
    """``(user, item, prediction)``: μ_u + Σ w·(r_vi − μ_v) / Σ|w| over the neighbours that rated i.

    ``ratings`` and ``test`` hold one row per (user, item); test pairs are removed from the training
    side unless ``leaky``. ``candidates`` restricts the neighbours to given pairs ``(a, b)``. ``k`` keeps the
    strongest neighbours among those that rated the target, or, with ``neighborhood="global"``, of the user at all.
    """
    everywhere, k = _reach(neighborhood, k)
    train = _training(ratings, test, leaky)
    pairs = durable(test.select(*PAIR))
    stats = durable(means(train))
    weights = _weights(train, pairs, "user", min_support, candidates, block_rows, everywhere)
    mean_v = F.col("mean")
    if exclude_target_from_mean:
        mean_v = ratio_or(F.col("total") - F.col("rating"), F.col("n") - F.lit(1), F.col("rating"))
    offsets = lookup(train, stats, "user", "n", written=True).select(*PAIR, (F.col("rating") - mean_v).alias("value"))
    voters = neighbor_votes(pairs, weights, offsets, "user")
    votes = (
        top_neighbors(voters, k, PAIR, cut)
        .groupBy(*PAIR)
        .agg(F.sum(F.col("weight") * F.col("value")).alias("up"), F.sum(F.abs("weight")).alias("down"))
    )
    predicted = (
        pairs.join(stats.select("user", "mean"), "user", "left")
        .join(votes, PAIR, "left")
        .select(
            *PAIR,
            (F.coalesce("mean", F.lit(default)) + ratio_or(F.col("up"), F.col("down"), 0.0)).alias("prediction"),
        )
    )
    return rescaled(predicted, rescale)


def predict_item_knn(
    ratings: DataFrame,
    test: DataFrame,
    k: int | None = None,
    min_support: int = 1,
    cut: float = 0.0,
    candidates: DataFrame | None = None,
    leaky: bool = False,
    rescale: str | None = "minmax",
    low: float = 0.0,
    high: float = 5.0,
    default: float = 3.0,
    block_rows: int = BLOCK_ROWS,
    neighborhood: str = "target",
) -> DataFrame:
    """``(user, item, prediction)``: Σ w·r_uj / Σ|w| over the neighbour items j that u rated."""
    everywhere, k = _reach(neighborhood, k)
    train = _training(ratings, test, leaky)
    pairs = durable(test.select(*PAIR))
    weights = _weights(train, pairs, "item", min_support, candidates, block_rows, everywhere)
    voters = neighbor_votes(pairs, weights, train.withColumnRenamed("rating", "value"), "item")
    votes = (
        top_neighbors(voters, k, PAIR, cut)
        .groupBy(*PAIR)
        .agg(F.sum(F.col("weight") * F.col("value")).alias("up"), F.sum(F.abs("weight")).alias("down"))
    )
    predicted = pairs.join(votes, PAIR, "left").select(
        *PAIR, ratio_or(F.col("up"), F.col("down"), default).alias("prediction")
    )
    return rescaled(predicted, rescale, low, high)
