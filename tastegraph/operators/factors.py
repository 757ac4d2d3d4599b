"""Model-based prediction: explicit ALS from Spark ML."""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.operators.labels import encoded, label_numbers
from tastegraph.operators.ratings import PAIR, holdout
from tastegraph.operators.rescale import rescale as rescaled
from tastegraph.plans.durable import checkpoint_ready, durable


def fit_als(
    train: DataFrame, rank: int = 3, max_iter: int = 17, reg: float = 1.6, seed: int = 42, blocks: int | None = None
) -> ALSModel:
    """``blocks`` is the number of user and item blocks, by default one for each core of the cluster. ALS takes ids
    in the 32-bit range."""
    blocks = blocks or train.sparkSession.sparkContext.defaultParallelism
    als = ALS(
        rank=rank, maxIter=max_iter, regParam=reg, seed=seed, userCol="user", itemCol="item", ratingCol="rating",
        numUserBlocks=blocks, numItemBlocks=blocks, coldStartStrategy="drop", nonnegative=False,
    )
    return als.fit(train)


def predict_als(
    ratings: DataFrame,
    test: DataFrame,
    rank: int = 3,
    max_iter: int = 17,
    reg: float = 1.6,
    seed: int = 42,
    blocks: int | None = None,
    on: str = "pair",
    rescale: str | None = "minmax",
) -> DataFrame:
    """``(user, item, prediction)``; pairs with an unknown user or item have no prediction and drop.

    Ids that ALS cannot take (beyond 32 bits, or text) are numbered densely for it and come back in the result.
    """
    # ALS draws its starting factors per partition, so the training rows are fixed in files first.
    checkpoint_ready(ratings.sparkSession)
    train = durable(holdout(ratings, test, on).select(*PAIR, "rating"))
    wide = {c: label_numbers(train, c) for c in PAIR if _wide(train, c)}
    asked = test.select(*PAIR)
    for column, numbers in wide.items():
        train = durable(encoded(train, column, numbers))
        asked = encoded(asked, column, numbers)
    model = fit_als(train, rank, max_iter, reg, seed, blocks)
    predicted = model.transform(asked).select(*PAIR, F.col("prediction").cast("double"))
    for column, numbers in wide.items():
        back = numbers.select(F.col("number").alias("label"), F.col("label").alias("number"), "uses")
        predicted = encoded(predicted, column, back)
    return rescaled(predicted, rescale)


def _wide(train: DataFrame, column: str) -> bool:
    """Whether ids leave the 32-bit range of ALS."""
    if train.schema[column].dataType.typeName() not in ("byte", "short", "integer", "long"):
        return True
    low, high = train.agg(F.min(column), F.max(column)).first()
    return low is not None and not -(1 << 31) <= low <= high < 1 << 31


def dropped_pairs(predictions: DataFrame, test: DataFrame) -> DataFrame:
    """Test pairs without a prediction."""
    return test.select(*PAIR).join(predictions.select(*PAIR), PAIR, "left_anti")
