"""Bring raw predictions onto the rating scale."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.functions.columns import clamp, stretch
from tastegraph.plans.durable import durable


def rescale(
    predictions: DataFrame, how: str | None, low: float = 1.0, high: float = 5.0, column: str = "prediction"
) -> DataFrame:
    """``how``: ``"clamp"`` to [low, high], ``"minmax"`` over the whole result, or None."""
    if how is None:
        return predictions
    value = F.col(column)
    if how == "clamp":
        return predictions.withColumn(column, clamp(value, low, high))
    if how != "minmax":
        raise ValueError(f"unknown rescale {how!r}")
    # Read twice, once for the ends, so the predictions are written rather than worked out again.
    predictions = durable(predictions)
    ends = predictions.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi")).alias("ends")).scalar()
    return predictions.withColumn(column, stretch(value, ends["lo"], ends["hi"], low, high))
