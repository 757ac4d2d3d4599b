"""Quality of predictions and of pair sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegraph.operators.ratings import PAIR

LAST_BUCKET = 4


def score(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    """``(user, item, rating, prediction, abs_error)`` for pairs present on both sides."""
    return truth.select(*PAIR, "rating").join(predictions, PAIR).select(
        *PAIR, "rating", "prediction", F.abs(F.col("rating") - F.col("prediction")).alias("abs_error")
    )


def error_histogram(scored: DataFrame) -> DataFrame:
    """``(bucket, n)`` in order of the bucket, for absolute errors in [0,1) … [3,4) and ≥ 4; empty buckets show 0."""
    bucket = F.least(F.floor("abs_error"), F.lit(LAST_BUCKET)).cast("long")
    counted = scored.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    every = scored.sparkSession.range(LAST_BUCKET + 1).withColumnRenamed("id", "bucket")
    rows = every.join(counted, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    return rows.orderBy("bucket")


def rmse(scored: DataFrame) -> DataFrame:
    return scored.agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(F.col("abs_error") * F.col("abs_error"))).alias("rmse")
    )


def quality_columns(error: Column) -> list[Column]:
    """Aggregates of absolute errors: pairs, RMSE and the histogram; null errors do not count."""
    # "least" passes over nulls
    bucket = F.when(error.isNotNull(), F.least(F.floor(error), F.lit(LAST_BUCKET)))
    labels = [f"error_{b}" for b in range(LAST_BUCKET)] + [f"error_{LAST_BUCKET}_up"]
    return [
        F.count(error).cast("double").alias("pairs"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        *[
            F.coalesce(F.sum((bucket == b).cast("double")), F.lit(0.0)).alias(label)
            for b, label in enumerate(labels)
        ],
    ]


def rating_quality(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    """Report ``(metric, value)``: pairs scored, RMSE and the error histogram, from one aggregate."""
    wide = score(predictions, truth).agg(*quality_columns(F.col("abs_error")))
    return wide.unpivot([], wide.columns, "metric", "value")


def pair_quality(found: DataFrame, truth: DataFrame) -> DataFrame:
    """One row ``(tp, fp, fn, precision, recall)`` of two pair sets ``(a, b)``, in either order.

    One union and one aggregate; a ratio without cases is null.
    """

    def side(pairs, in_found, in_truth):
        return pairs.select(
            F.least("a", "b").alias("a"),
            F.greatest("a", "b").alias("b"),
            F.lit(in_found).alias("f"),
            F.lit(in_truth).alias("t"),
        )

    sides = side(found, 1, 0).unionByName(side(truth, 0, 1))
    pairs = sides.groupBy("a", "b").agg(F.max("f").alias("f"), F.max("t").alias("t"))

    def count(condition):
        return F.coalesce(F.sum(condition.cast("long")), F.lit(0)).cast("long")

    counts = pairs.agg(
        count((F.col("f") == 1) & (F.col("t") == 1)).alias("tp"),
        count((F.col("f") == 1) & (F.col("t") == 0)).alias("fp"),
        count((F.col("f") == 0) & (F.col("t") == 1)).alias("fn"),
    )
    tp = F.col("tp").cast("double")
    return counts.select(
        "tp",
        "fp",
        "fn",
        F.try_divide(tp, F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide(tp, F.col("tp") + F.col("fn")).alias("recall"),
    )
