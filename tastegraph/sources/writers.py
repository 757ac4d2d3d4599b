"""Writers: globally sorted part files, no header in CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tastegraph.operators.evaluate import quality_columns
from tastegraph.operators.ratings import PAIR, dedup


def canonical_pairs(pairs: DataFrame) -> DataFrame:
    """Smaller id first and one row per pair, with its largest similarity."""
    return pairs.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(
        F.max("similarity").alias("similarity")
    )


def write_pairs(pairs: DataFrame, path: str, format: str = "csv", mode: str = "errorifexists") -> None:
    """``a, b, similarity`` sorted by (a, b), smaller id first, one row per pair."""
    canonical_pairs(pairs).orderBy("a", "b").write.mode(mode).format(format).save(path)


def write_predictions(predictions: DataFrame, path: str, format: str = "csv", mode: str = "errorifexists") -> None:
    """``user, item, prediction`` sorted by (user, item)."""
    predictions.select(*PAIR, "prediction").orderBy(*PAIR).write.mode(mode).format(format).save(path)


def write_evaluated(
    predictions: DataFrame, truth: DataFrame, path: str, format: str = "csv", mode: str = "errorifexists"
) -> DataFrame:
    """Write as ``write_predictions`` does and return the report of ``rating_quality``, from the same pass.

    The metrics are observed on the rows on their way into the files, so the predictor runs once. They are taken above the
    sort: below it, the job that samples the sort's ranges would count rows as well, and so would a stage that is run
    again. Predictions without a rating in ``truth`` are written and not scored; of repeated ratings the largest counts.
    """
    seen = Observation()
    rated = predictions.select(*PAIR, "prediction").join(dedup(truth.select(*PAIR, "rating")), PAIR, "left")
    error = F.abs(F.col("rating") - F.col("prediction"))
    ordered = rated.orderBy(*PAIR).observe(seen, *quality_columns(error))
    ordered.select(*PAIR, "prediction").write.mode(mode).format(format).save(path)
    return predictions.sparkSession.createDataFrame(list(seen.get.items()), "metric string, value double")
