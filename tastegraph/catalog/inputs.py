"""Logical inputs derived from the given tables."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph.operators.ratings import dedup

# Ratings from orders of this date or later form the test set.
TEST_FROM = datetime.datetime(2001, 1, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _rated(spark: SparkSession, sf_dir: str, since: datetime.datetime | None = None) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    if since is not None:
        orders = orders.where(F.col("o_orderdate") >= F.lit(since).cast(orders.schema["o_orderdate"].dataType))
    lines = table(spark, sf_dir, "lineitem")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("o_custkey").alias("user"),
        F.col("l_partkey").alias("item"),
        (F.lit(1) + F.floor((F.col("l_quantity") - 1) / 10)).cast("double").alias("rating"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer × part ratings 1 … 5 from the quantities ordered, one per pair."""
    return dedup(_rated(spark, sf_dir))


def test_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(_rated(spark, sf_dir, TEST_FROM))


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, word)``: the words of each document."""
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", F.explode(F.split("text", " ")).alias("word"))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding")


EMBEDDING_DIMS = 64
