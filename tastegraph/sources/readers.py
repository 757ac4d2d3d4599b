"""Readers for ratings, interactions and pair files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RATING_TYPES = {"user": "long", "item": "long", "rating": "double"}
# Formats whose inferred columns come sorted by name.
UNORDERED = ("json", "xml")


def _csv_fields(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """The first columns of a headed CSV by position, as text.

    Further columns are ignored, a line with fewer or more fields than the header fails, and every
    line equal to the header is dropped (files put together from parts repeat it).
    """
    raw = spark.read.csv(path, header=True, inferSchema=False, mode="FAILFAST", enforceSchema=False)
    header = raw.columns
    same = F.lit(True)
    for name in header:
        same = same & F.coalesce(F.col(f"`{name}`") == F.lit(name), F.lit(False))
    return raw.where(~same).select(*[F.col(f"`{h}`").alias(n) for h, n in zip(header, names)])


def _columnar(spark: SparkSession, path: str, format: str, names: list[str]) -> DataFrame:
    """The first columns by position, or by name where the format keeps no order of columns."""
    source = spark.read.format(format).load(path)
    if format.lower() in UNORDERED:
        return source.select(*names)
    return source.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(source.columns, names)])


def read_ratings(spark: SparkSession, path: str, format: str = "csv") -> DataFrame:
    """``(user, item, rating)`` from a headed CSV by position, or from a columnar format by position (JSON and XML: by
    name, since their columns have no order)."""
    names = list(RATING_TYPES)
    if format == "csv":
        rows = _csv_fields(spark, path, names)
    else:
        rows = _columnar(spark, path, format, names)
    return rows.select(*[F.col(n).cast(t).alias(n) for n, t in RATING_TYPES.items()])


def read_interactions(spark: SparkSession, path: str, format: str = "csv", text_ids: bool = False) -> DataFrame:
    """``(user, item)`` without ratings; ``text_ids`` keeps the ids as text, which then sort as text."""
    kind = "string" if text_ids else "long"
    if format == "csv":
        rows = _csv_fields(spark, path, ["user", "item"])
    else:
        rows = _columnar(spark, path, format, ["user", "item"])
    return rows.select(*[F.col(n).cast(kind).alias(n) for n in ("user", "item")])


def read_pairs(spark: SparkSession, path: str, text_ids: bool = False) -> DataFrame:
    """Distinct pairs ``(a, b)``, smaller id first, from lines ``a,b[,…]`` without header; blank lines
    and further columns are ignored."""
    kind = "string" if text_ids else "long"
    fields = F.split("value", ",")
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    pairs = lines.select(fields[0].cast(kind).alias("x"), fields[1].cast(kind).alias("y"))
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
