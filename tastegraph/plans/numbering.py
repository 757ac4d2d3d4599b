"""Gapless row numbers without a single-task sort.

Two passes: rows are range-partitioned by the order and counted per range; running totals of the counts, one row per
range, are the offsets at which each range starts to number its own rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.plans.durable import durable
from tastegraph.plans.lookup import lookup


def dense_numbers(
    rows: DataFrame, order: Sequence[str], within: Sequence[str] = (), name: str = "number", total: str | None = None
) -> DataFrame:
    """The rows and ``name``: 0, 1, 2 … in ascending order (nulls first) of ``order`` inside each group ``within``.

    ``total`` names a further column with the size of the group. Rows equal in all of ``order`` get adjacent numbers in
    some order that the result keeps. Null groups are groups. A group, and a single value of ``order``, may hold any share
    of the rows: both are cut into ranges. Columns named ``_part``, ``_tie``, ``_group``, ``_rows``, ``_before`` are taken.
    """
    source = durable(rows).withColumn("_tie", F.monotonically_increasing_id()).withColumn("_group", F.struct(*within, F.lit(0)))
    ranged = durable(
        source.repartitionByRange(*[F.col(c) for c in (*within, *order, "_tie")]).withColumn("_part", F.spark_partition_id())
    )
    counts = ranged.groupBy("_group", "_part").agg(F.count(F.lit(1)).alias("_rows"))
    # one row per range and group in it
    group = Window.partitionBy("_group")
    earlier = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_group", "_part", "_rows",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        *([F.sum("_rows").over(group).alias(total)] if total else []),
    )
    inside = Window.partitionBy("_group", "_part").orderBy(*order, "_tie")
    own = lookup(ranged, offsets, ["_group", "_part"], "_rows")
    return own.withColumn(name, F.row_number().over(inside) - 1 + F.col("_before")).drop(
        "_part", "_tie", "_group", "_rows", "_before"
    )
