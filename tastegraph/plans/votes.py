"""Bring test cells together with the neighbours that rated the target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.plans.durable import durable
from tastegraph.plans.lookup import lookup

BUSY = 1024


def neighbor_votes(cells: DataFrame, weights: DataFrame, rated: DataFrame, by: str, busy: int = BUSY) -> DataFrame:
    """``(user, item, neighbor, weight, value)`` rows for cells ``(user, item)``.

    ``weights`` is ``(id, neighbor, weight)`` over users or items (``by``), ``rated`` is
    ``(user, item, value)``. There are two ways to the same rows: from the cell to all who rated the
    target and on to their weights, or from the cell to all neighbours and on to their ratings. The
    first costs the target's popularity, so it serves targets with up to ``busy`` ratings; the few
    busier ones take the second, and no group of a popular target is paired with its cells.
    """
    other = "item" if by == "user" else "user"
    known = rated.select(F.col(by).alias("neighbor"), other, "value")
    sizes = known.groupBy(other).agg(F.count(F.lit(1)).alias("raters"))
    columns = ["user", "item", "neighbor", "weight", "value"]

    edges = weights.select(F.col("id").alias(by), "neighbor", "weight")
    if (sizes.agg(F.max("raters")).first()[0] or 0) <= busy:
        return cells.join(known, other).join(edges, [by, "neighbor"]).select(*columns)
    sizes = durable(sizes)
    heavy = sizes.where(F.col("raters") > busy).select(other)
    light_known = lookup(known, sizes, other, "raters", written=True).where(F.col("raters") <= busy).drop("raters")
    light = cells.join(light_known, other).join(edges, [by, "neighbor"])
    busy_cells = cells.join(heavy, other, "left_semi")
    dense = busy_cells.join(edges, by).join(known, ["neighbor", other])
    return light.select(*columns).unionByName(dense.select(*columns))
