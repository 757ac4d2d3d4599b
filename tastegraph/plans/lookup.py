"""Many-to-one joins in which one key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastegraph.plans.durable import durable

# A key with more than 1/HOT_KEYS of all rows is hot; fewer than HOT_KEYS keys can be.
HOT_KEYS = 16384
# A table of up to this many keys and bytes is broadcast whole.
BROADCAST_KEYS = 131072
BROADCAST_BYTES = 16 << 20


def _width(table: DataFrame) -> Column:
    """The bytes of a row: those of its values as text where their length is open, 16 each otherwise."""
    total = F.lit(0).cast("long")
    for field in table.schema:
        fixed = isinstance(field.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType))
        size = F.lit(16) if fixed else F.coalesce(F.octet_length(F.col(field.name).cast("string")), F.lit(0)) + F.lit(16)
        total = total + size
    return total


def lookup(
    rows: DataFrame, table: DataFrame, key: str | list[str], count: str, written: bool = False
) -> DataFrame:
    """Inner join of ``rows`` with ``table``, which holds one row per key and in ``count`` the number of
    rows that have it; ``written`` says that the table is read from files already.

    A shuffle join would send all rows of a key to one task. Here hot keys, whose number is bounded by
    ``HOT_KEYS`` whatever the size of the data, get their values by broadcast; their rows pass the
    shuffle join that serves the other keys under a salted key, evenly spread and without a match.
    """
    keys = [key] if isinstance(key, str) else list(key)
    table = table if written else durable(table)
    width = _width(table)
    entries, total, most, size = table.agg(F.count(F.lit(1)), F.sum(count), F.max(count), F.sum(width)).first()
    if entries <= BROADCAST_KEYS and (size or 0) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(table), keys)
    if most * HOT_KEYS <= total:
        return rows.join(table, keys)
    hot_size = table.where(F.col(count) * HOT_KEYS > total).agg(F.sum(width)).first()[0]
    if (hot_size or 0) > BROADCAST_BYTES:
        # long keys or values: Spark's own handling of skewed joins has to do
        return rows.join(table, keys)
    values = [c for c in table.columns if c not in keys]
    hot = table.where(F.col(count) * HOT_KEYS > total).select(*keys, *[F.col(c).alias(f"_hot_{c}") for c in values])
    cold = table.where(F.col(count) * HOT_KEYS <= total).withColumn("_salt", F.lit(0).cast("long"))
    spread = F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 20)) + F.lit(1)
    tagged = rows.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt", F.when(F.col(f"_hot_{count}").isNull(), F.lit(0)).otherwise(spread).cast("long")
    )
    return (
        tagged.join(cold, [*keys, "_salt"], "left")
        .select(*rows.columns, *[F.coalesce(F.col(f"_hot_{c}"), F.col(c)).alias(c) for c in values])
        .where(F.col(count).isNotNull())
    )
