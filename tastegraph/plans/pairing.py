"""Pairs within groups, in blocks of bounded size.

A plain equi-self-join hands all pairs of one key to one task. Here a key with more than
``block_rows`` members is cut into blocks, and each pair of blocks is a join key of its own, so one
key that holds a third of all rows spreads over the cluster and no join group exceeds
``2 * block_rows`` rows. Every pair still appears exactly once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegraph.plans.lookup import lookup

BLOCK_ROWS = 2048


def _blocks(rows: Column, block_rows: int) -> Column:
    return F.ceil(rows / F.lit(float(block_rows))).cast("int")


def pairs_within(
    df: DataFrame,
    keys: list[str],
    member: str,
    carry: list[str] = (),
    keep: Callable[[Callable[[str], Column], Callable[[str], Column]], Column] | None = None,
    block_rows: int = BLOCK_ROWS,
    size: str | None = None,
) -> DataFrame:
    """Unordered pairs of ``member`` inside each key group.

    Returns ``keys``, ``a_<member>``, ``b_<member>`` (a < b) and ``a_``/``b_`` of each carried column.
    ``keep(left, right)`` is a symmetric condition on the two rows. ``size`` names a column that
    already holds the group's size; otherwise the sizes are counted (with map-side combine).
    """
    if size is None:
        size = "_rows"
        counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(size)).where(F.col(size) > 1)
        df = lookup(df, counted, keys, size)
    columns = [member, *[c for c in carry if c != member]]
    own = F.pmod(F.xxhash64(F.col(member)), _blocks(F.col(size), block_rows)).cast("int")
    split = df.select(*keys, *columns, own.alias("_own"), _blocks(F.col(size), block_rows).alias("_blocks"))
    # A row goes once to each pair of blocks that its own is one of. Both sides are this frame, so it is shuffled once.
    dealt = split.select(
        *keys, *columns, "_own", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other")
    ).select(
        *keys, *columns, "_own", F.least("_own", "_other").alias("_p"), F.greatest("_own", "_other").alias("_q")
    )

    def side(prefix: str) -> DataFrame:
        return dealt.select(
            *keys, *[F.col(c).alias(f"{prefix}_{c}") for c in columns], F.col("_own").alias(f"_{prefix}"), "_p", "_q"
        )

    met = side("l").join(side("r"), [*keys, "_p", "_q"])
    ordered = F.col(f"l_{member}") < F.col(f"r_{member}")
    # as one expression: a condition on one side alone would be moved below the shuffle, which then is not the same
    met = met.where(F.when(F.col("_p") == F.col("_q"), ordered).otherwise(F.col("_l") < F.col("_r")))
    if keep is not None:
        met = met.where(keep(lambda c: F.col(f"l_{c}"), lambda c: F.col(f"r_{c}")))
    return _named(met, keys, columns, member)


def _named(met: DataFrame, keys: list[str], columns: list[str], member: str) -> DataFrame:
    """Sides ``l_`` and ``r_`` as ``a_`` and ``b_``, the smaller member first."""
    ordered = F.col(f"l_{member}") < F.col(f"r_{member}")
    return met.select(
        *keys,
        *[F.when(ordered, F.col(f"l_{c}")).otherwise(F.col(f"r_{c}")).alias(f"a_{c}") for c in columns],
        *[F.when(ordered, F.col(f"r_{c}")).otherwise(F.col(f"l_{c}")).alias(f"b_{c}") for c in columns],
    )


def pairs_across(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    member: str,
    carry: list[str],
    sizes: tuple[str, str],
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Pairs of a row of ``left`` with a row of ``right`` of the same key; no member is on both sides of a key.

    ``sizes`` names two columns that both frames have: how many rows of the key are in ``left`` and in ``right``.
    Rows whose key has none on the other side are left out before anything is copied, and a row is copied once
    for each block of the other side only. The result is named as that of ``pairs_within``.
    """
    columns = [member, *[c for c in carry if c != member]]
    on_left, on_right = sizes

    def side(frame: DataFrame, prefix: str, mine: str, other: str, own: str, copied: str) -> DataFrame:
        blocks = _blocks(F.col(other), block_rows)
        return frame.where((F.col(mine) > 0) & (F.col(other) > 0)).select(
            *keys,
            *[F.col(c).alias(f"{prefix}_{c}") for c in columns],
            F.pmod(F.xxhash64(F.col(member)), _blocks(F.col(mine), block_rows)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), blocks - 1)).alias(copied),
        )

    lefts = side(left, "l", on_left, on_right, "_p", "_q")
    rights = side(right, "r", on_right, on_left, "_q", "_p")
    return _named(lefts.join(rights, [*keys, "_p", "_q"]), keys, columns, member)


def pairs_between(
    left: DataFrame, right: DataFrame, key: str, condition: Column, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Join two frames on a coarse key of at most 64 values, both sides cut into blocks.

    Meant for range conditions turned into an equi-join on a range number: ``condition`` decides
    inside the range. The other columns of both frames must have different names.
    """
    sizes = (
        left.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_l"))
        .join(right.groupBy(key).agg(F.count(F.lit(1)).alias("_r")), key)
        .select(key, _blocks(F.col("_l"), block_rows).alias("_lb"), _blocks(F.col("_r"), block_rows).alias("_rb"))
    )
    # One row per key value, so at most 64 rows by the contract above.
    grid = F.broadcast(sizes)
    own = [F.col(c) for c in left.columns if c != key]
    lefts = left.join(grid, key).select(
        key,
        *own,
        F.pmod(F.xxhash64(*own), F.col("_lb")).cast("int").alias("_p"),
        F.explode(F.sequence(F.lit(0), F.col("_rb") - 1)).alias("_q"),
    )
    other = [F.col(c) for c in right.columns if c != key]
    rights = right.join(grid, key).select(
        key,
        *other,
        F.explode(F.sequence(F.lit(0), F.col("_lb") - 1)).alias("_p"),
        F.pmod(F.xxhash64(*other), F.col("_rb")).cast("int").alias("_q"),
    )
    return lefts.join(rights, [key, "_p", "_q"]).where(condition).drop(key, "_p", "_q")


def mirrored(pairs: DataFrame, weight: str = "similarity") -> DataFrame:
    """Both directions of each pair as ``(id, neighbor, weight)`` rows, in one pass over the pairs."""
    return pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("a").alias("id"), F.col("b").alias("neighbor"), F.col(weight).alias("weight")),
                F.struct(F.col("b").alias("id"), F.col("a").alias("neighbor"), F.col(weight).alias("weight")),
            )
        )
    )
