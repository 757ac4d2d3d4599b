"""Shards of bounded size by extendible hashing.

Each row has a hash of its key. A directory maps hash prefixes to buckets: it starts with one bucket of depth 0, and as
long as a bucket holds more than ``limit`` bytes it alone is split on its next bit. Buckets end at different depths, no
bucket that fits is touched, and a bucket's name is its prefix.

The directory is worked out on sums of bytes per hash prefix of ``CELL_BITS`` bits (partial aggregation: at most one
row per cell and task is shuffled, whatever the key skew), and only cells that are still too large go on to the next
``CELL_BITS`` bits. Rows then find their bucket by their cell. Rows that hash alone cannot part (copies of one key; a
bucket at full depth) are cut into pages: running sums over ranges of bounded byte size, which a second hash spreads.
A single row above the limit is a shard of its own.

Edge cases: a null text counts 0 bytes of text; a null key is a key like any other; equal rows are counted one by one;
an empty table has no shards; other columns, also ones named like those added here, travel with ``write_shards``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.plans.durable import durable

# Bytes of text per shard, and bytes counted for each row besides its text.
LIMIT = 32 << 20
ROW_BYTES = 16
CELL_BITS = 12
FULL_DEPTH = 64


def prefix(value: str, size: int, depth: int):
    """The first ``depth`` of the ``size`` bits of a number."""
    if depth == 0:
        return F.lit(0).cast("long")
    return F.shiftrightunsigned(F.col(value), size - depth)


def sized(docs: DataFrame, key: Column, text: str) -> DataFrame:
    """All columns as ``row``, the hash ``_h`` of the key and the size ``_bytes`` of each row."""
    size = F.coalesce(F.octet_length(docs[text]), F.lit(0)).cast("long") + F.lit(ROW_BYTES)
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.xxhash64(key).alias("_h"), size.alias("_bytes"))


def split_cells(cells: DataFrame, start: int, stop: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """``(cell, bytes, depth)`` of prefixes of ``stop`` bits, all in buckets of depth ``start`` → cells with the depth at which
    their bucket fits the limit, and cells that are too large at depth ``stop``."""
    done = None
    for depth in range(start, stop + 1):
        held = cells.withColumn("_bucket", prefix("cell", stop, depth))
        sums = held.groupBy("_bucket").agg(F.sum("bytes").alias("_total"))
        held = held.join(sums, "_bucket")
        fits = held.where(F.col("_total") <= limit).select("cell", "bytes", F.lit(depth).alias("depth"), "_total")
        done = fits if done is None else done.unionByName(fits)
        cells = durable(held.where(F.col("_total") > limit).select("cell", "bytes"))
        if cells.isEmpty():
            break
    return durable(done), cells


def directory(rows: DataFrame, limit: int = LIMIT, cell_bits: int = CELL_BITS) -> list[tuple[int, DataFrame]]:
    """For prefixes of ``cell_bits``, twice as many bits and so on, as far as needed: ``(cell, depth, shard_bytes)`` of the
    buckets that end within these bits. The last level also holds the buckets that no bit can part."""
    levels: list[tuple[int, DataFrame]] = []
    left = durable(rows.select("_h", "_bytes"))
    for bits in [*range(cell_bits, FULL_DEPTH, cell_bits), FULL_DEPTH]:
        cell = prefix("_h", FULL_DEPTH, bits)
        cells = durable(left.groupBy(cell.alias("cell")).agg(F.sum("_bytes").alias("bytes")))
        done, large = split_cells(cells, levels[-1][0] + 1 if levels else 0, bits, limit)
        if bits == FULL_DEPTH:
            done = done.unionByName(large.select("cell", "bytes", F.lit(bits).alias("depth"), F.col("bytes").alias("_total")))
        levels.append((bits, done.select("cell", "depth", F.col("_total").alias("shard_bytes"))))
        if large.isEmpty():
            break
        left = left.join(large.select(F.col("cell").alias("_large")), cell == F.col("_large"), "left_semi")
    return levels


def bucket_name(h: str, depth: str) -> Column:
    """The prefix in bits, ``-`` for the empty one."""
    bits = F.lpad(F.bin(h), FULL_DEPTH, "0")
    return F.when(F.col(depth) == 0, F.lit("-")).otherwise(F.substring(bits, F.lit(1), F.col(depth)))


def assigned(rows: DataFrame, limit: int = LIMIT, cell_bits: int = CELL_BITS) -> DataFrame:
    """The rows with ``shard`` (prefix, and page where copies of one key exceed the limit), ``depth`` and ``shard_bytes``."""
    found = None
    for bits, cells in directory(rows, limit, cell_bits):
        match = prefix("_h", FULL_DEPTH, bits) == F.col("cell")
        own = rows.join(cells, match).drop("cell")
        found = own if found is None else found.unionByName(own)
    found = found.withColumn("shard", bucket_name("_h", "depth"))
    stuck = (F.col("shard_bytes") > limit) & (F.col("depth") == FULL_DEPTH)
    over = durable(found.where(stuck).select("_h").distinct())
    if over.isEmpty():
        return found
    whole = found.where(~stuck)
    # Rows of one hash value are dealt to parts of about half the limit. Inside a part a page takes the rows whose running
    # sum starts in the same half of the limit, and a row above that half stands alone; so no page exceeds the limit.
    numbered = durable(found.where(stuck).withColumn("_number", F.monotonically_increasing_id()))
    parts = F.ceil(F.col("shard_bytes") * 2 / F.lit(limit)).cast("long")
    dealt = numbered.withColumn("_deal", F.pmod(F.xxhash64("_number"), parts))
    half = max(1, limit // 2)
    small = F.when(F.col("_bytes") <= half, F.col("_bytes")).otherwise(0)
    running = Window.partitionBy("_h", "_deal").orderBy("_number").rowsBetween(Window.unboundedPreceding, -1)
    page = F.floor(F.coalesce(F.sum(small).over(running), F.lit(0)) / F.lit(half)).cast("string")
    page = F.when(F.col("_bytes") <= half, page).otherwise(F.concat(F.lit("r"), F.col("_number")))
    named = dealt.withColumn("shard", F.concat_ws(".", "shard", "_deal", page))
    total = named.groupBy("shard").agg(F.sum("_bytes").alias("shard_bytes"))
    return whole.unionByName(named.drop("shard_bytes").join(total, "shard").select(*whole.columns))


def shards(docs: DataFrame, key: Column, text: str = "text", limit: int = LIMIT, cell_bits: int = CELL_BITS) -> DataFrame:
    """``(row, shard, depth, row_bytes, shard_bytes)``: each row, as a struct, with its shard."""
    found = assigned(sized(docs, key, text), limit, cell_bits)
    return found.select("row", "shard", "depth", F.col("_bytes").alias("row_bytes"), "shard_bytes")


def write_shards(docs: DataFrame, path: str, key: Column, text: str = "text", limit: int = LIMIT) -> None:
    """Write each shard to a folder ``shard=<prefix>`` of its own, all columns of the rows in ``row``."""
    found = shards(docs, key, text, limit)
    found.select("row", "shard").repartition(F.col("shard")).write.partitionBy("shard").parquet(path)
