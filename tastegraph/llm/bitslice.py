"""Exact top-k inner products on a bit-sliced index.

Vectors are quantised to integers and stored in blocks of rows, attribute by attribute and bit by bit: slice
``i`` of an attribute is a bitmap of the rows whose value there has bit ``i`` set (values are stored less the
block's minimum of the attribute; a negative query weight uses the complement). The scores of all rows of a
block are added up as bitmaps with carry-save adders: weight ``q`` adds each slice once for each bit set in
``|q|``. The k best rows are then selected from the most significant slice of the sum downward; rows that are
still tied after the last slice have equal scores, and the boundary is resolved by the smaller id.

Plan: the index is one table of blocks, written once. The query set of each block meets every block by an
equi-join on the block number, so a unit of work is one query set against one block of bounded size. Each
unit returns at most k rows per query; a window ranks them.

Edge cases: vectors that are null, empty or hold a null, NaN or infinite component take no part, nor do rows
without an id; vectors meet only vectors of their length; equal vectors and repeated ids are rows of their
own (a query meets every row but itself); other columns are ignored; an empty table gives an empty result.
Scores must fit in 64 bits.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastegraph.plans.durable import durable

SCALE = 1024
TOP = 10
BLOCK_ROWS = 16384

BLOCKS = (
    T.StructType()
    .add("block", T.LongType())
    .add("dims", T.LongType())
    .add("bits", T.LongType())
    .add("first", T.LongType())
    .add("ids", T.BinaryType())
    .add("low", T.BinaryType())
    .add("slices", T.BinaryType())
    .add("asked", T.BinaryType())
)
FOUND = (
    T.StructType()
    .add("query_row", T.LongType())
    .add("query_id", T.LongType())
    .add("vec_id", T.LongType())
    .add("score", T.LongType())
)


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of each component; null where the vector takes no part."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = vector.isNotNull() & (F.size(vector) > 0) & ~bad
    return F.when(usable, F.transform(wide, lambda x: F.floor(x * F.lit(scale)).cast("long")))


def slice_block(values: np.ndarray) -> tuple[np.ndarray, int, np.ndarray]:
    """``(low, bits, slices[attribute, bit, word])`` of a block of rows of integers."""
    rows, dims = values.shape
    low = values.min(axis=0)
    rest = (values - low).astype(np.uint64)
    bits = max(1, int(rest.max()).bit_length())
    words = -(-rows // 64)
    slices = np.zeros((dims, bits, words * 8), np.uint8)
    for bit in range(bits):
        packed = np.packbits(((rest >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8).T, axis=1, bitorder="little")
        slices[:, bit, : packed.shape[1]] = packed
    return low, bits, slices.view(np.uint64)


def bitmap(rows: int) -> np.ndarray:
    """All of the first ``rows`` bits set."""
    out = np.zeros(-(-rows // 64) * 8, np.uint8)
    out[: -(-rows // 8)] = np.packbits(np.ones(rows, np.uint8), bitorder="little")
    return out.view(np.uint64)


def weighted_sum(slices: np.ndarray, inverse: np.ndarray, weights: list[int]) -> list[np.ndarray]:
    """Slices, least significant first, of the sum of weighted attributes; negative weights take the complement."""
    columns: dict[int, list[np.ndarray]] = defaultdict(list)
    for attribute, weight in enumerate(weights):
        planes, size = (slices if weight > 0 else inverse)[attribute], abs(weight)
        for shift in range(size.bit_length()):
            if size >> shift & 1:
                for bit, plane in enumerate(planes):
                    columns[shift + bit].append(plane)
    out: list[np.ndarray] = []
    while columns:
        place = len(out)
        column, carries = columns.pop(place, []), columns[place + 1]
        while len(column) > 2:
            a, b, c = column.pop(), column.pop(), column.pop()
            half = a ^ b
            column.append(half ^ c)
            carries.append((a & b) | (half & c))
        if len(column) == 2:
            a, b = column.pop(), column.pop()
            column.append(a ^ b)
            carries.append(a & b)
        out.append(column[0] if column else np.zeros_like(slices[0, 0]))
        if not carries:
            del columns[place + 1]
    return out


def members(bits: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bits.view(np.uint8), bitorder="little"))


def best_rows(total: list[np.ndarray], allowed: np.ndarray, k: int) -> np.ndarray:
    """The k rows with the highest sums, from the most significant slice downward; ties to lower rows."""
    sure, tied = np.zeros_like(allowed), allowed.copy()
    for plane in reversed(total):
        higher = sure | (tied & plane)
        size = int(np.bitwise_count(higher).sum())
        if size > k:
            tied &= plane
        else:
            sure = higher
            tied &= ~plane
            if size == k:
                return members(sure)
    have = members(sure)
    return np.concatenate([have, members(tied)[: k - len(have)]])


def block_answers(block: dict, asked: np.ndarray, k: int) -> Iterator[tuple[int, int, int, int]]:
    """``(query_row, query_id, vec_id, score)``: the best rows of one block for each query asked."""
    ids = np.frombuffer(block["ids"], np.int64)
    low = np.frombuffer(block["low"], np.int64).tolist()
    slices = np.frombuffer(block["slices"], np.uint64).reshape(block["dims"], block["bits"], -1)
    inverse, full, first = ~slices, bitmap(len(ids)), block["first"]
    for row, query, *weights in asked.tolist():
        allowed = full
        if 0 <= row - first < len(ids):
            allowed = full.copy()
            allowed[(row - first) // 64] &= ~(np.uint64(1) << np.uint64((row - first) % 64))
        total = weighted_sum(slices, inverse, weights)
        top = (1 << block["bits"]) - 1
        base = sum(w * v for w, v in zip(weights, low, strict=True)) + sum(w * top for w in weights if w < 0)
        for slot in best_rows(total, allowed, k).tolist():
            at, place = divmod(slot, 64)
            score = sum((int(plane[at]) >> place & 1) << t for t, plane in enumerate(total))
            yield row, query, int(ids[slot]), base + score


def build_index(vectors: DataFrame, is_query: Column, vec_id: str, vector: str, scale: int, block_rows: int) -> DataFrame:
    """One row per block, written to the shared folder; ``asked`` holds the block's own queries."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        number = TaskContext.get().partitionId()
        first = number << 32
        for dims in sorted({len(r[1]) for r in rows}):
            own = sorted(r for r in rows if len(r[1]) == dims)
            values = np.array([r[1] for r in own], np.int64)
            low, bits, slices = slice_block(values)
            asked = [[first + n, r[0], *r[1]] for n, r in enumerate(own) if r[2]]
            parts = [np.array([r[0] for r in own], np.int64), low, slices, np.array(asked, np.int64)]
            ids, low, slices, asked = (pa.array([p.tobytes()], pa.binary()) for p in parts)
            numbers = [pa.array([n], pa.int64()) for n in (number, dims, bits, first)]
            yield pa.RecordBatch.from_arrays([*numbers, ids, low, slices, asked], names=BLOCKS.names)
            first += len(own)

    usable = vectors.select(
        vectors[vec_id].cast("long").alias("id"), quantised(vectors[vector], scale).alias("v"), is_query.alias("q")
    ).where(F.col("id").isNotNull() & F.col("v").isNotNull())
    count = max(1, -(-usable.count() // block_rows))
    return durable(usable.repartition(count).mapInArrow(blocks, BLOCKS))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = TOP,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k rows with the highest products for each row that is a query."""

    def answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                block = {n: batch.column(n)[at].as_py() for n in batch.schema.names}
                asked = np.frombuffer(block["theirs"], np.int64).reshape(-1, block["dims"] + 2)
                found = list(zip(*block_answers(block, asked, k), strict=True)) or [[]] * len(FOUND)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=FOUND.names)

    index = build_index(vectors, is_query, vec_id, vector, scale, block_rows)
    last = index.agg(F.max("block")).first()[0] or 0
    sets = index.where(F.length("asked") > 0).select(
        "dims", F.col("asked").alias("theirs"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long"))).alias("block")
    )
    met = index.drop("asked").join(sets, ["block", "dims"])
    ranked = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    return (
        met.mapInArrow(answers, FOUND)
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
