import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastegraph.llm import bitslice
from tastegraph.llm.queries import op3_bitslice


def brute(rows, is_query, k=10):
    usable = [
        (i, [math.floor(1024 * x) for x in v])
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, (i, q) in enumerate(usable):
        if is_query(i):
            scored = sorted(
                (-sum(a * b for a, b in zip(q, v)), j) for m, (j, v) in enumerate(usable) if m != n and len(v) == len(q)
            )
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def cases(count, dims, seed):
    rng = random.Random(seed)
    rows = [(i, [float(np.float32(rng.gauss(0, 0.3))) for _ in range(dims)]) for i in range(count)]
    rows += [(1000 + i, rows[100][1]) for i in range(30)]  # copies: ties at every boundary
    rows += [(100, rows[100][1]), (None, rows[3][1]), (2000, None), (2100, []), (2200, [None] * dims)]
    rows += [(2300, [float("nan")] * dims), (2400, [float("inf")] + [0.0] * (dims - 1)), (2500, [1.0]), (2600, [0.5])]
    rows += [(2700, [0.0] * dims), (-100, [-0.3] * dims)]
    return rows


@pytest.mark.parametrize("block_rows", [40, 16384])
def test_equals_brute_force(spark, block_rows):
    rows = cases(330, 7, 1)
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = bitslice.top_k(frame, F.col("vec_id") % 20 == 0, block_rows=block_rows).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, lambda i: i % 20 == 0)


def test_sums_of_slices():
    rng = np.random.default_rng(0)
    values = rng.integers(-700, 700, (200, 9))
    low, bits, slices = bitslice.slice_block(values)
    for weights in ([5, -3, 0, 1, -1, 600, -600, 7, 2], [0] * 9):
        total = bitslice.weighted_sum(slices, ~slices, weights)
        want = values @ np.array(weights)
        base = sum(w * v for w, v in zip(weights, low.tolist())) + sum(w * (2**bits - 1) for w in weights if w < 0)
        for slot in range(200):
            assert base + sum((int(p[slot // 64]) >> slot % 64 & 1) << t for t, p in enumerate(total)) == want[slot]
        for k in (1, 10, 200, 300):
            rows = bitslice.best_rows(total, bitslice.bitmap(200), k)
            assert sorted(rows.tolist()) == sorted(np.lexsort((np.arange(200), -want))[:k].tolist())


def test_small_and_empty_tables(spark):
    frame = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.5, 0.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in bitslice.top_k(frame, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 1024 * 512)]
    assert bitslice.top_k(frame.limit(0), F.col("vec_id") == 0).count() == 0
    assert bitslice.top_k(frame, F.col("vec_id") == 7).count() == 0


def test_query(spark, tmp_path):
    rows = cases(320, 5, 2)
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = op3_bitslice(spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, lambda i: i % 100 == 0)
