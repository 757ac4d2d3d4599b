import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tastegraph.operators import evaluate, labels, onehash, setjoin, tiles
from tastegraph.plans import lookup as lookups
from tastegraph.sources import readers, writers


def dense(cells, size_r, size_c):
    rows = {k: n for n, k in enumerate(sorted({r for r, *_ in cells}))}
    columns = {k: n for n, k in enumerate(sorted({c for _, c, _ in cells}))}
    out = {}
    for r, c, v in cells:
        y, x = rows[r], columns[c]
        tile = out.setdefault((y // size_r, x // size_c), [0.0] * (size_r * size_c))
        at = y % size_r * size_c + x % size_c
        tile[at] = max(tile[at], v or 0.0)
    return out


@pytest.mark.parametrize("shape", [(4, 8), (16, 3), (64, 64)])
def test_tiles_match_dense_vectors(spark, shape):
    rng = random.Random(6)
    cells = {(f"i{rng.randrange(45)}", rng.randrange(70) * 10**10, float(rng.randint(1, 5))) for _ in range(600)}
    cells |= {("i7", u * 10**10, 2.0) for u in range(70)}  # one item that everybody rated
    cells = sorted(cells) + [("i7", 0, None)]
    frame = spark.createDataFrame([*cells, (None, 5, 1.0), ("i1", None, 1.0)], "item string, user long, rating double")
    frame = frame.where("item is not null and user is not null").unionByName(frame.where("item is null and user is null"))
    found = tiles.dense_tiles(frame, tile_rows=shape[0], tile_columns=shape[1])
    got = {(r.row_tile, r.column_tile): list(r["values"]) for r in found.collect()}
    assert got == dense(cells, *shape)
    assert {len(v) for v in got.values()} == {shape[0] * shape[1]}
    held = {(r.row, r.column): r.value for r in tiles.tile_cells(found, *shape).collect()}
    rows = {r.label: r.number for r in labels.label_numbers(frame, "item").collect()}
    columns = {r.label: r.number for r in labels.label_numbers(frame, "user").collect()}
    want = {}
    for i, u, v in cells:
        want[rows[i], columns[u]] = max(want.get((rows[i], columns[u]), 0.0), v or 0.0)
    assert held == want


def test_tiles_on_given_axes(spark):
    frame = spark.createDataFrame([(1, 1, 5.0), (2, 3, 4.0), (None, 1, 3.0), (1, None, 3.0)], "item int, user int, rating double")
    axis = spark.createDataFrame([(1,), (2,), (3,)], "x int")
    numbers = labels.label_numbers(axis, "x")
    found = tiles.dense_tiles(frame, tile_rows=2, tile_columns=2, row_numbers=numbers, column_numbers=numbers)
    got = {(r.row_tile, r.column_tile): list(r["values"]) for r in found.collect()}
    assert got == {(0, 0): [5.0, 0.0, 0.0, 0.0], (0, 1): [0.0, 0.0, 4.0, 0.0]}
    assert tiles.dense_tiles(frame.limit(0)).count() == 0


def code(x):
    return int(hashlib.md5(str(x).encode()).hexdigest()[:12], 16)


def brute_signature(elements, bins):
    held = {}
    for x in elements:
        bin_, value = code(x) % bins, code(x) // bins
        held[bin_] = min(value, held.get(bin_, value))
    out = []
    for n in range(bins):
        away = next(d for d in range(bins) if (n + d) % bins in held)
        out.append(held[(n + away) % bins] + away * ((1 << 48) // bins + 1))
    return out


@pytest.mark.parametrize("bins", [1, 7, 165])
def test_one_hash_signatures_match_brute_force(spark, bins):
    rng = random.Random(1)
    sets = {i: rng.sample(range(3000), rng.choice([1, 2, 5, 40, 900])) for i in range(40)}
    rows = [(i, x) for i, own in sets.items() for x in own] + [(3, sets[3][0]), (99, None)]
    frame = spark.createDataFrame(rows, "id long, element long")
    got = {r.id: list(r.signature) for r in onehash.one_hash_signatures(frame, bins).collect()}
    assert got == {i: brute_signature(own, bins) for i, own in sets.items()}


def test_agreement_of_bins_is_the_similarity():
    rng = random.Random(2)
    for size in (8, 200):
        agree = []
        for _ in range(300):
            pool = rng.sample(range(10**6), size + size // 4)
            one, two = (brute_signature(own, 64) for own in (pool[:size], pool[size // 4 :]))
            agree.append(sum(a == b for a, b in zip(one, two, strict=True)) / 64)
        assert abs(sum(agree) / len(agree) - 0.6) < 0.03


def test_one_hash_join_finds_nearly_all_and_nothing_else(spark):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        base = rng.sample(range(4000), 40)
        for j in range(4):
            own = set(base[: 40 - rng.randint(0, 8)]) | set(rng.sample(range(4000), rng.randint(0, 5)))
            rows += [(i * 10 + j, x) for x in own]
    rows += [(5000 + k, x) for k in range(30) for x in range(25)] + [(None, 3), (6000, None)]
    frame = spark.createDataFrame(rows, "id long, x long")
    exact = {(r.a, r.b): r.similarity for r in setjoin.jaccard_join(frame, "id", "x", 0.6).collect()}
    found = {(r.a, r.b): r.similarity for r in onehash.jaccard_one_hash_join(frame, "id", "x", 0.6).collect()}
    assert len(exact) > 500 and found.items() <= exact.items() and len(found) >= 0.93 * len(exact)


def test_report_of_the_rows_written(spark, train, test_pairs, tmp_path):
    rng = random.Random(4)
    predicted = [(u, i, 5 * rng.random()) for u in range(60) for i in range(20)]
    truth = [(u, i, float(rng.randint(1, 5))) for u, i, _ in predicted if (u + i) % 3] + [(900, 900, 1.0)]
    predictions = spark.createDataFrame(predicted, "user long, item long, prediction double").repartition(6)
    rated = spark.createDataFrame(truth, "user long, item long, rating double")
    report = writers.write_evaluated(predictions, rated.unionAll(rated), str(tmp_path / "out"))
    got = {r.metric: r.value for r in report.collect()}
    want = {r.metric: r.value for r in evaluate.rating_quality(predictions, rated).collect()}
    assert got == pytest.approx(want) and got["pairs"] == len(truth) - 1
    lines = "".join(f.read_text() for f in sorted((tmp_path / "out").glob("part-*"))).split()
    assert [tuple(map(int, line.split(",")[:2])) for line in lines] == [p[:2] for p in predicted]
    nothing = writers.write_evaluated(predictions.limit(0), rated, str(tmp_path / "none"))
    values = {r.metric: r.value for r in nothing.collect()}
    assert values["pairs"] == 0 and values["rmse"] is None and values["error_2"] == 0


def test_json_is_read_by_name(spark, train, tmp_path):
    train.select("rating", "user", "item").write.json(str(tmp_path / "json"))
    rows = sorted(map(tuple, readers.read_ratings(spark, str(tmp_path / "json"), "json").collect()))
    assert rows == sorted(map(tuple, train.collect()))
    pairs = readers.read_interactions(spark, str(tmp_path / "json"), "json")
    assert sorted(map(tuple, pairs.collect())) == [r[:2] for r in rows]


@pytest.mark.parametrize("most", [1000, 1 << 24])
def test_lookup_by_long_text_keys(spark, monkeypatch, most):
    monkeypatch.setattr(lookups, "BROADCAST_BYTES", most)
    monkeypatch.setattr(lookups, "HOT_KEYS", 4)
    rows = spark.range(400).select(F.when(F.col("id") < 150, "h" * 900).otherwise(F.col("id").cast("string")).alias("k"), "id")
    table = rows.groupBy("k").agg(F.count(F.lit(1)).alias("uses"), F.min("id").alias("least"))
    plan = lookups.lookup(rows, table, "k", "uses")
    assert sorted((r.id, r.least) for r in plan.collect()) == [(i, 0 if i < 150 else i) for i in range(400)]


def test_tiles_are_filled_by_gaps_and_not_cell_by_cell(spark):
    """Before, each cell of a tile was looked up in a map."""
    rows = [(r, c, float(r + c)) for r in range(7) for c in range(9) if (r * c) % 5 == 1] + [(0, 0, None), (6, 8, 2.0), (6, 8, 1.0)]
    found = tiles.dense_tiles(spark.createDataFrame(rows, "item long, user long, rating double"), tile_rows=2, tile_columns=3)
    assert "map_from_entries" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.row_tile, r.column_tile): list(r["values"]) for r in found.collect()} == dense(rows, 2, 3)
