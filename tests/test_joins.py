import itertools
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from tastegraph.functions.hashing import SMALL_PRIME, _next_ints, affine_hash, hash_params, projection_signs
from tastegraph.operators import lsh, setjoin
from tastegraph.operators.evaluate import pair_quality
from tastegraph.operators.ratings import distinct_count, interactions
from tastegraph.operators.setjoin import cosine_join, jaccard_join
from tastegraph.plans import copies, durable
from tastegraph.plans.pairing import pairs_between, pairs_within


def scores(df):
    rows = df.collect()
    out = {(r.a, r.b): round(r.similarity, 6) for r in rows}
    assert len(out) == len(rows), "a pair came out twice"
    assert all(a < b for a, b in out)
    return out


def brute(sets, measure, threshold):
    out = {}
    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        down = len(sets[a] | sets[b]) if measure == "jaccard" else math.sqrt(len(sets[a]) * len(sets[b]))
        if common and common / down >= threshold:
            out[a, b] = round(common / down, 6)
    return out


def skewed_sets(seed):
    """A third of all sets are copies of one set and one element is in nearly every set."""
    rng = random.Random(seed)
    sets = {n: frozenset([0, 1, 2, 3]) for n in range(30)}
    for n in range(30, 70):
        sets[n] = frozenset(rng.sample(range(1, 14), rng.randint(1, 8))) | {0}
    for n in range(70, 90):
        sets[n] = frozenset([0, 100 + n])
    sets[90] = frozenset(range(14))
    return sets


def frame(spark, sets):
    rows = [(n, e) for n, s in sets.items() for e in s]
    return spark.createDataFrame(rows + rows[:7], "id long, element long")


@pytest.mark.parametrize("measure,join", [("jaccard", jaccard_join), ("cosine", cosine_join)])
@pytest.mark.parametrize("threshold", [0.2, 0.5, 1.0])
def test_exact_join_matches_brute_force(spark, measure, join, threshold):
    sets = skewed_sets(5)
    got = scores(join(frame(spark, sets), "id", "element", threshold, block_rows=9))
    assert got == brute(sets, measure, threshold)


def test_micro_items(train):
    rows = interactions(train)
    jaccard = scores(jaccard_join(rows, "id", "element", 0.5))
    assert jaccard == {
        (10, 11): 0.75, (11, 12): 0.75, (11, 13): 0.75, (10, 12): 0.5, (10, 13): 0.5, (12, 13): 0.5,
    }
    cosine = scores(cosine_join(rows, "id", "element", 0.47))
    assert cosine[10, 11] == 0.866025 and cosine[10, 12] == 0.666667 and len(cosine) == 6


def test_hash_params():
    assert _next_ints(0, 1) == [-1155484576] and _next_ints(42, 1) == [-1170105035]
    params = {n: (a, b) for n, a, b in hash_params(165)}
    assert params[0] == (5424, 4600) and params[1] == (675, 19176) and params[2] == (4921, 12744)
    assert params[5] == (1679, 10184) and params[164] == (2322, 16012)


def test_params_table(spark):
    table = lsh.params_frame(spark, 3)
    assert [tuple(r) for r in table.orderBy("n").collect()] == hash_params(3)


def test_micro_signatures(train):
    sets = interactions(train)
    bands = lsh.minhash_bands(sets, bands=2, prime=SMALL_PRIME, code=None, universe=distinct_count(train, "user"))
    got = {r.id: r.signature for r in lsh.signatures(bands).collect()}
    assert got == {
        10: [0, 0, 1, 0, 0, 2, 0, 1, 1, 0],
        11: [0, 0, 1, 0, 0, 1, 0, 0, 1, 0],
        12: [0, 0, 2, 0, 0, 1, 2, 0, 1, 0],
        13: [1, 1, 1, 0, 1, 1, 0, 0, 1, 1],
    }
    long_form = {(r.id, r.n): r.h for r in lsh.signature_rows(bands).collect()}
    assert long_form[12, 6] == 2 and len(long_form) == 40
    pairs = lsh.minhash_candidates(sets, "id", "element", bands=2, prime=SMALL_PRIME, code=None, universe=distinct_count(train, "user"))
    assert [(r.a, r.b) for r in pairs.collect()] == [(10, 11)]


def test_hash_without_prime(spark):
    h = affine_hash(F.lit(7), F.lit(5424), F.lit(4600), None, F.lit(100))
    assert spark.range(1).select(h.alias("h")).first()["h"] == (7 * 5424 + 4600) % 100


@pytest.mark.parametrize("threshold", [0.5, 0.8])
def test_jaccard_lsh_within_exact(spark, threshold):
    sets = skewed_sets(6)
    df = frame(spark, sets)
    found = scores(lsh.jaccard_lsh_join(df, "id", "element", threshold, prime=SMALL_PRIME, block_rows=9))
    exact = brute(sets, "jaccard", threshold)
    assert found.items() <= exact.items()
    # the recall curve of 33 bands of 5 rows at each pair's own similarity
    expected = sum(1 - (1 - similarity**5) ** 33 for similarity in exact.values())
    assert len(found) > expected - 4 * math.sqrt(len(exact))


def test_cosine_lsh_within_exact(spark):
    sets = skewed_sets(7)
    found = scores(lsh.cosine_lsh_join(frame(spark, sets), "id", "element", 0.8, rows=6, block_rows=9))
    exact = brute(sets, "cosine", 0.8)
    assert found.items() <= exact.items()
    assert len(found) > 0.9 * len(exact)


def test_cosine_lsh_keeps_its_recall_however_many_sets(spark):
    rng = random.Random(11)
    rows = []
    for n in range(300):  # pairs of 28 common elements of 40: cosine 0.7
        common = [f"c{n}_{k}" for k in range(28)]
        rows += [(2 * n + side, e) for side in (0, 1) for e in common + [f"o{n}_{side}_{k}" for k in range(12)]]
    rows += [(1000 + n, f"r{rng.randrange(100000)}") for n in range(2500) for _ in range(12)]
    found = lsh.cosine_lsh_join(spark.createDataFrame(rows, "id long, element string"), "id", "element", 0.7)
    assert sum((r.b == r.a + 1 and r.a % 2 == 0 and r.a < 600) for r in found.collect()) >= 290


@pytest.mark.parametrize("threshold", [0.1, 0.47, 0.7, 0.95, 1.0])
@pytest.mark.parametrize("recall", [0.9, 0.99, 0.9999])
def test_shape_of_sign_bands_promises_the_recall(threshold, recall):
    rows, bands = lsh.sign_shape(threshold, recall)
    assert 1 - (1 - (1 - math.acos(threshold) / math.pi) ** rows) ** bands >= recall - 1e-12


def test_vector_join(spark):
    rng = random.Random(3)
    base = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(12)]
    rows = [(n, [x + rng.gauss(0, 0.02) for x in base[n % 12]]) for n in range(36)]
    rows += [(100 + n, rows[0][1]) for n in range(15)] + [(200, [0.0] * 8), (201, [1.0])]
    df = spark.createDataFrame(rows, "id long, vector array<double>")
    found = scores(lsh.cosine_join_vectors(df, "id", "vector", 8, 0.9, rows=6, block_rows=4))
    kept = {n: v for n, v in rows if n < 200}

    def cosine(x, y):
        return sum(p * q for p, q in zip(x, y)) / math.sqrt(sum(p * p for p in x) * sum(q * q for q in y))

    exact = {
        (a, b): round(cosine(kept[a], kept[b]), 6)
        for a, b in itertools.combinations(sorted(kept), 2)
        if cosine(kept[a], kept[b]) >= 0.9
    }
    assert found.items() <= exact.items() and len(found) > 0.95 * len(exact)


def test_projection_signs_are_balanced():
    signs = projection_signs(64, 150)
    assert abs(sum(map(sum, signs))) < 400


def test_pairs_within_blocks(spark):
    df = spark.createDataFrame([(n % 3 % 2, n) for n in range(60)], "key int, id long")
    got = pairs_within(df, ["key"], "id", block_rows=5).collect()
    keys = {n: n % 3 % 2 for n in range(60)}
    want = {(a, b) for a, b in itertools.combinations(range(60), 2) if keys[a] == keys[b]}
    assert len(got) == len(want) and {(r.a_id, r.b_id) for r in got} == want


def test_pairs_between_blocks(spark):
    left = spark.createDataFrame([(n % 2, n) for n in range(30)], "key int, x long")
    right = spark.createDataFrame([(n % 2, n) for n in range(25)], "key int, y long")
    got = pairs_between(left, right, "key", F.col("x") + F.col("y") > 20, block_rows=4).collect()
    want = {(x, y) for x in range(30) for y in range(25) if x % 2 == y % 2 and x + y > 20}
    assert len(got) == len(want) and {(r.x, r.y) for r in got} == want


def test_lsh_quality_against_exact(spark):
    df = frame(spark, skewed_sets(8))
    found = lsh.jaccard_lsh_join(df, "id", "element")
    row = pair_quality(found, jaccard_join(df, "id", "element")).first()
    # the recall curve of the default bands over these similarities
    assert row.precision == 1.0 and row.recall > 0.8


def test_minhash_agreement_is_the_similarity_on_numbers(spark):
    """The share of equal minima is near the Jaccard similarity, and not a matter of the smallest number."""
    rng = random.Random(21)
    rows, pairs = [], []
    for n in range(30):
        pool = rng.sample(range(1, 20000), 120)
        rows += [(2 * n, x) for x in pool[:100]] + [(2 * n + 1, x) for x in pool[20:]]
        pairs.append((2 * n, 2 * n + 1))
    bands = lsh.minhash_bands(spark.createDataFrame(rows, "id long, element long"))
    values = {(r.id, r.n): r.h for r in lsh.signature_rows(bands).collect()}
    count = lsh.BANDS * lsh.ROWS
    shares = [sum(values[a, n] == values[b, n] for n in range(count)) / count for a, b in pairs]
    assert abs(sum(shares) / len(shares) - 80 / 120) < 0.03
    assert all(0.4 < s < 0.9 for s in shares)


def test_second_fingerprint_does_not_follow_from_the_first(spark):
    one, two = copies.fingerprint(F.col("x"))
    first = spark.range(50).select(F.col("id").alias("x")).select("x", one, two)
    assert first.where(F.xxhash64(F.lit(7)) == F.col("_f2")).count() == 0
    chained = F.expr("xxhash64(x, 7)")
    assert first.where(chained == F.col("_f2")).count() == 0


def test_null_elements_and_unusable_vectors(spark):
    sets = spark.createDataFrame([(1, None), (1, "a"), (2, None), (2, "a"), (2, "b"), (None, "a")], "id long, element string")
    assert scores(setjoin.jaccard_join(sets, "id", "element", 0.3)) == {(1, 2): 0.5}
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, nan]), (2, [1.0, nan]), (3, [1.0, inf]), (4, [1.0, inf]), (5, [1.0, None]), (6, None), (7, [2.0, 1.0]), (8, [4.0, 2.0])]
    vectors = spark.createDataFrame(rows, "id long, v array<double>")
    assert set(scores(lsh.cosine_join_vectors(vectors, "id", "v", 2, 0.5, rows=2))) == {(7, 8)}
    assert lsh.cosine_join_vectors(vectors.limit(0), "id", "v", 2, 0.5).count() == 0


def test_scratch_deletes_what_was_written_inside(spark):
    with durable.scratch(spark):
        outer = durable.durable(spark.range(3))
        with durable.scratch(spark):
            inner = durable.durable(spark.range(5))
            path = durable._paths[-1]
            assert inner.count() == 5 and os.path.isdir(path.removeprefix("file:"))
        assert not os.path.isdir(path.removeprefix("file:"))
        assert outer.count() == 3


def test_sketches_never_differ_in_more_bits_than_the_sets(spark):
    rng = random.Random(31)
    sets = {n: frozenset(rng.sample(range(4000), rng.choice([1, 3, 60, 500, 3000]))) for n in range(24)}
    rows = setjoin.distinct_sets(frame(spark, sets), "id", "element")
    sketches = setjoin.sketched(rows, copies.set_copies(rows))
    lengths = {r.id: len(r.sketch) for r in sketches.collect()}
    assert set(lengths) == set(sets) and set(lengths.values()) == {16, 32, 256}
    one, two = (sketches.select(F.col("id").alias(i), F.col("sketch").alias(s), *[F.col(c).alias(f"{i}{c}") for c in ["n", *setjoin.SHORT]])
                for sketches in [sketches.select("*", *setjoin.short_sketch(F.col("sketch")))] for i, s in (("a", "x"), ("b", "y")))
    short = setjoin.short_apart(lambda c: F.col(f"a{c}"), lambda c: F.col(f"b{c}"))
    met = one.crossJoin(two).select("a", "b", short.alias("short"), setjoin._sketches_apart(F.col("x"), F.col("y")).alias("apart"))
    for r in met.collect():
        assert r.short <= r.apart <= len(sets[r.a] ^ sets[r.b]), (r.a, r.b)


@pytest.mark.parametrize("measure", [setjoin.Jaccard, setjoin.Cosine])
def test_pairs_far_below_the_threshold_meet_no_elements(spark, measure):
    """Sets of 40 that share 3 rare elements met element by element before."""
    sets = {n: frozenset(range(3)) | {1000 * (n + 1) + k for k in range(37)} | {900 + k + n % 2 for k in range(2)} for n in range(30)}
    sets[30] = sets[0] | {7}
    rows = durable.durable(setjoin.distinct_sets(frame(spark, sets), "id", "element"))
    sketches = setjoin.sketched(rows, durable.durable(copies.set_copies(rows)))
    met = setjoin.prefix_candidates(rows, sketches, measure, 0.5)
    assert [(r.a, r.b) for r in met.select("a", "b").collect()] == [(0, 30)]


@pytest.mark.parametrize("large_set", [0, 50, 10**6])
def test_bands_of_large_and_small_sets(spark, large_set):
    rng = random.Random(5)
    sets = {1: rng.sample(range(5000), 700), 2: rng.sample(range(5000), 30), 3: [4]}
    rows = frame(spark, sets).distinct()
    least = {
        (r.id, r.band, j): r[f"h{j}"]
        for r in lsh.minhash_bands(rows, 3, 2, SMALL_PRIME, code=None, large_set=large_set).collect() for j in range(2)
    }
    assert least == {
        (i, n // 2, n % 2): min((a * x + b) % SMALL_PRIME for x in held) for i, held in sets.items() for n, a, b in hash_params(6)
    }
    signs = {(r.id, r.band): r.key for r in lsh.sign_bands(rows, 2, 3, SMALL_PRIME, None, large_set).collect()}
    for i, held in sets.items():
        sums = [sum(1 - 2 * ((a * x + b) % SMALL_PRIME % 2) for x in held) for _, a, b in hash_params(6)]
        assert signs[i, 0] + signs[i, 1] == "".join("1" if s >= 0 else "0" for s in sums)


def test_elements_are_dealt_once_and_not_once_a_band(spark, tmp_path):
    """Before, the rows of every band were shuffled: 33 a set in each partition."""
    path = str(tmp_path / "sets")
    spark.range(4000).select((F.col("id") % 500).alias("id"), F.col("id").alias("element")).repartition(8).write.parquet(path)
    bands = lsh.minhash_bands(spark.read.parquet(path))
    plan = bands._jdf.queryExecution().executedPlan().toString()
    at = [n for n, line in enumerate(plan.splitlines()) if "REPARTITION_BY_COL" in line]
    spread = [n for n, line in enumerate(plan.splitlines()) if "Generate inline" in line]
    between = plan.splitlines()[: at[0]]
    assert at and spread[0] < at[0] and not any("Exchange" in line for line in between)


def test_vector_products_run_while_their_table_is_written(spark):
    """Only there are Arrow batches small; a row of the product holds two blocks of vectors."""
    df = spark.createDataFrame([(n, [1.0 * n, 1.0]) for n in range(20)], "id long, v array<double>")
    found = lsh.cosine_join_vectors(df, "id", "v", 2, 0.99, block_rows=4)
    assert "MapInArrow" not in found._jdf.queryExecution().executedPlan().toString()
    cosine = lambda a, b: (a * b + 1) / math.sqrt((a * a + 1) * (b * b + 1))
    assert {p for p in scores(found)} == {(a, b) for a in range(20) for b in range(a + 1, 20) if cosine(a, b) >= 0.99}


def near_copies(groups, size):
    """Groups of near copies, and one set that is like none."""
    rng = random.Random(3)
    sets = {0: frozenset(range(9000, 9040))}
    for g in range(groups):
        base = [g * 100 + e for e in range(40)]
        for n in range(size):
            sets[1 + g * size + n] = frozenset(rng.sample(base, 36)) | {10_000 + g * size + n}
    return sets


@pytest.mark.parametrize("wide", [setjoin.PACKED_SET, 30, 0])
@pytest.mark.parametrize("block_elements", [setjoin.BLOCK_ELEMENTS, 200])
def test_checked_pairs_of_any_block_and_width(spark, monkeypatch, wide, block_elements):
    monkeypatch.setattr(setjoin, "PACKED_SET", wide)
    sets = {**near_copies(2, 12), 50: frozenset(range(20)), 51: frozenset(range(3, 23))}
    unique, members = setjoin.prepared(setjoin.distinct_sets(frame(spark, sets), "id", "element"))
    pairs = [(a, b, len(sets[a]), len(sets[b])) for a, b in itertools.combinations(sorted(sets), 2)]
    found = setjoin.verify(
        spark.createDataFrame(pairs, "a long, b long, na long, nb long"), unique, setjoin.sketched(unique, members),
        setjoin.Jaccard, 0.5, block_elements,
    )
    assert scores(found) == brute(sets, "jaccard", 0.5)


def test_sets_of_a_group_are_not_sent_once_a_pair(spark):
    sets = near_copies(1, 120)
    pairs = [(a, b, len(sets[a]), len(sets[b])) for a, b in itertools.combinations(sorted(sets), 2) if a]
    placed, _ = setjoin._placed(spark.createDataFrame(pairs, "a long, b long, na long, nb long"), 1500)
    assert placed.count() == len(pairs)
    assert placed.select("one", "two").distinct().count() > 1
    # a set goes to each of the blocks of its group, of which there are three
    assert setjoin._sent(placed).count() <= 120 * 3


def test_no_candidates_give_no_pairs(spark):
    sets = {1: frozenset([1, 2]), 2: frozenset([3, 4])}
    assert scores(jaccard_join(frame(spark, sets), "id", "element", 0.5)) == {}


def test_rows_of_a_group_are_shuffled_once_for_both_sides(spark, tmp_path):
    spark.range(400).selectExpr("id % 8 AS k", "id").write.parquet(str(tmp_path / "rows"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        met = pairs_within(spark.read.parquet(str(tmp_path / "rows")), ["k"], "id", block_rows=20)
        assert met.count() == 8 * 50 * 49 // 2
        met.collect()
        assert "ReusedExchange" in met._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("share", [0.0, 1.0])
def test_vectors_of_common_bands_are_multiplied_in_blocks(spark, monkeypatch, share):
    """By blocks or by buckets, the pairs are those that share a band; by blocks no candidates are shuffled."""
    monkeypatch.setattr(lsh, "COMMON_SHARE", share)
    monkeypatch.setattr(lsh, "SHARING_PAIRS", 7)
    rng = random.Random(8)
    held = {n: [rng.gauss(0, 1) + 0.4 for _ in range(6)] for n in range(60)}
    df = spark.createDataFrame(list(held.items()), "id long, v array<double>")
    got = scores(lsh.cosine_join_vectors(df, "id", "v", 6, 0.5, bits=8, rows=4, block_rows=13))
    signs = projection_signs(6, 8)
    keys = {n: [sum(s * x for s, x in zip(row, v)) >= 0 for row in signs] for n, v in held.items()}
    dot = lambda a, b: sum(x * y for x, y in zip(held[a], held[b]))
    cosine = {(a, b): dot(a, b) / math.sqrt(dot(a, a) * dot(b, b)) for a, b in itertools.combinations(held, 2)}
    near = {p: round(c, 6) for p, c in cosine.items() if c >= 0.5}
    met = lambda a, b: keys[a][:4] == keys[b][:4] or keys[a][4:] == keys[b][4:]
    assert got == {p: c for p, c in near.items() if met(*p)} and len(got) < len(near)


def test_candidates_are_given_where_they_meet_first(spark):
    """Before, every candidate was shuffled once a band that it shares, and once more for each side's copies."""
    sets = near_copies(4, 9)
    sets |= {1000 + n: sets[min(sets)] for n in range(7)}
    unique, members = setjoin.prepared(setjoin.distinct_sets(frame(spark, sets), "id", "element"))
    banded = durable.durable(lsh.minhash_bands(unique, 6, 2))
    keys = {}
    for r in banded.collect():
        keys.setdefault(r.id, set()).add((r.band, r.h0, r.h1))
    rep = {r.id: r.rep for r in members.collect()}
    met = lsh.first_met(banded, ["h0", "h1"], members, block_rows=5, part_ids=2)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan and "SortAggregate" not in plan
    found = [(r.a, r.b) for r in met.collect()]
    wanted = {(a, b) for a in sets for b in sets if a < b and keys[rep[a]] & keys[rep[b]]}
    assert len(found) == len(set(found)) and set(found) == wanted and len(wanted) > 30
