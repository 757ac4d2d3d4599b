import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from tastegraph.operators import lsh, onehash, packed, permuted, setjoin
from tastegraph.operators.setjoin import cosine_join, jaccard_join
from tests.test_joins import brute, frame, near_copies, scores, skewed_sets


def rows_of(spark, sets):
    return setjoin.prepared(setjoin.distinct_sets(frame(spark, sets), "id", "element"))


@pytest.mark.parametrize("measure,join,threshold", [("jaccard", jaccard_join, 0.5), ("cosine", cosine_join, 0.3)])
@pytest.mark.parametrize("wide", [setjoin.PACKED_SET, 6])
def test_join_with_busy_numbers_and_wide_sets(spark, monkeypatch, measure, join, threshold, wide):
    monkeypatch.setattr(setjoin, "PACKED_SET", wide)
    monkeypatch.setattr(packed, "LEAST_TOKENS", 20)
    monkeypatch.setattr(packed, "PAIRS_AT_ONCE", 50)
    monkeypatch.setattr(packed, "BATCH_ROWS", 11)
    sets = {**near_copies(3, 14), **{1000 + n: s for n, s in skewed_sets(5).items()}}
    named = {f"s{n}": s for n, s in sets.items()}
    df = frame(spark, sets).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("id"), "element")
    assert scores(join(df, "id", "element", threshold, block_rows=9)) == brute(named, measure, threshold)


@pytest.mark.parametrize("measure,name", [(setjoin.Jaccard, "jaccard"), (setjoin.Cosine, "cosine")])
def test_pairs_of_near_copies_are_given_once(spark, measure, name):
    """Before, such a pair was shuffled for nearly each of the rare elements it shares."""
    sets = near_copies(2, 60)
    unique, members = rows_of(spark, sets)
    rows, quiet = packed.packed_sets(unique, members, 2048)
    dealt = packed._dealt(rows, measure, 0.5, 7, quiet, False)
    given = [(min(r.x, r.y), max(r.x, r.y)) for r in packed._met(dealt.repartitionById(7, F.col("fragment")), measure, 0.5).collect()]
    exact = brute(sets, name, 0.5)
    assert set(given) >= set(exact) and len(exact) > 3000
    assert len(given) <= 1.05 * len(set(given))


def test_sets_travel_as_rows_of_numbers(spark):
    """Before, each element of a prefix was a row with the whole short sketch beside it."""
    sets = near_copies(1, 50)
    unique, members = rows_of(spark, sets)
    rows, quiet = packed.packed_sets(unique, members, 2048)
    assert quiet == 40 and rows.count() == 50
    held = {r.id: r.numbers for r in rows.collect()}
    assert all(len(v) == 36 and v == sorted(v) for v in held.values())
    assert packed._dealt(rows, setjoin.Jaccard, 0.5, 3, quiet, False).count() <= 3 * 50


def test_bits_and_common_elements_of_block_pairs(spark):
    sets = {**near_copies(2, 6), 40: frozenset(range(9000, 12000)), 41: frozenset(range(9000, 12500))}
    unique, members = rows_of(spark, sets)
    pairs = [(a, b, len(sets[a]), len(sets[b])) for a, b in itertools.combinations(sorted(sets), 2)]
    placed, _ = setjoin._placed(spark.createDataFrame(pairs, "a long, b long, na long, nb long"), 200)
    sent = setjoin._sent(placed)
    whole = unique.groupBy("id").agg(F.collect_list(F.col("element").cast("string")).alias("held"))
    common = {(r.a, r.b): r.value for r in packed.in_block_pairs(placed, sent.join(whole, "id"), False).collect()}
    assert common == {(a, b): len(sets[a] & sets[b]) for a, b, _, _ in pairs}
    sketches = setjoin.sketched(unique, members).select("id", F.col("sketch").alias("held"))
    apart = {(r.a, r.b): r.value for r in packed.in_block_pairs(placed, sent.join(sketches, "id"), True).collect()}
    assert len(apart) == len(pairs) and all(n <= len(sets[a] ^ sets[b]) for (a, b), n in apart.items())
    assert apart[40, 41] > 300


def test_another_seed_where_two_elements_have_one_hash(spark, monkeypatch):
    plain = packed.coded
    monkeypatch.setattr(packed, "coded", lambda seed: F.lit(1).cast("long").alias("h") if seed < 2 else plain(seed))
    sets = {1: frozenset([1, 2, 3]), 2: frozenset([2, 3, 4])}
    unique, _ = rows_of(spark, sets)
    seed, counts = packed.element_code(unique)
    assert seed == 2 and [r.holders for r in counts.collect()] == [2, 2]
    assert scores(jaccard_join(frame(spark, sets), "id", "element", 0.5)) == {(1, 2): 0.5}


@pytest.mark.parametrize("one_hash", [False, True])
def test_pairs_of_near_copies_leave_the_bucket_join_once(spark, monkeypatch, one_hash):
    """Before, such a pair was shuffled for nearly each of the bands it shares."""
    met, plain = [], lsh.pairs_within
    monkeypatch.setattr(lsh, "pairs_within", lambda *given, **more: met.append(plain(*given, **more)) or met[-1])
    join = onehash.jaccard_one_hash_join if one_hash else lsh.jaccard_lsh_join
    sets = near_copies(2, 40)
    found = scores(join(frame(spark, sets), "id", "element", 0.5, bands=33, rows=3, code=lambda e: e))
    keys = {}
    for r in (onehash.one_hash_bands if one_hash else lsh.minhash_bands)(rows_of(spark, sets)[0], 33, 3, code=lambda e: e).collect():
        keys.setdefault(r.id, set()).add((r.band, r.h0, r.h1, r.h2))
    assert found == {p: s for p, s in brute(sets, "jaccard", 0.5).items() if keys[p[0]] & keys[p[1]]} and len(found) > 1000
    pairs = met[0].select("a_id", "b_id")
    assert pairs.distinct().count() >= len(found) and pairs.count() <= 1.2 * pairs.distinct().count()


def test_pairs_of_common_sign_bands_are_found_by_rare_elements(spark, monkeypatch):
    """Before, all pairs of a bucket were looked at, a share of all pairs; the pairs found are the same."""
    sets = {**near_copies(3, 14), **{1000 + n: s for n, s in skewed_sets(5).items()}}
    given = {"threshold": 0.6, "bits": 30, "rows": 6, "block_rows": 9}
    monkeypatch.setattr(lsh, "COMMON_SHARE", 1.0)
    by_buckets = scores(lsh.cosine_lsh_join(frame(spark, sets), "id", "element", **given))
    monkeypatch.undo()
    monkeypatch.setattr(lsh, "bucket_pairs", None)
    assert scores(lsh.cosine_lsh_join(frame(spark, sets), "id", "element", **given)) == by_buckets
    exact = brute(sets, "cosine", 0.6)
    assert by_buckets.items() <= exact.items() and 0 < len(by_buckets) < len(exact)


def test_large_blocks_of_vectors_are_multiplied_in_strips(spark, monkeypatch):
    """Before, blocks had a fixed size, and what is sent grew with the square of their number."""
    monkeypatch.setattr(lsh, "STRIP_CELLS", 40)
    monkeypatch.setattr(lsh, "BLOCKS", 3)
    rng = random.Random(4)
    held = {n: [rng.gauss(0, 1) for _ in range(5)] for n in range(50)}
    written = []
    plain = lsh.durable
    monkeypatch.setattr(lsh, "durable", lambda df: written.append(plain(df)) or written[-1])
    got = scores(lsh.cosine_join_vectors(spark.createDataFrame(list(held.items()), "id long, v array<double>"), "id", "v", 5, 0.4, block_rows=4))
    dot = lambda a, b: sum(p * q for p, q in zip(held[a], held[b]))
    cosine = {(a, b): dot(a, b) / math.sqrt(dot(a, a) * dot(b, b)) for a, b in itertools.combinations(held, 2)}
    assert got == {p: round(c, 6) for p, c in cosine.items() if c >= 0.4}
    (table,) = [t for t in written if "data" in t.columns]
    assert table.count() <= 3


def test_neighbours_far_from_the_threshold_are_not_checked(spark, monkeypatch):
    """Before, every neighbour with a near signature was joined with two sketches; all sets here are neighbours."""
    sets = {n: frozenset(range(30)) | {1000 * (n + 1) + k for k in range(60)} for n in range(40)}
    sets |= {100 + n: sets[n] | {7_000_000 + n} for n in range(5)}
    checked, plain = [], permuted.verify
    monkeypatch.setattr(permuted, "verify", lambda found, *rest, **more: checked.append(found) or plain(found, *rest, **more))
    found = scores(permuted.cosine_permuted_join(frame(spark, sets), "id", "element", 0.7))
    assert found == brute(sets, "cosine", 0.7) and len(found) == 5
    assert checked[0].count() < 20
