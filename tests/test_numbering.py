import random

import pytest
from pyspark.sql import functions as F

from tastegraph.operators import factors, labels, lsh, permuted, setjoin
from tastegraph.plans.numbering import dense_numbers


def numbered(rows, order, within):
    """Brute force: the multiset of (group, key, number), nulls first."""
    groups = {}
    for r in rows:
        groups.setdefault(tuple(r[w] for w in within), []).append(tuple(r[o] for o in order))
    rank = lambda key: tuple((v is not None, v if v is not None else 0) for v in key)
    return sorted(((g, k, n, len(ks)) for g, ks in groups.items() for n, k in enumerate(sorted(ks, key=rank))), key=repr)


@pytest.mark.parametrize("within", [(), (0,)])
def test_numbers_are_gapless_in_order(spark, within):
    rng = random.Random(1)
    rows = [(rng.choice([None, "a", "b"]), rng.choice([None, 7, 7, 7, rng.randint(0, 50)]), i) for i in range(900)]
    rows += [("only", 1, 1), rows[0], rows[0]]
    frame = spark.createDataFrame(rows, "g string, v long, i long").repartition(7)
    names = ["g", "v", "i"]
    got = dense_numbers(frame, ["v"], [names[w] for w in within], "place", "total").collect()
    found = sorted(((tuple(r[w] for w in within), (r.v,), r.place, r.total) for r in got), key=repr)
    assert found == numbered(rows, (1,), within)
    assert sorted(map(repr, (tuple(r)[:3] for r in got))) == sorted(map(repr, rows))


def test_numbers_of_an_empty_table(spark):
    assert dense_numbers(spark.createDataFrame([], "v long"), ["v"]).count() == 0


def test_labels_there_and_back(spark):
    rows = [("z", 1), ("a", 2), ("a", 3), (None, 4), ("m", 5)]
    frame = spark.createDataFrame(rows, "id string, x long")
    numbers = labels.label_numbers(frame, "id")
    assert {r.label: r.number for r in numbers.collect()} == {"a": 0, "m": 1, "z": 2}
    assert sorted(map(tuple, labels.encoded(frame, "id", numbers).collect())) == [(0, 2), (0, 3), (1, 5), (2, 1)]
    pairs = spark.createDataFrame([(2, 0, 0.5), (0, 1, 0.7)], "a long, b long, similarity double")
    assert sorted(map(tuple, labels.relabelled(pairs, numbers).collect())) == [("a", "m", 0.7), ("a", "z", 0.5)]


def test_als_takes_ids_beyond_32_bits(spark, train, test_pairs):
    def moved(frame):
        return frame.withColumn("user", F.col("user") + (1 << 40)).withColumn("item", F.concat(F.lit("i"), F.col("item").cast("string")))

    plain = factors.predict_als(train, test_pairs).collect()
    wide = factors.predict_als(moved(train), moved(test_pairs)).collect()
    assert {(r.user + (1 << 40), f"i{r.item}") for r in plain} == {(r.user, r.item) for r in wide}
    assert all(0 <= r.prediction <= 5 for r in wide)


def word_sets(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(60):
        base = rng.sample(range(400), 30)
        for j in range(rng.randint(1, 4)):
            own = set(base[: 30 - rng.randint(0, 8)]) | set(rng.sample(range(400), rng.randint(0, 6)))
            rows += [(i * 10 + j, x) for x in own]
    rows += [(5000 + k, x) for k in range(40) for x in range(25)]  # copies
    rows += [(None, 3), (6000, None)]
    return rows


def test_permuted_join_finds_nearly_all_and_nothing_else(spark):
    frame = spark.createDataFrame(word_sets(3), "id long, x long")
    exact = {(r.a, r.b): r.similarity for r in setjoin.cosine_join(frame, "id", "x", 0.7).collect()}
    found = {(r.a, r.b): r.similarity for r in permuted.cosine_permuted_join(frame, "id", "x", 0.7, neighbours=20).collect()}
    assert len(exact) > 800 and set(found) <= set(exact)
    assert all(abs(found[p] - exact[p]) < 1e-9 for p in found)
    assert len(found) >= 0.9 * len(exact)


def test_a_row_meets_exactly_its_next_neighbours(spark):
    rows = [(g, n) for g in (1, 2) for n in range(37)] + [(3, 0)]
    met = permuted.neighbour_pairs(spark.createDataFrame(rows, "g int, n long"), "g", "n", ["n"], 5).collect()
    want = {(g, i, j) for g in (1, 2) for i in range(37) for j in range(i + 1, min(37, i + 6))}
    assert {(r.g, r.a_n, r.b_n) for r in met} == want and len(met) == len(want)


def test_sign_bands_keep_their_recall(spark):
    frame = spark.createDataFrame(word_sets(4), "id long, x long")
    exact = {(r.a, r.b) for r in setjoin.cosine_join(frame, "id", "x", 0.7).collect()}
    found = {(r.a, r.b) for r in lsh.cosine_lsh_join(frame, "id", "x", 0.7).collect()}
    assert found <= exact and len(found) >= 0.98 * len(exact)
