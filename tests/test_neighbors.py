import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from tastegraph.operators.evaluate import error_histogram, pair_quality, rating_quality, rmse, score
from tastegraph.operators.knn import neighbor_lists, predict_item_knn, predict_user_knn
from tastegraph.operators import pearson
from tastegraph.operators import pearson
from tastegraph.operators.pearson import pearson_of, pearson_pairs
from tastegraph.plans import pairing
from tests.conftest import SCHEMA


def as_pairs(df):
    return {(r.a, r.b): round(r.similarity, 6) for r in df.collect()}


def as_predictions(df):
    return {(r.user, r.item): round(r.prediction, 6) for r in df.collect()}


def brute_pearson(rows, by, support, keep_zero=False):
    table = {}
    for user, item, rating in rows:
        a, b = (user, item) if by == "user" else (item, user)
        table.setdefault(a, {})[b] = rating
    out = {}
    for a, b in itertools.combinations(sorted(table), 2):
        common = table[a].keys() & table[b].keys()
        n = len(common)
        if n < max(support, 1):
            continue
        xs, ys = [table[a][c] for c in common], [table[b][c] for c in common]
        va = sum(x * x for x in xs) - sum(xs) ** 2 / n
        vb = sum(y * y for y in ys) - sum(ys) ** 2 / n
        cov = sum(x * y for x, y in zip(xs, ys)) - sum(xs) * sum(ys) / n
        r = 0.0 if va < 1e-12 or vb < 1e-12 else cov / math.sqrt(va * vb)
        if r != 0 or keep_zero:
            out[a, b] = (n, round(r, 6))
    return out


def test_pearson_users(train):
    expected = {(1, 2): 0.654654, (1, 3): -1, (1, 4): -1, (2, 3): -0.960769, (2, 4): -0.785714, (3, 4): -1}
    assert as_pairs(pearson_pairs(train)) == expected


def test_pearson_items(train):
    got = as_pairs(pearson_pairs(train, by="item"))
    assert got == {
        (10, 11): -0.838628, (10, 12): -1, (10, 13): -1, (11, 12): -0.981981, (11, 13): 0.654654, (12, 13): -1,
    }


@pytest.mark.parametrize(
    "support,by,keep_zero",
    [(1, "user", False), (1, "item", True), (2, "item", False), (3, "user", False), (3, "item", True), (4, "user", True)],
)
def test_pearson_with_hot_keys_matches_brute_force(spark, support, by, keep_zero):
    """Two items hold a third of all rows; tiny blocks force the split of every group."""
    rng = random.Random(support)
    rows = {(u, i): float(rng.randint(1, 5)) for u in range(40) for i in rng.sample(range(2, 60), 5)}
    rows |= {(u, i): float(rng.randint(1, 5)) for u in range(40) for i in (0, 1) if rng.random() < 0.9}
    triples = [(u, i, r) for (u, i), r in rows.items()]
    df = spark.createDataFrame(triples, SCHEMA)
    got = pearson_pairs(df, by, support, keep_zero=keep_zero, block_rows=7)
    assert {(r.a, r.b): (r.n, round(r.similarity, 6)) for r in got.collect()} == brute_pearson(
        triples, by, support, keep_zero
    )


def test_pearson_only_and_candidates(spark, train):
    only = spark.createDataFrame([(1,), (77,)], "user long")
    assert set(as_pairs(pearson_pairs(train, only=only))) == {(1, 2), (1, 3), (1, 4)}
    candidates = spark.createDataFrame([(1, 2), (3, 4)], "a long, b long")
    assert as_pairs(pearson_of(candidates, train)) == {(1, 2): 0.654654, (3, 4): -1}


@pytest.mark.parametrize("support,keep_zero", [(1, False), (3, False), (1, True)])
@pytest.mark.parametrize("most_keys", [pearson.MOST_KEYS, 30, 0])
def test_ratings_are_sent_only_to_candidates_with_enough_common_keys(spark, monkeypatch, support, keep_zero, most_keys):
    """Before, every candidate pair met all ratings of its first id. User 0 has so many keys that their hashes coincide."""
    rng = random.Random(9)
    rows = {(u, i): float(rng.randint(1, 5)) for u in range(1, 40) for i in rng.sample(range(400), 20)}
    rows |= {(0, i): float(rng.randint(1, 5)) for i in range(3000)}
    triples = [(u, i, r) for (u, i), r in rows.items()]
    df = spark.createDataFrame(triples, SCHEMA)
    candidates = spark.createDataFrame([(a, b) for a in range(40) for b in range(a + 1, 40)], "a long, b long")
    may = pearson._may_support
    monkeypatch.setattr(pearson, "_may_support", lambda pairs, rows, need: may(pairs, rows, need, most_keys))
    got = pearson_of(candidates, df, min_support=support, keep_zero=keep_zero)
    assert {(r.a, r.b): (r.n, round(r.similarity, 6)) for r in got.collect()} == brute_pearson(triples, "user", support, keep_zero)
    left = {(r.a, r.b) for r in may(candidates, pearson._sides(df, "user"), 3, most_keys).collect()}
    common = {(a, b): sum((b, i) in rows for (u, i) in rows if u == a) for a in range(1, 40) for b in range(a + 1, 40)}
    assert {p for p, n in common.items() if n >= 3} <= left
    if most_keys:
        assert sum(n < 3 and p in left for p, n in common.items()) < 5 < sum(n < 3 for n in common.values())


def test_pearson_edges(spark):
    constant = spark.createDataFrame(
        [(1, 1, 2.0), (1, 2, 2.0), (1, 3, 2.0), (2, 1, 1.0), (2, 2, 3.0), (2, 3, 5.0), (0, 1, 4.0)], SCHEMA
    )
    assert as_pairs(pearson_pairs(constant)) == {}
    kept = as_pairs(pearson_pairs(constant, keep_zero=True))
    assert kept == {(1, 2): 0.0, (0, 1): 0.0, (0, 2): 0.0}


def test_item_zero_is_ordinary(spark, train):
    shifted = train.withColumn("item", F.col("item") - 10)
    assert as_pairs(pearson_pairs(shifted))[1, 2] == 0.654654


def test_user_knn(train, test_pairs):
    expected = {(1, 13): 3.123303, (3, 12): 3.4095, (4, 10): 4.004274, (9, 10): 3.0}
    assert as_predictions(predict_user_knn(train, test_pairs)) == expected


def test_item_knn(train, test_pairs):
    raw = as_predictions(predict_item_knn(train, test_pairs, rescale=None))
    assert raw == {(1, 13): -2.650455, (3, 12): -3.323262, (4, 10): -3.647717, (9, 10): 3.0}
    scaled = as_predictions(predict_item_knn(train, test_pairs))
    assert scaled == {(1, 13): 0.750079, (3, 12): 0.244035, (4, 10): 0.0, (9, 10): 5.0}


def test_item_knn_leaky(train, test_pairs):
    got = as_predictions(predict_item_knn(train, test_pairs, leaky=True))
    assert got == {(1, 13): 0.490061, (3, 12): 0.0, (4, 10): 0.655269, (9, 10): 5.0}


def test_knn_options(spark, train, test_pairs):
    first = as_predictions(predict_user_knn(train, test_pairs, k=1))
    # user 1 and item 13: weights -1 (3), -1 (4), 0.654654 (2): the tie goes to user 3
    assert first[1, 13] == round(4.0 - (4 - 10 / 3), 6)
    only = spark.createDataFrame([(1, 2)], "a long, b long")
    assert as_predictions(predict_user_knn(train, test_pairs, candidates=only))[1, 13] == 3.5
    excluded = as_predictions(predict_user_knn(train, test_pairs, candidates=only, exclude_target_from_mean=True))
    assert excluded[1, 13] == round(4.0 + 3 - 11 / 3, 6)
    cut = as_predictions(predict_user_knn(train, test_pairs, cut=0.99))
    assert cut[1, 13] == round(4.0 - ((4 - 10 / 3) + (5 - 11 / 3)) / 2, 6)


def test_neighbor_lists(train):
    rows = neighbor_lists(train, k=2).where("id = 1").orderBy("rank").collect()
    assert [(r.neighbor, round(r.weight, 6)) for r in rows] == [(3, -1.0), (4, -1.0)]


def test_minmax_with_one_value(spark, train):
    alone = spark.createDataFrame([(9, 10, 3.0)], SCHEMA)
    assert as_predictions(predict_item_knn(train, alone)) == {(9, 10): 3.0}


def test_rating_quality(spark):
    truth = spark.createDataFrame([(1, 1, 3.0), (1, 2, 5.0), (1, 3, 1.0), (2, 1, 1.0)], SCHEMA)
    predicted = spark.createDataFrame(
        [(1, 1, 2.0), (1, 2, 0.3), (1, 3, 7.2)], "user long, item long, prediction double"
    )
    scored = score(predicted, truth)
    assert {r.bucket: r.n for r in error_histogram(scored).collect()} == {0: 0, 1: 1, 2: 0, 3: 0, 4: 2}
    expected = math.sqrt((1 + 4.7**2 + 6.2**2) / 3)
    assert rmse(scored).first()["rmse"] == pytest.approx(expected)
    report = {r.metric: r.value for r in rating_quality(predicted, truth).collect()}
    assert report["error_4_up"] == 2 and report["pairs"] == 3 and report["rmse"] == pytest.approx(expected)


def test_pair_quality(spark):
    found = spark.createDataFrame([(2, 1), (1, 2), (3, 4)], "a long, b long")
    truth = spark.createDataFrame([(1, 2), (5, 6)], "a long, b long")
    row = pair_quality(found, truth).first()
    assert (row.tp, row.fp, row.fn, row.precision, row.recall) == (1, 1, 1, 0.5, 0.5)
    empty = pair_quality(found.limit(0), truth).first()
    assert empty.precision is None and empty.recall == 0.0


def test_busy_targets_take_the_other_way(spark):
    """Both ways from cells to votes give the same predictions."""
    from tastegraph.plans.votes import neighbor_votes

    rng = random.Random(4)
    rated = [(u, i, float(rng.randint(1, 5))) for u in range(30) for i in range(12) if rng.random() < 0.3 or i == 0]
    cells = [(u, i) for u in range(30) for i in range(12) if (u + i) % 4 == 0]
    edges = [(u, v, (u * v % 7) / 7) for u in range(30) for v in range(30) if u != v and (u + v) % 3]
    weight = {(u, v): w for u, v, w in edges}
    for by, busy in itertools.product(("user", "item"), (0, 5, 1000)):
        got = neighbor_votes(
            spark.createDataFrame(cells, "user long, item long"),
            spark.createDataFrame(edges, "id long, neighbor long, weight double"),
            spark.createDataFrame(rated, "user long, item long, value double"),
            by,
            busy,
        )
        if by == "user":
            want = {(u, i, v, weight[u, v], x) for u, i in cells for v, j, x in rated if j == i and (u, v) in weight}
        else:
            want = {(u, i, j, weight[i, j], x) for u, i in cells for v, j, x in rated if v == u and (i, j) in weight}
        rows = [tuple(r) for r in got.collect()]
        assert len(rows) == len(want) and set(rows) == want


@pytest.mark.parametrize("hot_keys,broadcast_keys", [(2, 0), (8, 0), (10**6, 0), (8, 1000)])
def test_lookup_splits_hot_keys(spark, monkeypatch, hot_keys, broadcast_keys):
    from tastegraph.plans import lookup as module

    monkeypatch.setattr(module, "HOT_KEYS", hot_keys)
    monkeypatch.setattr(module, "BROADCAST_KEYS", broadcast_keys)
    rows = [(n % 3 if n < 60 else n, n) for n in range(100)]
    df = spark.createDataFrame(rows, "key long, n long")
    table = df.where("key <> 77").groupBy("key").count()
    got = module.lookup(df, table, "key", "count")
    assert got.columns == ["key", "n", "count"]
    assert sorted((r.key, r.n, r["count"]) for r in got.collect()) == sorted(
        (k, n, 20 if k < 3 else 1) for k, n in rows if k != 77
    )


@pytest.mark.parametrize("by", ["user", "item"])
def test_pearson_with_salted_lookups(spark, monkeypatch, by):
    from tastegraph.plans import lookup as module

    monkeypatch.setattr(module, "HOT_KEYS", 20)
    monkeypatch.setattr(module, "BROADCAST_KEYS", 0)
    rng = random.Random(11)
    cells = {(u, i) for u in range(30) for i in rng.sample(range(40), 6)} | {(u, 0) for u in range(30)}
    triples = [(u, i, float(rng.randint(1, 5))) for u, i in cells]
    got = pearson_pairs(spark.createDataFrame(triples, SCHEMA), by, block_rows=7).collect()
    assert {(r.a, r.b): (r.n, round(r.similarity, 6)) for r in got} == brute_pearson(triples, by, 1)


@pytest.mark.parametrize("support,keep_zero", [(1, False), (1, True), (3, False)])
def test_pearson_only_with_hot_keys_matches_brute_force(spark, support, keep_zero):
    rng = random.Random(12)
    triples = [(u, 0, float(rng.randint(1, 5))) for u in range(40)]
    triples += [(u, i, float(rng.randint(1, 5))) for u in range(40) for i in rng.sample(range(1, 12), 4)]
    only = spark.createDataFrame([(u,) for u in (0, 3, 17, 99)], "user long")
    got = pearson_pairs(
        spark.createDataFrame(triples, SCHEMA), "user", support, only=only, keep_zero=keep_zero, block_rows=7
    )
    want = {p: v for p, v in brute_pearson(triples, "user", support, keep_zero).items() if {0, 3, 17} & set(p)}
    assert {(r.a, r.b): (r.n, round(r.similarity, 6)) for r in got.collect()} == want


def test_rows_without_a_useful_pair_are_not_joined(spark, monkeypatch):
    joined = []

    def counting(kind):
        real = getattr(pairing, kind)

        def run(*args, **kwargs):
            frames = [a for a in args[:2] if hasattr(a, "columns")]
            if kind == "pairs_across":
                on_left, on_right = args[5]
                frames = [f.where((F.col(on_left) > 0) & (F.col(on_right) > 0)) for f in frames]
            joined.append(sum(f.count() for f in frames))
            return real(*args, **kwargs)

        monkeypatch.setattr(pearson, kind, run)

    counting("pairs_within")
    counting("pairs_across")
    # everybody has rated item 0, which is everybody's most popular one
    triples = [(u, i, float(1 + (u + i) % 5)) for u in range(300) for i in (0, 1 + u)]
    assert pearson_pairs(spark.createDataFrame(triples, SCHEMA), "user").count() == 0
    assert sum(joined) == 0
    joined.clear()
    only = spark.createDataFrame([(7,)], "user long")
    assert pearson_pairs(spark.createDataFrame(triples, SCHEMA), "user", only=only, keep_zero=True).count() == 299
    # the wanted row and those it meets, once each
    assert sum(joined) <= 2 + 300


@pytest.mark.parametrize("keep_zero", [False, True])
def test_pairs_of_an_id_with_many_rows_are_dealt_to_several_tasks(spark, keep_zero):
    rng = random.Random(17)
    rows = [(0, i, float(rng.randint(1, 5))) for i in range(60)]
    rows += [(u, i, float(rng.randint(1, 5))) for u in range(1, 25) for i in rng.sample(range(60), 9)]
    df = spark.createDataFrame(rows, "user long, item long, rating double")
    got = [
        {(r.a, r.b): (r.n, round(r.similarity, 9)) for r in pearson_pairs(df, keep_zero=keep_zero, spread_rows=n).collect()}
        for n in (1, 7, 10**6)
    ]
    assert got[0] == got[1] == got[2] and len(got[0]) > 50


@pytest.mark.parametrize("support,keep_zero,wanted", [(1, False, 0), (1, True, 4), (3, False, 0), (3, False, 15), (1, False, 15)])
@pytest.mark.parametrize("block_rows", [9, 2048])
def test_pairs_are_found_in_many_ranges_and_never_shuffled(spark, monkeypatch, support, keep_zero, wanted, block_rows):
    """Before, a row for each pair and common key passed an exchange by its ids. User 20 has so many pairs that its range is dealt to several tasks."""
    monkeypatch.setattr(pearson, "TASK_PAIRS", 60)
    monkeypatch.setattr(pearson, "LEAST_PAIRS", 60)
    monkeypatch.setattr(pearson, "PLAIN_ROWS", 20)
    rng = random.Random(23)
    rows = {(u, i): float(rng.randint(1, 5)) for u in range(40) for i in rng.sample(range(1, 50), 6)}
    rows |= {(u, 0): float(rng.randint(1, 5)) for u in range(40)} | {(20, i): float(rng.randint(1, 5)) for i in range(50)}
    triples = [(u, i, r) for (u, i), r in rows.items()]
    chosen = set(range(0, 40, 40 // wanted)) if wanted else set(range(40))
    only = spark.createDataFrame([(u,) for u in chosen], "user long") if wanted else None
    got = pearson_pairs(spark.createDataFrame(triples, SCHEMA), "user", support, only, keep_zero, block_rows)
    want = {p: v for p, v in brute_pearson(triples, "user", support, keep_zero).items() if chosen & set(p)}
    found = [(r.a, r.b, r.n, round(r.similarity, 6)) for r in got.collect()]
    assert sorted(found) == sorted((a, b, n, r) for (a, b), (n, r) in want.items())
    assert "hashpartitioning(a#" not in got._jdf.queryExecution().executedPlan().toString()
