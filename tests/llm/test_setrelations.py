import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastegraph.llm import setrelations
from tastegraph.llm.queries import op11_setrelations
from tastegraph.llm.wordhash import shingle_sets

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()}


def brute(docs, size=3, percent=90):
    """Union-find over all pairs."""
    sets = [shingles(t, size) for _, t in docs]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (one, _) in enumerate(docs):
        for j in range(i):
            a, b = sets[i], sets[j]
            if None in (one, docs[j][0]) or not a or not b:
                continue
            if one == docs[j][0] or 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted(((d, len(sets[i]), None if d is None else least[root(i)]) for i, (d, _) in enumerate(docs)), key=str)


def variants(rng, base, count, most, words):
    for _ in range(count):
        own = list(base)
        for _ in range(rng.randint(0, most)):
            own[rng.randrange(len(own))] = rng.choice(words)
        yield " ".join(own)


def cases(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["Éa", "éa", "The", "the"]
    docs = []
    for _ in range(40):
        base = rng.choices(words, k=rng.choice([3, 9, 12, 20, 60, 200, 500]))
        docs += variants(rng, base, rng.randint(1, 9), max(1, len(base) // 50), words)
        docs.append(" ".join(base[: rng.randint(1, len(base))]))
    # a third of all rows near one text that is not there, linked in chains or not at all
    hot = rng.choices(words, k=180)
    docs += variants(rng, hot, 130, 6, words)
    shared = " ".join(rng.choices(words, k=60))  # a passage of many unrelated texts
    docs += [shared + " " + " ".join(rng.choices(words, k=rng.randint(1, 40))) for _ in range(60)]
    docs += [None, "", " \t\n", "one", "ONE", "one two", "One Two", "x" * 50000, "a b c " * 20000, "a b c " * 20000 + "a a"]
    docs += [docs[5]] * 30
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("seed,buckets", [(1, 1), (2, 7)])
def test_equals_brute_force(spark, seed, buckets, monkeypatch):
    docs = cases(seed) + [(None, "w1 w2 w3 w4 w5 w6"), (None, None), (7, "other text of the same id entirely"), (9, None)]
    total = sum(len(shingles(t, 3)) for _, t in docs)
    monkeypatch.setattr(setrelations, "BUCKET_SHINGLES", total // buckets)
    monkeypatch.setattr(setrelations, "PAGE", 16)
    if seed == 2:
        monkeypatch.setattr(setrelations, "BROADCAST_IDS", 0)
    frame = spark.createDataFrame([(d, t, 5, "k") for d, t in docs], "doc_id long, text string, n int, key string")
    got = sorted((tuple(r) for r in setrelations.linked(frame).collect()), key=str)
    assert got == brute(docs)


def test_another_threshold(spark):
    docs = cases(5)[:200]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted((tuple(r) for r in setrelations.linked(frame, 2, 70).collect()), key=str) == brute(docs, 2, 70)


def test_chain_of_texts_below_the_threshold_at_its_ends(spark):
    words = [f"v{i}" for i in range(90)]
    frame = spark.createDataFrame([(i, " ".join(words[i : i + 50])) for i in range(40)], "doc_id long, text string")
    assert {r.component_id for r in setrelations.linked(frame).collect()} == {0}


def test_sets_that_differ_just_enough(spark):
    # 18 of 20 and 17 of 19 shingles in common: 0.9 is a link, less is not
    words = [f"u{i}" for i in range(40)]
    docs = [(1, " ".join(words[:21])), (2, " ".join(words[1:22])), (3, " ".join(words[20:31])), (4, " ".join(words[21:31]))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted(map(tuple, setrelations.linked(frame).collect()))
    assert got == brute(docs) and {r[2] for r in got} == {1, 3, 4}


def test_answers_from_differences_are_those_of_whole_sets(spark):
    rng = np.random.default_rng(2)
    pool = np.unique(rng.integers(0, 1 << 63, 300, dtype=np.uint64))
    sets = {i: np.sort(rng.choice(pool, int(rng.integers(150, 290)), replace=False)) for i in range(25)}
    table = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in sets.items()], "sid long, hashes binary")
    pairs = spark.createDataFrame([(0, i) for i in range(1, 25)], "a long, b long")
    first = setrelations.compared(pairs, table)
    assert {(r.b, r.common) for r in first.collect()} == {(i, len(np.intersect1d(sets[0], sets[i]))) for i in range(1, 25)}
    answers = first.select(F.col("b").alias("sid"), F.col("a").alias("lead"), "less", "more")
    wanted = [(i, j) for i in range(1, 25) for j in range(1, i)]
    asked = spark.createDataFrame([(i, j, 0, len(sets[0])) for i, j in wanted], "a long, b long, lead long, lead_n long")
    got = {(r.a, r.b): r.common for r in setrelations.derived(asked, answers).collect()}
    assert got == {(i, j): len(np.intersect1d(sets[i], sets[j])) for i, j in wanted}


def test_entries_are_the_rarest_shingles(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    docs = sorted({i: " ".join(rng.choices(words, k=rng.randint(12, 200))) for i in range(80)}.items())
    hot = " ".join(words[:40])
    docs += [(100 + i, f"{hot} x{i} y{i}") for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    sets = dict(zip([d for d, _ in docs], shingle_sets([t.encode() for _, t in docs], 3), strict=True))
    uses = {}
    for s in sets.values():
        for x in s.tolist():
            uses[x] = uses.get(x, 0) + 1
    sid = {int(setrelations.prints([s])[0, 0]): s for s in sets.values()}
    rows = setrelations.index_entries(frame, 3, 90, 9, sum(map(len, sets.values()))).collect()
    for r in rows:
        own = sorted(uses[x] for x in sid[r.sid].tolist())
        assert r.n == len(own) and r.pos < setrelations.prefix_length(r.n, 90) and own[r.pos] > 1
    for sid, s in sid.items():
        alone = sum(uses[x] == 1 for x in s.tolist())
        assert sum(r.sid == sid for r in rows) == max(0, setrelations.prefix_length(len(s), 90) - alone)


def test_empty_table(spark):
    assert setrelations.linked(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark, tmp_path):
    docs = cases(8)[:150]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted((tuple(r) for r in op11_setrelations(spark, str(tmp_path)).collect()), key=str) == brute(docs)
