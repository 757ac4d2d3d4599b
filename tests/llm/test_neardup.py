import random
import re

import numpy as np
import pytest

from tastegraph.llm import neardup
from tastegraph.llm.components import components
from tastegraph.llm.queries import op7_minhash
from tastegraph.llm.wordhash import Words, shingle_sets

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()}


def brute(docs, size, percent=80):
    """Union-find over all pairs."""
    sets = [shingles(t, size) for _, t in docs]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            a, b = sets[i], sets[j]
            same = docs[i][0] is not None and docs[i][0] == docs[j][0] and a and b
            if same or (None not in (docs[i][0], docs[j][0]) and a and b and 100 * len(a & b) >= percent * len(a | b)):
                parent[root(i)] = root(j)
    groups = {}
    for i, (d, _) in enumerate(docs):
        groups.setdefault(root(i), []).append(d)
    out = []
    for i, (d, _) in enumerate(docs):
        comp = d if d is None else min(groups[root(i)])
        out.append((d, len(sets[i]), comp, d is None or d == comp))
    return sorted(out, key=str)


def cases(seed, variants=12):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["Éa", "éa", "The", "the"]
    docs = []
    for _ in range(25):
        base = rng.choices(words, k=rng.choice([3, 6, 9, 30, 120, 400]))
        for _ in range(rng.randint(1, variants)):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, len(base) // 25, len(base) // 18])):
                own[rng.randrange(len(own))] = rng.choice(words)
            docs.append(rng.choice([" ", "  ", "\n"]).join(own))
    hot = rng.choices(words, k=150)
    for _ in range(90):  # one group with a third of all rows
        own = list(hot)
        for _ in range(rng.randint(0, 7)):
            own[rng.randrange(150)] = rng.choice(words)
        docs.append(" ".join(own))
    docs += [None, "", " \t\n", "one", "ONE", "one two", "One Two", "x" * 50000, "a b " * 20000, "a b " * 20000 + "a"]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("size", [2, 5])
def test_equals_brute_force(spark, size):
    docs = cases(size) + [(None, "w1 w2 w3 w4 w5 w6"), (None, None), (7, "other text of the same id entirely"), (9, None)]
    frame = spark.createDataFrame([(d, t, 5, "k") for d, t in docs], "doc_id long, text string, n int, key string")
    got = sorted((tuple(r) for r in neardup.near_duplicates(frame, size).collect()), key=str)
    assert got == brute(docs, size)
    kept = neardup.deduplicate(frame, size)
    assert kept.columns == frame.columns
    rows = kept.collect()
    want = {d for d, _, _, k in brute(docs, size) if k and d is not None}
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted(want)
    assert sum(r.doc_id is None for r in rows) == 2


def test_chain_of_texts_below_the_threshold_at_its_ends(spark):
    words = [f"v{i}" for i in range(60)]
    docs = [(i, " ".join(words[i : i + 30])) for i in range(0, 30)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.component_id for r in neardup.near_duplicates(frame, 2).collect()} == {0}


def test_all_pairs_within_the_distance_share_a_key_that_counts(spark):
    rng = np.random.default_rng(3)
    rows = []
    for case in range(120):
        one = rng.integers(0, 1 << 16, (1, neardup.SYMBOLS), dtype=np.uint16)
        two = one.copy()
        two[0, rng.choice(neardup.SYMBOLS, case % (neardup.MOST_ERRORS + 1), replace=False)] ^= 1
        (k1, o1), (k2, o2) = neardup.chunk_keys(one), neardup.chunk_keys(two)
        met = [(case, int(a), int(b)) for a, b in zip(o1[0][k1[0] == k2[0]], o2[0][k1[0] == k2[0]])]
        rows += met
        assert met
    table = spark.createDataFrame(rows, "case long, a long, b long")
    counting = table.where(neardup.first_key("a", "b")).groupBy("case").count().collect()
    assert len(counting) == 120 and max(r["count"] for r in counting) <= neardup.CHUNKS


def test_sketches_never_show_more_differences(spark):
    rng = np.random.default_rng(6)
    one = rng.integers(0, 1 << 16, (300, neardup.TRAITS), dtype=np.uint16)
    two = np.where(rng.random(one.shape) < rng.random((300, 1)), rng.integers(0, 1 << 16, one.shape, dtype=np.uint16), one)
    names = [[f"{side}{n}" for n in range(neardup.PARTS)] for side in "ab"]
    rows = [(*a, *b) for a, b in zip(neardup.sketches(one).tolist(), neardup.sketches(two).tolist())]
    table = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in [*names[0], *names[1]]))
    shown = [r[0] for r in table.select(neardup.traits_apart(*names)).collect()]
    want = ((one & 7) != (two & 7)).sum(1)
    assert shown == want.tolist() and (want <= (one != two).sum(1)).all()


def test_bitmaps_only_rule_out_pairs_that_are_not_similar(spark):
    rng, rows = np.random.default_rng(7), []
    for _ in range(400):
        pool = np.unique(rng.integers(0, 1 << 63, int(rng.integers(4, 900)), dtype=np.uint64))
        cut = int(len(pool) * rng.uniform(0, 0.3))
        one, two = pool[cut // 2 :], pool[: len(pool) - cut // 2]
        shared = len(np.intersect1d(one, two))
        similar = 100 * shared >= 80 * (len(one) + len(two) - shared)
        sizes = [len(x) << neardup.MARK_BITS for x in (one, two)]
        rows.append((bool(similar), *sizes, *[int(v) for x in neardup.bitmaps([one, two]) for v in x]))
    names = [[f"{side}{n}" for n in range(neardup.MAPS)] for side in "ab"]
    table = spark.createDataFrame(rows, ", ".join(["s boolean", "n long", "m long", *[f"{c} long" for c in [*names[0], *names[1]]]]))
    allowed = table.select("s", neardup.sizes_and_bits_allow("n", "m", *names, 80).alias("ok")).collect()
    assert all(r.ok for r in allowed if r.s)
    assert sum(not r.ok for r in allowed) > 0.5 * sum(not r.s for r in allowed)


def test_agreement_of_symbols_is_the_similarity():
    rng = np.random.default_rng(4)
    agree = []
    for _ in range(300):
        pool = rng.integers(0, 1 << 63, 120, dtype=np.uint64)
        one, two = neardup.traits([np.unique(pool[:110]), np.unique(pool[10:])])
        agree.append((one == two).mean())
    assert abs(np.mean(agree) - 100 / 120) < 0.01


def test_word_hashes():
    rng = random.Random(1)
    texts = ["".join(rng.choice("aAbé \n\t.") for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    for text, found in zip(texts, shingle_sets([t.encode() for t in texts], 2), strict=True):
        assert len(found) == len(shingles(text, 2)), repr(text)
    assert Words([]).hashes.size == 0


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (5, 5), (30, 31)] + [(100 + i, 101 + i) for i in range(60)] + [(200, 201 + i) for i in range(500)]
    found = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found[3] == 1 and found[9] == 7 and found[31] == 30 and 5 not in found
    assert {found[100 + i] for i in range(61)} == {100} and {found[201 + i] for i in range(500)} == {200}


def test_empty_table(spark):
    assert neardup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark, tmp_path):
    docs = cases(8, 5)
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted((tuple(r) for r in op7_minhash(spark, str(tmp_path)).collect()), key=str) == brute(docs, 2)


def test_second_set_of_a_repeated_id_stays_in_its_buckets(spark):
    words = [f"s0w{i}" for i in range(103)]
    # the third text is near the second one of id 1 only, and shares no key with it that the first one does not have
    docs = [(1, " ".join(words[:100])), (1, " ".join(words)), (2, " ".join(words[20:]))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted((tuple(r) for r in neardup.near_duplicates(frame, 2).collect()), key=str)
    assert got == brute(docs, 2) and {r[2] for r in got} == {1}
