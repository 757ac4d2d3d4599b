import collections
import math
import random

import numpy as np
import pytest

from tastegraph.llm import pseudolik as pl
from tastegraph.llm.queries import op8_pseudolik
from tastegraph.llm.wordhash import Words


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(pl, "RATE", 0.3)


def vocabulary(size=300):
    rng = np.random.default_rng(1)
    return pl.Vocabulary.of(rng.integers(1, 1 << 62, size).astype(np.uint64), rng.integers(1, 50, size).astype(float), 1000, 1500)


def trained(v):
    rng = np.random.default_rng(4)
    return pl.Network({k: (x + rng.normal(0, 0.3, x.shape)).astype(np.float64) for k, x in pl.Network.fresh(v).items()})


def by_hand(net, v, hidden, word):
    """The chance of a word: its way down the tree, one node at a time."""
    node, chance = v.tree.root, 1.0
    while node:
        p = 1 / (1 + math.exp(-(hidden @ net["outputs"][node] + net["levels"][node])))
        chance *= p if word >= node else 1 - p
        node = (v.tree.right if word >= node else v.tree.left)[node]
    return chance


def test_chances_add_up_and_start_at_frequencies():
    for size in (0, 1, 2, 3, 300):
        v = vocabulary(size)
        hidden = np.random.default_rng(2).normal(0, 1, pl.WIDTH)
        every = np.arange(v.size)
        for net in (pl.Network.fresh(v), trained(v)):
            got = np.exp(net.chances(v.tree, np.tile(hidden, (v.size, 1)), every))
            assert np.allclose(got, [by_hand(net, v, hidden, w) for w in every], atol=1e-6) and abs(got.sum() - 1) < 1e-5
        start = np.exp(pl.Network.fresh(v).chances(v.tree, np.zeros((v.size, pl.WIDTH)), every))
        assert (np.diff(start) <= 1e-6).all() and sorted([*v.numbers, v.rare]) == every.tolist()
        assert v.number(np.array([5], np.uint64)).tolist() == [v.rare] and (v.number(v.hashes) == v.numbers).all()


def test_score_equals_word_by_word(monkeypatch):
    monkeypatch.setattr(pl, "BATCH", 7)
    rng, v = np.random.default_rng(2), vocabulary()
    net = trained(v)
    texts = [rng.integers(0, v.size, n) for n in (0, 1, 2, 5, 40, 0)]
    got = pl.log_likelihoods(net, texts, v)
    for text, score in zip(texts, got):
        want = 0.0
        for t, word in enumerate(text):
            near = [text[t + o] if 0 <= t + o < len(text) else v.pad for o in pl.OFFSETS]
            hidden = np.tanh(sum(net["inputs"][i] * s for i, s in zip(near, net["scales"])) + net["shift"])
            want += math.log(by_hand(net, v, hidden, word))
        assert abs(score - want) < 1e-6
    assert pl.log_likelihoods(net, [], v).tolist() == []


def test_slopes_equal_differences():
    rng, v = np.random.default_rng(3), vocabulary(20)
    net = trained(v)
    line, _ = pl.line_of([rng.integers(0, v.size, n) for n in (30, 1, 25)], v.pad)
    _, slopes = net.slopes(v.tree, line, v.pad)
    for name, (rows, slope) in slopes.items():
        assert len(set(rows.tolist())) == len(rows)
        for at in {0, len(rows) // 2, len(rows) - 1}:
            index = rows[at] if net[name].ndim == 1 else (rows[at], 3)
            before = net[name][index]
            net[name][index] = before + 1e-6
            up, _ = net.slopes(v.tree, line, v.pad)
            net[name][index] = before - 1e-6
            down, _ = net.slopes(v.tree, line, v.pad)
            net[name][index] = before
            assert abs((up - down) / 2e-6 - (slope[at] if net[name].ndim == 1 else slope[at][3])) < 1e-3, name


def chain(rng, n):
    """Text in which each word follows from the one before."""
    out = [rng.randrange(12)]
    while len(out) < n:
        out.append((out[-1] * 5 + 1 + rng.randrange(2)) % 12)
    return " ".join(f"word{w}" for w in out)


def means(spark, model, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r["mean"] for r in pl.scored(pl.numbered(docs, model.vocabulary), model).collect()}
    return [got[i] for i in range(len(texts))]


def test_order_matters_after_training(spark, small):
    rng = random.Random(5)
    docs = spark.createDataFrame([(i, chain(rng, 400)) for i in range(200)], "doc_id long, text string").repartition(2)
    model, _ = pl.learn(docs)
    fresh = [chain(rng, 300) for _ in range(10)]
    held = fresh + [" ".join(rng.sample(t.split(), 300)) for t in fresh]
    got = means(spark, model, held)
    assert min(got[:10]) > max(got[10:]) + 0.2
    base = means(spark, pl.Model(model.vocabulary, pl.Network.fresh(model.vocabulary), model.rare), held)
    assert all(got[i] > base[i] + 0.3 for i in range(10))


def test_words_of_one_frequency_are_told_apart(spark, small):
    """"cat" and "bus" are equally frequent, but each has neighbours of its own."""
    rng = random.Random(6)
    sentences = ["the grey cat sat on warm mats", "a yellow bus ran to big cities"]
    docs = spark.createDataFrame(
        [(i, " ".join(s for _ in range(30) for s in rng.sample(sentences, 2))) for i in range(200)], "doc_id long, text string"
    )
    model, _ = pl.learn(docs)
    right, wrong = means(spark, model, [" ".join(sentences * 5), " ".join(sentences * 5).replace("cat", "*").replace("bus", "cat").replace("*", "bus")])
    assert right > wrong + 0.3


def test_rare_words_have_their_own_frequencies(spark, monkeypatch):
    monkeypatch.setattr(pl, "LEAST", 3)
    monkeypatch.setattr(pl, "PER_POWER", 0)
    monkeypatch.setattr(pl, "HELD", 2)
    texts = ["a b c a b c a b c x y", "a b c x z", None, "", "a y x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    counts = pl.counted(docs, "text")
    want = collections.Counter(w for t in texts if t for w in t.split())
    hashes = {w: int(Words([w.encode()]).hashes.view(np.int64)[0]) for w in want}
    assert {r.word: r.n for r in counts.collect()} == {hashes[w]: n for w, n in want.items()}
    v, total, rare = pl.vocabulary_of(counts)
    assert total == sum(want.values()) and rare.count() == 3 and v.size == 4 and v.rare_mass == 6 + 4 * pl.UNKNOWN
    model = pl.Model(v, pl.Network.fresh(v), rare)
    rows = {r.doc_id: r for r in pl.scored(pl.numbered(docs, v), model).collect()}
    mass = {w: n + 0.5 for w, n in want.items()}
    whole = sum(mass[w] for w in "abc") + v.rare_mass
    for i, text in enumerate(texts):
        words = text.split() if text else []
        assert rows[i].n_words == len(words)
        assert abs(rows[i].log_likelihood - sum(math.log(mass[w] / whole) for w in words)) < 1e-4
    unknown, = means(spark, model, ["unseen"])
    assert abs(unknown - math.log(0.5 / whole)) < 1e-4


def test_vocabulary_grows_with_the_corpus(spark):
    sizes = []
    for n in (2000, 40000):
        counts = spark.range(n).selectExpr("id AS word", "1000 + id AS n")
        v, total, rare = pl.vocabulary_of(counts)
        assert v.size - 1 + rare.count() == n and v.size - 1 <= max(pl.LEAST, pl.PER_POWER * total**pl.POWER)
        sizes.append(v.size)
    assert sizes[1] > 2 * sizes[0] > 1000


def test_average_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(pl, "FAN_IN", 3)
    rows = [(i, s, i + 1, np.full(4 - s, i + 100 * s, np.float32).tobytes()) for i in range(20) for s in range(2)]
    flat = pl.averaged(spark.createDataFrame(rows, pl.SLICES), 20)
    want = sum(i * (i + 1) for i in range(20)) / sum(range(1, 21))
    assert np.allclose(flat, [want] * 4 + [want + 100] * 3, atol=1e-4)
    assert pl.averaged(spark.createDataFrame([], pl.SLICES), 20) is None


def test_edges(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "a b"), (4, "a b c d"), (4, "a b c d"), (5, "a " * 40000)]
    docs = spark.createDataFrame([(i, t, 1.0, 7) for i, t in rows], "doc_id long, text string, mean double, row long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = op8_pseudolik(spark, str(tmp_path)).collect()
    assert len(got) == 7
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add((r.n_words, r.log_likelihood, r.mean_log_likelihood))
    assert by[1] == by[2] == by[3] == {(0, 0.0, None)} and len(by[4]) == 1 and next(iter(by[5]))[0] == 40000
    assert pl.pseudo_likelihood(docs.limit(0)).count() == 0
