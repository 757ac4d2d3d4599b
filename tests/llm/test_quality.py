import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastegraph.llm import quality
from tastegraph.llm.queries import op4_quality


def corpus(count, seed=0):
    """Grades 0 (the same words over and over), 1 (prose with a bad word) and 2 (prose)."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(500)]
    bad = ["zzgrim", "zzfoul", "zzvile"]
    docs = []
    for i in range(count):
        grade = i % 3
        own = rng.choices(words, k=rng.randint(40, 200))
        if grade == 0:
            own = [own[0]] * 30 + [own[1].upper() + "!!!"] * 30
        elif grade == 1:
            for _ in range(rng.randint(1, 4)):
                own[rng.randrange(len(own))] = rng.choice(bad)
        docs.append((i, " ".join(own), grade))
    return docs


@pytest.fixture(scope="module")
def model():
    docs = corpus(900)
    return quality.fit(quality.features([t.encode() for _, t, _ in docs]), [g for *_, g in docs])


def test_held_out_accuracy(model):
    docs = corpus(600, seed=1)
    words = corpus(900)
    held = [(t, g) for _, t, g in docs if g != 1] + [(t, g) for _, t, g in words if g == 1][-100:]
    expected, top, kept = quality.scorer(model, 0.5)([t.encode() for t, _ in held])
    grade = np.array([g for _, g in held])
    assert ((grade == 2) == kept).mean() > 0.97
    assert expected[grade == 0].mean() < 0.3 and expected[grade == 2].mean() > 1.8
    assert np.all(np.diff(model.thresholds) > 0)


def test_slopes_equal_differences():
    """The gradient of the fit against numeric differences of the same likelihood."""
    rng = np.random.default_rng(0)
    edges, z, k = np.array([-40.0, -0.7, 1.1, 40.0]), rng.normal(size=50), rng.integers(0, 3, 50)

    def loss(z):
        return -np.log(quality.sigmoid(edges[k + 1] - z) - quality.sigmoid(edges[k] - z))

    upper, lower = quality.sigmoid(edges[k + 1] - z), quality.sigmoid(edges[k] - z)
    slope = (upper * (1 - upper) - lower * (1 - lower)) / (upper - lower)
    assert np.allclose(slope, (loss(z + 1e-6) - loss(z - 1e-6)) / 2e-6, atol=1e-4)


def test_chances_add_up(model):
    chances = model.chances(np.linspace(-50, 50, 11))
    assert np.allclose(chances.sum(1), 1) and (chances >= 0).all()


def test_edges(spark, model):
    rows = [(1, None, "x"), (2, "", "y"), (None, " \n", "z"), (3, "zzfoul " * 50000, "k"), (3, "zzfoul " * 50000, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = quality.graded(docs, model).collect()
    assert len(got) == 5 and not any(r.kept for r in got)
    assert all(r.expected_grade == 0 and r.tail_probability == 0 for r in got if r.doc_id in (None, 1, 2))
    good = quality.select_good(docs.unionByName(spark.createDataFrame([(9, corpus(3)[2][1], "own")], docs.schema)), model)
    assert good.columns == docs.columns and [r.kept for r in good.collect()] == ["own"]
    assert quality.graded(docs.limit(0), model).count() == 0


def test_labels_with_nulls_copies_and_strangers(spark):
    docs = corpus(300)
    frame = spark.createDataFrame([(i, t) for i, t, _ in docs], "doc_id long, text string")
    labels = [(i, g) for i, _, g in docs] + [(5, 0), (None, 1), (7, None), (99999, 2)]
    table = spark.createDataFrame(labels, "doc_id long, grade int")
    model = quality.fit_on(frame, table, F.col("grade"), sample=80)
    assert model.grades == [0, 1, 2]
    again = quality.fit_on(frame.repartition(3), table, F.col("grade"), sample=80)
    assert np.array_equal(model.weights, again.weights)
    none = quality.fit_on(frame, table.limit(0), F.col("grade"))
    assert all(r.kept for r in quality.graded(frame, none).collect())


def test_query(spark, tmp_path):
    docs = corpus(600)
    spark.createDataFrame([(i, t) for i, t, _ in docs], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(g > 0), int(g == 1)) for i, _, g in docs if i % 2]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r.kept for r in op4_quality(spark, str(tmp_path)).collect()}
    assert np.mean([got[i] == (g == 2) for i, _, g in docs]) > 0.97
