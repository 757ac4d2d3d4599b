"""Each stage of the pipeline against brute force on its own input, and the whole run against the stages."""

import random
import re
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest

from tastegraph.llm import quality
from tests.llm import test_decontaminate, test_neardup, test_packing, test_pii, test_quality

# names that the operators use inside
CLASHING = ["id", "row", "rank", "key", "comp", "_gone", "_twice", "_rank", "_k1", "_k2", "_id", "_text", "start", "length", "found", "item_id", "N"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(f"`{c}` int" for c in CLASHING)
CLEAN = range(1000, 1030)


def tables():
    rng = random.Random(4)
    graded = test_quality.corpus(450)
    vocabulary = sorted({w for _, t, g in graded if g == 2 for w in t.split()})
    items = [(i, " ".join(rng.choices(vocabulary, k=20))) for i in range(6)] + [(6, None), (7, ""), (8, "zzpair qqpair")]
    texts = [(i, t) for i, t, _ in graded]
    base = {i: rng.choices(vocabulary, k=120) for i in CLEAN}
    texts += [(i, " ".join(w)) for i, w in base.items()]
    for i, own in base.items():
        if i % 3 == 0:  # exact and near copies
            near = list(own)
            near[60] = "other"
            texts += [(i + 1000, " ".join(own).upper()), (i + 2000, " ".join(near))]
    hot = rng.choices(vocabulary, k=150)
    for i in range(250):  # a third of all rows
        own = list(hot)
        for _ in range(rng.randint(0, 2)):
            own[rng.randrange(150)] = rng.choice(vocabulary)
        texts.append((5000 + i, " ".join(own)))
    for i in range(6):  # benchmark passages that make up more and less than a twentieth
        for size in (100, 500):
            own = rng.choices(vocabulary, k=size)
            texts.append((6000 + size + i, " ".join([*own[:50], items[i][1], *own[50:]])))
    texts += [
        (7000, "mail a.b@example.org or 10.0.0.1 now " + " ".join(rng.choices(vocabulary, k=160))),
        (7001, "+49 (30) 1234-5678 4539578763621486 " + " ".join(rng.choices(vocabulary, k=160))),
        (7002, " ".join(rng.choices(vocabulary, k=30000))),
        (7003, None), (7004, ""), (7005, " \n"),
        (7006, " ".join(rng.choices(vocabulary, k=60))), (7006, " ".join(rng.choices(vocabulary, k=60))),
        (None, " ".join(rng.choices(vocabulary, k=60))),
    ]
    rows = [
        (i, t, None if n % 9 == 0 else "en", None if n % 7 == 0 else "web", None if t is None else len(t), *([n % 5] * len(CLASHING)))
        for n, (i, t) in enumerate(texts)
    ]
    rows += [rows[-3], rows[-3]]  # repeated rows
    labels = [(i, int(g > 0), int(g == 1)) for i, _, g in graded] + [(None, 1, 0), (3, None, 1), (99999, 0, 0)]
    return rows, labels, items


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    rows, labels, items = tables()
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def mask(text):
    """Base kinds only: the texts of the fixture hold no others."""
    at, parts = 0, []
    for kind, start, end in test_pii.brute(text):
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def good(rows, labels):
    """A model fitted and applied without Spark, one text at a time."""
    graded = {i: 0 if q == 0 else 1 if t else 2 for i, q, t in labels if i is not None and q is not None}
    known = [(t, graded[i]) for i, t, *_ in rows if i in graded and t and t.strip()]
    features = quality.features([t.encode() for t, _ in known])
    pairs = sorted(zip([g for _, g in known], features, strict=True), key=lambda p: (p[0], p[1].tobytes()))
    model = quality.fit([f for _, f in pairs], [g for g, _ in pairs])
    score = quality.scorer(model, quality.TAIL)
    return [r for r in rows if r[1] is not None and score([r[1].encode()])[2][0]]


def survivors(rows):
    return {d for d, _, _, kept in test_neardup.brute([r[:2] for r in rows], 5) if kept}


def test_stages_and_run(spark, folder, tmp_path):
    rows, labels, items = tables()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    held = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        held[name] = [tuple(r) for r in docs.collect()]

    assert Counter(held["quality"]) == Counter(good(rows, labels))
    ids = {r[0] for r in held["quality"]}
    assert set(CLEAN) <= ids and None in ids and not ids & {7003, 7004, 7005}

    before, after = held["quality"], held["near_duplicates"]
    assert not Counter(after) - Counter(before)
    assert Counter(r[0] for r in after) == Counter({i: 1 for i in survivors(before)})
    assert sum(5000 <= (r[0] or 0) < 5250 for r in after) == 1 and set(CLEAN) <= {r[0] for r in after}

    before, after = after, held["decontamination"]
    judged = test_decontaminate.brute([r[:2] for r in before], items)
    assert Counter(after) == Counter(r for r, j in zip(before, judged, strict=True) if not j[-1])
    assert {r[0] for r in before} - {r[0] for r in after} == {6100 + i for i in range(6)}

    before, after = after, held["pii"]
    masked = [(r[0], mask(r[1]), r[2], r[3], len(mask(r[1])), *r[5:]) for r in before]
    assert Counter(after) == Counter(masked)
    assert sum("[EMAIL]" in r[1] and "[IP]" in r[1] for r in after) == 1

    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    end = np.array([2], "<u4").tobytes()
    ids_of = {r[0]: np.array(tokenizer.encode(r[1], add_special_tokens=False).ids, "<u4").tobytes() + end for r in after}
    found = corpus_pipeline.run(spark, folder).collect()
    test_packing.check([tuple(r) for r in found], ids_of, 4096)


def test_stages_of_an_empty_table(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "pii", "packing"]
    assert all(re.fullmatch("[a-z_]+", n) for n, _ in corpus_pipeline.STAGES)
