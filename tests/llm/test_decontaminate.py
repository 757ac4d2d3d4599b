import hashlib
import random
import re

import pytest

from tastegraph.llm import decontaminate as dc
from tastegraph.llm.queries import op9_decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window=13):
    out = []
    for doc_id, text in docs:
        have, hit, named = words(text), set(), set()
        for item_id, body in items:
            want = words(body)
            n = min(window, len(want))
            for s in range(len(want) - n + 1 if n else 0):
                for p in range(len(have) - n + 1):
                    if have[p : p + n] == want[s : s + n]:
                        hit.update(range(p, p + n))
                        named.add(str(item_id))
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        bad = len(hit) > 0 and 20 * len(hit) >= len(have)
        out.append((doc_id, len(have), len(hit), len(named), digest, bad))
    return out


def cases():
    rng = random.Random(11)
    vocabulary = ["the", "of", "Éa", "éa", "K", "k", "zeta", "İx", "a1", *(f"w{i}" for i in range(25))]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 12, 13, 14, 30])))) for i in range(1, 18)]
    items += [(90, None), (91, "..."), (92, items[0][1]), (92, items[0][1]), (None, "solo window")]
    docs = [(0, None), (1, ""), (2, "--"), (3, items[5][1].upper() + "!")]
    for i in range(4, 70):
        text = " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))
        for _ in range(rng.randint(0, 3)):
            body = words(rng.choice(items)[1])
            cut = rng.randint(0, len(body))
            text += rng.choice([" ", ", ", "\n"]) + " ".join(body[cut // 2 :]) + " " + rng.choice(vocabulary)
        docs.append((i, text))
    docs += [docs[10], docs[10], (10, "other text"), (None, docs[20][1]), (77, "a " * 30000)]
    return docs, items


@pytest.mark.parametrize("most", [dc.BROADCAST_BYTES, 0])
def test_equals_brute_force(spark, most):
    docs, items = cases()
    frame = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, n_words int, item_id string")
    table = spark.createDataFrame(items, "item_id long, text string")
    # a null item id has no name and so does not count
    want = sorted(brute(docs, [i for i in items if i[0] is not None]), key=str)
    rows = dc.contamination(frame, table.where("item_id is not null"), broadcast_bytes=most).collect()
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.contaminated) for r in rows]
    assert sorted(got, key=str) == want
    clean = dc.decontaminate(frame, table.where("item_id is not null"), broadcast_bytes=most)
    assert clean.columns == frame.columns
    assert sorted([(r.doc_id, r.text) for r in clean.collect()], key=str) == sorted([d for d, w in zip(docs, brute(docs, [i for i in items if i[0] is not None])) if not w[-1]], key=str)


def test_null_item_id_still_hits(spark):
    docs = spark.createDataFrame([(1, "a solo window")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "solo window")], "item_id long, text string")
    row = dc.contamination(docs, items).first()
    assert (row.n_hit, row.n_items, row.contaminated) == (2, 0, True)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert dc.contamination(docs.limit(0), items).count() == 0
    row = dc.contamination(docs, items.limit(0)).first()
    assert (row.n_words, row.n_hit, row.contaminated) == (2, 0, False)


def test_query(spark, tmp_path):
    docs, items = cases()
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([i for i in items if i[0] is not None], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = [tuple(r) for r in op9_decontaminate(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(brute(docs, [i for i in items if i[0] is not None]), key=str)
