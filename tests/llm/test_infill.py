import hashlib
import random

import numpy as np
import pytest

from tastegraph.llm import infill
from tastegraph.llm.queries import op12_infill

BLANKS = " \t\x0b\x0c\r\n"


def unit_starts(text, unit):
    if unit == "char":
        return list(range(len(text)))
    if unit == "line":
        return [i for i in range(len(text)) if i == 0 or text[i - 1] == "\n"]
    return [i for i in range(len(text)) if text[i] not in BLANKS and (i == 0 or text[i - 1] in BLANKS)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(doc_id, text, unit="char"):
    text = text or ""
    digest = sha(f"1:{'null' if doc_id is None else doc_id}")
    h = [int(digest[at : at + 8], 16) for at in range(0, 32, 8)]
    starts = unit_starts(text, unit)
    n = len(starts)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = ((starts + [len(text)])[k] for k in (low, high))
    parts = ("<P>", text[:a]), ("<S>", text[b:]), ("<M>", text[a:b])
    form = "spm" if h[3] % 100 < 20 else "psm"
    order = (1, 0, 2) if form == "spm" else (0, 1, 2)
    return doc_id, n, form, a, b - a, "".join("".join(parts[p]) for p in order)


def cases():
    rng = random.Random(12)
    letters = ["a", "é", "漢", "😀", "é", " ", "\n", "\t", "<", ">", "P", "S", "M", "\x00", " "]
    texts = ["".join(rng.choices(letters, k=rng.choice([1, 2, 5, 40, 300]))) for _ in range(400)]
    texts += [None, "", "", " ", "\n", "\n\n", "x<P>y", "<M>", "<", "<<S", "same", "same", "漢" * 90_000, "ab c\n" * 50_000]
    return list(enumerate(texts)) + [(3, "an id twice"), (3, "an id twice"), (None, "no id"), (None, None), (-7, "below zero")]


@pytest.mark.parametrize("unit", ["char", "word", "line"])
def test_equals_brute_force(spark, unit):
    docs = cases()
    frame = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, n int, output string")
    got = sorted(((*r[:5], r.output.decode()) for r in infill.infill(frame, unit).collect()), key=repr)
    assert got == sorted((brute(d, t, unit) for d, t in docs), key=repr)
    assert {"plain", "psm", "spm"} == {r[2] for r in got}
    assert all(infill.restored(out.encode(), form) == (text or "").encode() for (_, text), (_, _, form, _, _, out) in
               ((case, brute(*case, unit)) for case in docs))


def test_query(spark, tmp_path):
    docs = cases()
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, op12_infill(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted(((*row[:5], sha(row[5]), sha(t or "")) for row, t in ((brute(d, t), t) for d, t in docs)), key=repr)


def test_empty_table(spark):
    assert infill.digested(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_ranks():
    rng = np.random.default_rng(5)
    for size in (0, 1, 63, 64, 65, 1000):
        values = rng.integers(0, 8, size).astype(np.uint8)
        matrix, places = infill.WaveletMatrix(values), np.arange(size + 1)
        for value in range(8):
            assert matrix.rank(value, places).tolist() == np.concatenate(([0], np.cumsum(values == value))).tolist()
