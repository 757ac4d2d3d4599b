import hashlib
import random

import numpy as np
import pytest

from tastegraph.llm import suffixes
from tastegraph.llm.queries import op10_suffixes


def brute(docs, length=100):
    """Per document from a table of all strings."""
    first = {}
    for doc, text in docs:
        data = (text or "").encode()
        for s in range(len(data) - length + 1):
            place = (doc is not None, doc or 0, s)
            w = data[s : s + length]
            first[w] = min(first.get(w, place), place)
    out = []
    for doc, text in docs:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for s in range(len(data) - length + 1):
            if first[data[s : s + length]] < (doc is not None, doc or 0, s):
                gone[s : s + length] = True
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = int(np.sum(gone[:-1] & ~np.concatenate(([False], gone[:-2])))) if len(data) else 0
        out.append((doc, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def cases(seed, count=120):
    rng = random.Random(seed)
    words = ["the ", "of ", "and é", "Thing. ", "x", "\n", "ñandú ", "zeta"] + ["".join(rng.choices("abcdefgh ", k=7)) for _ in range(40)]

    def prose(n):
        return "".join(rng.choice(words) for _ in range(n))

    passages = [prose(rng.randint(15, 60)) for _ in range(6)]
    docs = []
    for i in range(count):
        text = prose(rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            text += p[a // 3 :] + prose(rng.randint(0, 20))
        docs.append((i, text))
    for i in range(count, count + 60):  # a third of the rows: one text with few changes
        own = list(passages[0] * 3)
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(len(own))] = rng.choice("qwz")
        docs.append((i, "".join(own)))
    docs += [(900, None), (901, ""), (902, "a" * 99), (903, "a" * 100), (904, "a" * 101), (905, "ab" * 700), (906, "é" * 300)]
    docs += [docs[3], docs[3], (3, docs[5][1]), (None, docs[6][1]), (-5, docs[7][1])]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("hot", [suffixes.HOT, 8])
def test_equals_brute_force(spark, hot):
    docs = cases(1)
    frame = spark.createDataFrame([(d, t, 1, b"x") for d, t in docs], "doc_id long, text string, row int, id binary")
    got = suffixes.without_repeats(frame, hot=hot).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute(docs)
    for r in got:
        assert sum(e - s for s, e in r.spans) == r.n_removed


def test_random_small_alphabet(spark):
    rng = random.Random(9)
    docs = [(i, "".join(rng.choice("ab") for _ in range(rng.randint(0, 40))) * rng.randint(1, 8)) for i in range(150)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = suffixes.without_repeats(frame).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute(docs)


def test_merge_gives_order_and_prefixes():
    rng = random.Random(2)
    for runs in (1, 2, 3, 7, 20):
        lists = [sorted("".join(rng.choice("ab") for _ in range(rng.randint(1, 12))).encode() for _ in range(rng.randint(1, 30))) for _ in range(runs)]
        got = list(suffixes.merged([suffixes.Run(*suffixes.front_coded(x)) for x in lists]))
        want = sorted(s for x in lists for s in x)
        assert [g[2] for g in got] == want
        assert all(lists[r][e] == s for r, e, s, _ in got)
        assert [g[3] for g in got[1:]] == [suffixes.shared_prefix(a, b, 0) for a, b in zip(want, want[1:])]


def test_long_text_in_segments(monkeypatch):
    rng = random.Random(4)
    text = bytes(rng.choice(b"abcd") for _ in range(5000))
    whole = suffixes.Anchored([text], 100)
    monkeypatch.setattr(suffixes, "SEGMENT", 700)
    parts = suffixes.Anchored([text], 100)
    cover = lambda a: {(p - d, p) for p, lo, hi in zip(a.at.tolist(), a.low.tolist(), a.high.tolist()) for d in range(lo, hi + 1)}
    assert cover(whole) == cover(parts) and len(cover(whole)) == 4901


def test_empty_table(spark):
    assert suffixes.without_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark, tmp_path):
    docs = cases(5, 60)
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted((tuple(r) for r in op10_suffixes(spark, str(tmp_path)).collect()), key=str) == brute(docs)
