import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from tastegraph.llm import packing
from tastegraph.llm.queries import op5_packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_word_ids_equal_the_tokenizer(tokenizer):
    rng = random.Random(5)
    signs = ["a", "Éa", "İ", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "'s", "<|endoftext|>", "é", "\u0301", "12", "!?", "ß", "漢", "👍🏽",
             ".", ",", "don't", "\x00", "¨", "H\u0331", "Σ", "ς", "²", "Ⅷ", "K", "THE"]
    words = packing.WordIds(PATH, words=50)
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    got = words.ids([t.encode() for t in texts] + [None])
    for text, ids in zip(texts, got, strict=False):
        assert np.frombuffer(ids, packing.IDS).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
    assert got[-1] == b""


def least(counts, window, size):
    """The level by trying each one."""
    def squares(c):
        return sum(v * v for k, v in c.items() if 0 < k < window)

    best = None
    for level in range(0, window - size + 1):
        if level and not counts.get(level):
            continue
        after = dict(counts)
        if level:
            after[level] -= 1
        after[level + size] = after.get(level + size, 0) + 1
        key = (squares(after), -level)
        best = min(best or (key, level), (key, level))
    return best[1]


def test_marks_in_other_cases(tokenizer):
    texts = ["<|ENDOFTEXT|>", "x<|EndOfText|>Y And <|endoftext|> Z", "<|StartOfText|> A", "a <|ENDOFTEXT|> B <|endoftext|>"]
    for text, ids in zip(texts, packing.WordIds(PATH).ids([t.encode() for t in texts]), strict=True):
        assert list(np.frombuffer(ids, np.uint32)) == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_levels_follow_the_rule():
    rng = random.Random(1)
    packer = packing.Packer(window=32)
    for doc in range(600):
        size = rng.choice([1, 3, 7, 11, 16, 20, 31, rng.randint(1, 31)])
        counts = {k: int(v) for k, v in enumerate(packer.count) if v}
        assert packer.level_for(size) == least(counts, 32, size)
        packer.add(doc, bytes(4 * size))


def check(rows, ids_of, window):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r[0]].append(r)
        sequences[r[5]].append(r)
    assert set(pieces) == set(ids_of)
    for doc, ids in ids_of.items():
        at = 0
        for _, start, length, crc, total, *_ in sorted(pieces[doc], key=lambda r: r[1]):
            assert (start, total) == (at, len(ids) // 4) and length > 0
            assert zlib.crc32(ids[4 * start : 4 * (start + length)]) == crc
            at += length
        assert at == len(ids) // 4
    for held in sequences.values():
        at = 0
        for r in sorted(held, key=lambda r: r[6]):
            assert r[6] == at
            at += r[2]
        assert at <= window and at & (at - 1) == 0


@pytest.mark.parametrize("most", [3, 4096])
def test_pieces_cover_each_document_once(most):
    rng = random.Random(2)
    packer = packing.Packer(window=64, open_windows=most)
    ids_of = {d: np.arange(rng.choice([1, 5, 63, 64, 65, 200, rng.randint(1, 300)]), dtype="<u4").tobytes() for d in range(400)}
    for doc, ids in ids_of.items():
        packer.add(doc, ids)
    packer.drain()
    check(packer.out, ids_of, 64)


def test_query(spark, tmp_path, tokenizer):
    texts = [None, "", "one two", "ha! " * 9000, "one two", *(f"word{i} and more " * (i * 7) for i in range(40))]
    spark.createDataFrame(
        [(i, t, 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, start long, length long"
    ).write.parquet(f"{tmp_path}/documents.parquet")
    rows = [tuple(r) for r in op5_packing(spark, str(tmp_path)).collect()]
    end = np.array([2], "<u4").tobytes()
    ids_of = {i: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() + end for i, t in enumerate(texts)}
    check(rows, ids_of, 4096)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert packing.pack(docs.limit(0), PATH).count() == 0
