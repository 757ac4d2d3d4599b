import hashlib
import random
import re

import pytest

from tastegraph.llm import pii
from tastegraph.llm.queries import op1_pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p.lstrip("0") or "0") <= 255 for p in found.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and pii.luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    found = [
        (k, *m.span()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if passes(k, m.group())
    ]
    return sorted(found, key=lambda s: (s[1], list(PATTERNS).index(s[0])))


def base(text):
    return [s for s in pii.spans(text) if s[0] in pii.BASE_KINDS]


def test_spans_equal_the_patterns_on_random_texts():
    rng = random.Random(3)
    alphabet = ["1", "2", "25", "0", "9", ".", "@", "+", "-", " ", "a", "B", "_", "%", "(", ")", "é", "\n", "://", ":", "٣", "4539578763621486"]
    for _ in range(20000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        assert base(text) == brute(text), text


@pytest.mark.parametrize("text", [None, "", " ", "@", "+", "a@b", "@@a@b.c@d.e", "1.2.3.4.5.6.7.8", "1" * 5000, "+1" * 3000, "a" * 100000 + "@b.c", "é" * 10 + "x@y.z"])
def test_edges(text):
    assert base(text) == brute(text)


def test_added_kinds():
    text = "see ftp://bob:pw1@host.example/x and IBAN: DE89 3704 0044 0532 0130 00 THE END, account no. 12345678."
    found = {k: text[s:e] for k, s, e in pii.spans(text)}
    assert found["url"] == "ftp://bob:pw1@host.example"
    assert "account" in found
    accounts = [text[s:e] for k, s, e in pii.spans(text) if k == "account"]
    assert accounts == ["DE89 3704 0044 0532 0130 00", "12345678"]
    assert [k for k, *_ in pii.spans("take it into account that the https://example.com/a?b=1 is fine")] == []


def test_mask_covers_overlaps():
    assert pii.mask("x a.b@c.de y 10.0.0.1") == "x [EMAIL] y [IP]"
    assert pii.mask("ftp://u:p@h.de/") == "[URL]/"
    assert pii.mask(None) is None


def test_query(spark, tmp_path):
    texts = [None, "", "mail a@b.co and +49 (30) 1234-5678", "1.2.3.4 4539578763621486", "mail a@b.co and +49 (30) 1234-5678"]
    rows = [(i, t, "kind", 7) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, spans string, start long").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op1_pii(spark, str(tmp_path)).collect()}
    assert len(got) == 5
    for i, text in enumerate(texts):
        want = brute(text)
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert got[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert got[i].spans == ",".join(f"{k}:{s}:{e}" for k, s, e in pii.spans(text))
        assert [got[i][f"n_{k}"] for k in PATTERNS] == [sum(w[0] == k for w in want) for k in PATTERNS]


def test_long_runs_of_zeros_in_addresses(spark):
    zeros = "0" * 5000
    texts = [f"{zeros}.1.1.1", f"a {zeros}1.2.{zeros}255.4 b", f"1.2.3.{zeros}256", f"{zeros}.{zeros}.{zeros}.{zeros}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = docs.select("doc_id", pii.find_spans("text").alias("found")).orderBy("doc_id").collect()
    for text, row in zip(texts, found, strict=True):
        assert [s["kind"] for s in row.found if s["kind"] == "ip"] == [k for k, _, _ in brute(text) if k == "ip"]
    assert [sum(s["kind"] == "ip" for s in r.found) for r in found] == [1, 1, 0, 1]


def test_redact_keeps_other_columns(spark):
    docs = spark.createDataFrame([(1, "a@b.co", "x"), (None, None, "y")], "doc_id long, text string, kind string")
    assert [tuple(r) for r in pii.redact(docs).orderBy("kind").collect()] == [(1, "[EMAIL]", "x"), (None, None, "y")]
    assert pii.redact(docs.limit(0)).count() == 0


def test_accounts_need_a_word_of_their_own_and_a_number():
    def accounts(text):
        return [text[s:e] for k, s, e in pii.spans(text) if k == "account"]

    assert accounts("account 2024-01-15 and compte 31 12 2023") == []
    assert accounts("il compte 300 000 habitants, cuenta 1 234 567") == []
    assert accounts("subaccount 12345678, miniban 12345678") == []
    assert accounts("account: 300 000 123, konto 12345678, my_account no. 123-456-789") == ["300 000 123", "12345678", "123-456-789"]


def test_long_texts_take_linear_time():
    import time

    for part in ("IBAN DE89 3704 0044 0532 0130 99 THE ", "account 0000000 ", "0", "1.", "+1 (", "a@", "x://", "konto 300 000 "):
        seconds = []
        for size in (400_000, 1_600_000):
            text = part * (size // len(part))
            start = time.perf_counter()
            pii.spans(text)
            seconds.append(time.perf_counter() - start)
        assert seconds[1] < 9 * seconds[0] + 0.5, (part, seconds)
