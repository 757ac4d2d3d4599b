"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the anchors of a text: at-signs, plus signs, digits, ``://`` and words
that announce an account number. Small deterministic parsers then expand each anchor to the left and
right, check the boundaries and validate what they found. One pass over the text, whatever its length;
there is no shuffle, and a row never meets another row.

Kinds: ``email``, ``ip``, ``card`` and ``phone`` are the base kinds, found exactly as the leftmost
non-overlapping matches of their patterns. ``url`` (an address that carries a user name and a password)
and ``account`` (an account number after its cue, an IBAN checked modulo 97) are added beside them.

Edge cases: a null or empty text has no spans; repeated rows are searched one by one; an empty table gives
an empty result; further columns of any name pass through ``redact`` untouched.
"""

from __future__ import annotations

import re
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The kinds in the order in which spans with the same start are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account")
SPAN_TYPE = T.ArrayType(
    T.StructType().add("kind", T.StringType()).add("start", T.LongType()).add("end", T.LongType())
)
SPAN_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

# Words that announce an account number.
ACCOUNT_CUES = ("iban", "account", "acct", "konto", "compte", "cuenta")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
QUAD = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CHAIN = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
DIAL = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
LOGIN = re.compile(r"[^\s/@:]+:[^\s/@]+@[A-Za-z0-9.-]+(?::[0-9]+)?")
AFTER_CUE = re.compile(r"(?:\x20?(?:no\.?|number|nr\.?|n°))?[\x20:#=.]{0,3}")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
NUMBER = re.compile(r"[0-9](?:[\x20-]?[0-9]){5,17}(?![0-9])")
DATE = re.compile(r"(?:1[0-9]|2[01])[0-9]{2}([\x20-])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([\x20-])[0-9]{1,2}\2(?:1[0-9]|2[01])[0-9]{2}")
THOUSANDS = re.compile(r"[1-9][0-9]{0,2}(?:\x20[0-9]{3})+")


@cache
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, "digit")
    for word, anchor in (("@", "at"), ("+", "plus"), ("://", "scheme")):
        found.add_word(word, anchor)
    for cue in ACCOUNT_CUES:
        for form in (cue, cue.upper(), cue.capitalize()):
            found.add_word(form, form)
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _left(text: str, at: int, stop: int, allowed: frozenset) -> int:
    """The start of the run of allowed characters that ends before ``at``, not before ``stop``."""
    while at > stop and text[at - 1] in allowed:
        at -= 1
    return at


def _starts_word(text: str, at: int) -> bool:
    return at == 0 or not text[at - 1].isalnum()


def _iban(text: str) -> bool:
    code = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _account(text: str, after: int) -> tuple[int, int] | None:
    start = AFTER_CUE.match(text, after).end()
    found = IBAN.match(text, start)
    while found:
        # An upper-case word may follow the number: give up groups from the right until the check fits.
        if _iban(found.group()):
            return found.span()
        cut = found.group().rfind(" ")
        found = IBAN.match(text, start, start + cut) if cut > 0 else None
    plain = NUMBER.match(text, start)
    if not plain or DATE.fullmatch(plain.group()):
        return None
    # After a bare cue, groups of three digits are a quantity.
    if not text[after:start].strip(" ") and THOUSANDS.fullmatch(plain.group()):
        return None
    return plain.span()


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points, end exclusive, by start and then by kind."""
    out: list[tuple[str, int, int]] = []
    if not text:
        return out
    done = dict.fromkeys(KINDS, 0)
    for end, anchor in _automaton().iter(text):
        if anchor == "digit":
            if end >= done["card"] and (chain := CHAIN.match(text, end)):
                done["card"] = chain.end()
                # 19 digits and a separator before each but the first are the longest that can pass.
                if chain.end() - end <= 37:
                    digits = chain.group().replace(" ", "").replace("-", "")
                    if 12 <= len(digits) <= 19 and luhn(digits):
                        out.append(("card", *chain.span()))
            # Only the start of a run of digits can start an address.
            if end >= done["ip"] and (end == 0 or not "0" <= text[end - 1] <= "9" or end == done["ip"]):
                if quad := QUAD.match(text, end):
                    done["ip"] = quad.end()
                    if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in quad.group().split(".")):
                        out.append(("ip", *quad.span()))
        elif anchor == "at":
            start = _left(text, end, done["email"], LOCAL)
            if start < end and (domain := DOMAIN.match(text, end + 1)):
                done["email"] = domain.end()
                out.append(("email", start, domain.end()))
        elif anchor == "plus":
            if end >= done["phone"] and (dial := DIAL.match(text, end)):
                done["phone"] = dial.end()
                # 15 digits may stand between any number of other signs.
                if 9 <= sum("0" <= c <= "9" for c in dial.group()) <= 15:
                    out.append(("phone", *dial.span()))
        elif anchor == "scheme":
            start = _left(text, end - 2, done["url"], SCHEME)
            if start < end - 2 and (login := LOGIN.match(text, end + 1)):
                done["url"] = login.end()
                out.append(("url", start, login.end()))
        elif end >= done["account"] and _starts_word(text, end - len(anchor) + 1) and (span := _account(text, end + 1)):
            done["account"] = span[1]
            out.append(("account", *span))
    out.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return out


def mask(text: str | None) -> str | None:
    """The text with each span, overlapping ones merged, replaced by ``[KIND]`` of its first kind."""
    found = spans(text)
    if not found:
        return text
    parts, at = [], 0
    for kind, start, end in found:
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


@F.arrow_udf(SPAN_TYPE)
def find_spans(text: pa.Array) -> pa.Array:
    """Column of spans of a text column."""
    rows = [[{"kind": k, "start": s, "end": e} for k, s, e in spans(t)] for t in text.to_pylist()]
    return pa.array(rows, type=SPAN_ARROW)


@F.arrow_udf(T.StringType())
def masked(text: pa.Array) -> pa.Array:
    """Column of masked texts; null stays null."""
    return pa.array([mask(t) for t in text.to_pylist()], type=pa.string())


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The same rows with the personal data of ``text`` masked; all other columns as they are."""
    return docs.withColumn(text, masked(F.col(text)))
