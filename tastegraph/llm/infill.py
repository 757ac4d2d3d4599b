"""Fill-in-the-middle examples: two cuts in a text, and its three parts in another order between marks.

A cut is given in units of a text: code points, words or lines. Texts are UTF-8 bytes of ``CLASSES`` character classes, and a
wavelet matrix over the classes of a whole chunk of texts answers, for many texts at once, how many bytes of a class lie
before a position. Every unit begins with a byte of certain classes, so the number of unit boundaries before a position is
a sum of ranks, and the place of the k-th boundary is found by bisection on that sum. No text is decoded or cut into units.

The order of the parts and the cuts come from the sha256 of ``1:`` and the document's id, so an example depends on nothing but
its own row, and a task that is run again gives the same.

Edge cases: a null text is empty; an empty text, or one in which a mark occurs, stays as it is (``plain``); equal
texts under different ids are cut at different places, rows with equal ids and texts alike; a null id counts as the word
``null``; very long texts are handled alone, with some ten bytes per byte of text; an empty table gives no examples; columns of
other names play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# The marks, the share of texts cut at all, the share of those with the suffix first.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
CUT_PERCENT, SUFFIX_FIRST_PERCENT = 90, 20
CHUNK_BYTES = 4 << 20

# Classes of bytes; those of blanks and line ends stand for themselves, the others tell what a byte begins.
INSIDE, BLANK, LINE_END, IN_WORD, WORD, LINE, LINE_BLANK, LINE_LINE_END = range(8)
BITS = 3
# The classes that begin a unit.
UNITS = {
    "char": (BLANK, LINE_END, IN_WORD, WORD, LINE, LINE_BLANK, LINE_LINE_END),
    "word": (WORD, LINE),
    "line": (LINE, LINE_BLANK, LINE_LINE_END),
}
BREAKS = bytes([9, 11, 12, 13, 32])
FIELDS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary"


class Bits:
    """Bits with rank: how many of the first ``p`` are set."""

    def __init__(self, bits: np.ndarray):
        packed = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
        some = np.packbits(bits, bitorder="little")
        packed[: len(some)] = some
        self.words = packed.view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def rank(self, p: np.ndarray) -> np.ndarray:
        word, low = p >> 6, np.uint64(1) << (p & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & (low - np.uint64(1)))


class WaveletMatrix:
    """A sequence of small numbers, bit by bit from the highest; at each bit the zeros go before the ones, in their order."""

    def __init__(self, values: np.ndarray, bits: int = BITS):
        self.levels: list[tuple[Bits, int]] = []
        for bit in range(bits - 1, -1, -1):
            ones = (values >> bit & 1).astype(bool)
            self.levels.append((Bits(ones), int(len(values) - np.count_nonzero(ones))))
            values = np.concatenate((values[~ones], values[ones]))

    def rank(self, value: int, p: np.ndarray) -> np.ndarray:
        """How many of the first ``p`` numbers equal ``value``."""
        low = np.zeros_like(p)
        for at, (bits, zeros) in enumerate(self.levels):
            ones, ones_low = bits.rank(p), bits.rank(low)
            if value >> (len(self.levels) - 1 - at) & 1:
                p, low = zeros + ones, zeros + ones_low
            else:
                p, low = p - ones, low - ones_low
        return p - low


def classes(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The class of each byte; ``starts`` are the first bytes of texts."""
    of_byte = np.full(256, IN_WORD, np.uint8)
    of_byte[128:192] = INSIDE
    of_byte[list(BREAKS)] = BLANK
    of_byte[10] = LINE_END
    found = of_byte[data]
    after = np.empty_like(found)
    after[1:] = found[:-1]
    starts = starts[starts < len(data)]
    after[starts] = LINE_END
    found[(found == IN_WORD) & ((after == BLANK) | (after == LINE_END))] = WORD
    first = after == LINE_END
    for plain, begun in ((WORD, LINE), (BLANK, LINE_BLANK), (LINE_END, LINE_LINE_END)):
        found[first & (found == plain)] = begun
    return found


class Boundaries:
    """Unit boundaries of texts."""

    def __init__(self, texts: list[bytes], unit: str = "char"):
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.matrix = WaveletMatrix(classes(np.frombuffer(b"".join(texts), np.uint8), self.starts))
        # the classes that do not begin a unit are counted where they are fewer
        every, chosen = set(range(1 << BITS)), set(UNITS[unit])
        self.inverse = len(chosen) > len(every) // 2
        self.counted = sorted(every - chosen if self.inverse else chosen)
        self.base = self._before(self.starts)
        self.total = self._before(self.ends) - self.base

    def _before(self, p: np.ndarray) -> np.ndarray:
        found = sum(self.matrix.rank(c, p) for c in self.counted)
        return p - found if self.inverse else found

    def place(self, k: np.ndarray) -> np.ndarray:
        """Where in each text the first ``k`` units end, in bytes: before unit ``k``, or at the end of the text."""
        low, high = self.starts.copy(), self.ends.copy()
        want = self.base + k
        # the largest position with no more than k boundaries before it
        while (low < high).any():
            middle = (low + high + 1) >> 1
            fits = self._before(middle) <= want
            low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
        return low - self.starts

    def units_before(self, place: np.ndarray) -> np.ndarray:
        return self._before(self.starts + place) - self.base


def draws(doc_id: int | None) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits that depend on the id alone."""
    found = hashlib.sha256(b"1:" + (b"null" if doc_id is None else str(doc_id).encode())).digest()
    return tuple(int.from_bytes(found[at : at + 4], "big") for at in range(0, 16, 4))


def marked(text: bytes) -> bool:
    return any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE))


def joined(form: str, prefix: bytes, middle: bytes, suffix: bytes) -> bytes:
    if form == "psm":
        return PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle
    return SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle


def restored(output: bytes, form: str) -> bytes:
    """The text of an example. Marks do not occur in a text that was cut, so each is found where it was put."""
    if form == "plain":
        return output
    second = SUFFIX if form == "psm" else PREFIX
    one, rest = output[len(second) :].split(second, 1)
    two, middle = rest.split(MIDDLE, 1)
    prefix, suffix = (one, two) if form == "psm" else (two, one)
    return prefix + middle + suffix


def examples(ids: list[int | None], texts: list[bytes], unit: str = "char") -> Iterator[tuple]:
    """``(n, form, prefix_chars, middle_chars, output)`` of each text; ``n`` counts units."""
    own = Boundaries(texts, unit)
    hashes = np.array([draws(i) for i in ids], np.int64).reshape(len(ids), 4)
    cuts = np.sort(hashes[:, :2] % (own.total + 1)[:, None], axis=1)
    first, second = own.place(cuts[:, 0]), own.place(cuts[:, 1])
    fixed = hashes[:, 2] % 100 >= CUT_PERCENT
    forms = np.where(hashes[:, 3] % 100 < SUFFIX_FIRST_PERCENT, "spm", "psm")
    chars = own if unit == "char" else Boundaries(texts)
    before, inside = chars.units_before(first), chars.units_before(second)
    for at, text in enumerate(texts):
        n = int(own.total[at])
        if not text or fixed[at] or marked(text):
            yield n, "plain", None, None, text
            continue
        form, a, b = str(forms[at]), int(first[at]), int(second[at])
        output = joined(form, text[:a], text[a:b], text[b:])
        yield n, form, int(before[at]), int(inside[at] - before[at]), output


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[list[int | None], list[bytes]]]:
    """Ids and texts of a few rows, or of one long one."""
    ids, texts, size = [], [], 0
    data = batch.column(1).cast(pa.binary())
    for at in range(batch.num_rows):
        text = data[at].as_py() or b""
        if texts and size + len(text) > CHUNK_BYTES:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(batch.column(0)[at].as_py())
        texts.append(text)
        size += len(text)
    if texts:
        yield ids, texts


def infill(docs: DataFrame, unit: str = "char", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)`` of each document; ``output`` is UTF-8."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _chunks(batch):
                made = list(zip(*examples(ids, texts, unit), strict=True))
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
                arrays = [pa.array(ids, pa.int64()), *[pa.array(c, k) for c, k in zip(made, kinds, strict=True)]]
                yield pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in FIELDS.split(", ")])

    own = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return own.mapInArrow(rows, FIELDS)


def digested(docs: DataFrame, **options) -> DataFrame:
    """The examples with digests of the output and of the text restored from it in place of the output."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, back = [], []
            for form, value in zip(batch.column("form"), batch.column("output"), strict=True):
                output = value.as_py()
                out.append(hashlib.sha256(output).hexdigest())
                back.append(hashlib.sha256(restored(output, form.as_py())).hexdigest())
            kept = batch.drop_columns("output")
            yield kept.append_column("output_sha256", pa.array(out)).append_column("restored_sha256", pa.array(back))

    made = infill(docs, **options)
    return made.mapInArrow(rows, FIELDS.replace("output binary", "output_sha256 string, restored_sha256 string"))
