"""Sum-of-squares online packing of token sequences into windows.

Each partition packs its own documents in one pass, so nothing is shuffled. A document's ids first fill
whole windows. The rest of it goes into one partially filled window: a level array counts the open windows
at each fill level, and the document takes the level (0: a new window) for which the sum of squared counts
over the levels strictly between empty and full grows least; ties take the fuller level. A full window is
closed. Windows still open at the end of a partition, or when more than ``open_windows`` are open, are
drained: their pieces are concatenated, cut into full windows, and the tail is cut into sequences whose
lengths are powers of two, which need no padding. So no sequence is padded at all.

Texts become ids word by word: white space never lies inside a token of the vocabulary used here, so the
ids of a text are those of its blank-separated words (ASCII letters in lower case, as in the vocabulary), and
a bounded cache holds the words met.

Edge cases: a null or empty text gives the end id only; repeated rows are packed one by one; an empty table
gives an empty result; further columns are ignored. A text longer than a window spans several sequences.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

WINDOW = 4096
END_ID = 2
CACHE_WORDS = 500_000
# texts that are cut into words at once
TEXTS = 256
OPEN_WINDOWS = 4096

PIECES = (
    T.StructType()
    .add("doc_id", T.LongType())
    .add("start", T.LongType())
    .add("length", T.LongType())
    .add("ids_crc32", T.LongType())
    .add("doc_tokens", T.LongType())
    .add("sequence_id", T.LongType())
    .add("offset", T.LongType())
)
IDS = np.dtype("<u4")
# lead bytes of combining marks, which can change how an ASCII letter before them is composed
MARKS = (b"\xcc", b"\xcd")
# a word of the vocabulary that no other word contains
FENCE = b"\x00"
# Latin letters that stay single letters in lower case
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-įı-ɏ]+")


class WordIds:
    """Ids of whole texts, from the ids of their words.

    A word is learnt once: a point or comma after a letter is a piece of its own in the vocabulary, so the
    ids of ``word,`` are those of ``word`` and ``,``. Words to learn go through the tokenizer together: a word
    of letters is one piece, so the token that ends it tells its ids apart from the next; other words are
    joined by a fence.
    """

    def __init__(self, path: str, words: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.limit = words
        self.added = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # words met since the cache was last full, and those met in the time before
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.fence = self.tokenizer.encode(FENCE.decode(), add_special_tokens=False).ids
        suffix = self.tokenizer.model.end_of_word_suffix
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[n for token, n in vocabulary.items() if token.endswith(suffix)]] = True

    def _joined(self, words: list[str], fence: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([fence.join(words)], add_special_tokens=False)[0].ids, IDS)

    def _learn(self, words: list[bytes]) -> None:
        texts = [w.decode() for w in words]
        letters = [t for t in texts if LETTERS.fullmatch(t)]
        for at in range(0, len(letters), 4096):
            part = letters[at : at + 4096]
            ids = self._joined(part, " ")
            cuts = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            data = ids.tobytes()
            for word, start, end in zip(part, [0, *cuts[:-1]], cuts, strict=True):
                self.known[word.encode()] = data[4 * start : 4 * end]
        others = [t for t in texts if not LETTERS.fullmatch(t)]
        fenced = [t for t in others if FENCE.decode() not in t]
        for at in range(0, len(fenced), 4096):
            part = fenced[at : at + 4096]
            ids = self._joined(part, f" {FENCE.decode()} ")
            cuts = np.flatnonzero(ids == self.fence[0]).tolist()
            data = ids.tobytes()
            for word, start, end in zip(part, [-1, *cuts], [*cuts, len(ids)], strict=True):
                self.known[word.encode()] = data[4 * start + 4 : 4 * end]
        for word in others:
            if FENCE.decode() in word:
                self.known[word.encode()] = self._joined([word], "").tobytes()

    def _meet(self, words: set[bytes]) -> None:
        """Make all of these words known."""
        missing = words.difference(self.known)
        if len(missing) + len(self.known) > self.limit:
            self.known, self.older = {}, self.known
            missing = words
        if self.older:
            again = {word: self.older[word] for word in missing if word in self.older}
            self.known.update(again)
            missing = missing.difference(again)
        split, fresh = [], set()
        for word in missing:
            stem = word.rstrip(b".,")
            if len(stem) < len(word) and stem and LETTERS.fullmatch(stem.decode()[-1]):
                split.append((word, stem, word[len(stem) :]))
                fresh.update(split[-1][1:])
            else:
                fresh.add(word)
        self._learn(list(fresh.difference(self.known)))
        for word, stem, tail in split:
            self.known[word] = self.known[stem] + self.known[tail]

    def ids(self, texts: list[bytes | None]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit numbers."""
        # the tokenizer finds its added tokens before it folds case, so a text in which folding would make one is not folded here
        apart = (*MARKS, *self.added)
        lowered = [(t, t.lower()) if t else (b"", b"") for t in texts]
        rows = [(t if any(m in low for m in apart) else low).split() for t, low in lowered]
        if sum(map(len, rows)) > self.limit // 4 and len(rows) > 1:
            half = len(rows) // 2
            return self.ids(texts[:half]) + self.ids(texts[half:])
        self._meet(set().union(*rows))
        return [b"".join(map(self.known.__getitem__, row)) for row in rows]


_tokenizers: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One tokenizer for each file and worker process."""
    if path not in _tokenizers:
        _tokenizers[path] = WordIds(path)
    return _tokenizers[path]


class Packer:
    """Packs documents in the order of their arrival; sequence ids count up from ``first_id``."""

    def __init__(self, first_id: int = 0, window: int = WINDOW, open_windows: int = OPEN_WINDOWS):
        self.window, self.next_id, self.most = window, first_id, open_windows
        # how many windows are open at each level, and which pieces each of them holds
        self.count = np.zeros(window + 1, np.int64)
        self.levels: dict[int, list[list[tuple]]] = {}
        self.open = 0
        self.out: list[tuple] = []

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            self.out.append((doc, start, n, zlib.crc32(ids), total, self.next_id, offset))
            offset += n
        self.next_id += 1

    def level_for(self, size: int) -> int:
        """The level that takes ``size`` more ids at the least growth of the sum of squared counts."""
        old, new = self.count[: self.window - size + 1], self.count[size:]
        # moving one window from level h to h + size: (c-1)^2 - c^2 and (c'+1)^2 - c'^2
        growth = np.where(old > 0, 2 * (new - old) + 2, np.iinfo(np.int64).max)
        growth[0] = 2 * new[0] + 1  # a new window
        if old[-1] > 0:
            growth[-1] = 1 - 2 * old[-1]  # a full window counts no more
        if size == self.window:
            growth[0] = 0
        return int(len(growth) - 1 - np.argmin(growth[::-1]))

    def add(self, doc: int, ids: bytes) -> None:
        total, span = len(ids) // 4, self.window * 4
        whole = len(ids) - len(ids) % span
        for at in range(0, whole, span):
            self._close([(doc, at // 4, ids[at : at + span], total)])
        rest = ids[whole:]
        if not rest:
            return
        size = len(rest) // 4
        level = self.level_for(size)
        if level:
            group = self.levels[level]
            pieces = group.pop()
            if not group:
                del self.levels[level]
            self.count[level] -= 1
            self.open -= 1
        else:
            pieces = []
        pieces.append((doc, whole // 4, rest, total))
        filled = level + size
        if filled == self.window:
            self._close(pieces)
            return
        self.levels.setdefault(filled, []).append(pieces)
        self.count[filled] += 1
        self.open += 1
        if self.open > self.most:
            self.drain()

    def drain(self) -> None:
        """Close all open windows without padding."""
        stream = [p for level in sorted(self.levels, reverse=True) for pieces in self.levels[level] for p in pieces]
        self.levels, self.open = {}, 0
        self.count[:] = 0
        left = sum(len(p[2]) // 4 for p in stream)
        stream.reverse()
        while left:
            size = min(self.window, 1 << (left.bit_length() - 1))
            left -= size
            pieces = []
            while size:
                doc, start, ids, total = stream.pop()
                n = min(size, len(ids) // 4)
                pieces.append((doc, start, ids[: 4 * n], total))
                if 4 * n < len(ids):
                    stream.append((doc, start + n, ids[4 * n :], total))
                size -= n
            self._close(pieces)

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.out, strict=True)) if self.out else [[]] * len(PIECES)
        self.out = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=PIECES.names)


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per piece of a document: which ids it holds, in which sequence, and where.

    ``tokenizer`` is the path of a tokenizer file, at the same place on each machine, whose tokens never
    hold white space. Sequence ids are the partition number times 2^40 plus a count.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        packer = Packer(TaskContext.get().partitionId() << 40, window)
        words = word_ids(tokenizer)
        end = np.array([END_ID], IDS).tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                bodies = part.column(1).cast(pa.binary()).to_pylist()
                for doc, ids in zip(part.column(0).to_pylist(), words.ids(bodies), strict=True):
                    packer.add(doc, ids + end)
                yield packer.take()
        packer.drain()
        yield packer.take()

    return docs.select(docs[doc_id].cast("long"), docs[text]).mapInArrow(packed, PIECES)
