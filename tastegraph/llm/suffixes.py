"""Repeated byte strings by a distributed merge sort of suffixes that knows common prefixes.

Every string of ``length`` bytes that also starts earlier (smaller document id, or same document and earlier
start) is found, whole texts, overlaps included; the bytes it covers are removed. Sorting all suffixes is not
needed for that. Each window of ``length`` bytes has an anchor, the leftmost ``GRAM``-byte string in it with the
smallest hash; equal windows have equal anchors at equal offsets, and an anchor serves a run of windows.

1. Anchors that occur only once in all texts are dropped: a task sends each different anchor hash once, with its
   local count, to the hash's bucket; the documents' ids and positions of repeated ones come back.
2. For the rest, a task sorts the suffixes that start at anchors (cut after the last window byte), front-codes each
   sorted run (length of the prefix shared with the one before, and the rest), and sends it with the bytes left of the
   anchor to the bucket of the anchor hash. Equal contexts in one task are sent once.
3. A bucket's runs are merged with a loser tree that holds, for each losing suffix, the prefix it shares with the last
   winner: the one that shares more wins unseen, and equal ones are compared from there on. The merge gives the order
   and all common prefixes. Windows at offset d before the anchor are equal where the suffixes share ``length - d`` bytes
   and the d bytes to the left are equal; all but the earliest are removed.
4. Removed spans are merged per document and cut out.

An anchor with more than ``hot`` occurrences (a passage that very many documents share) is not merged in one task:
its windows are hashed (128 bits) and aggregated with map-side combine. Documents without repeated anchors are never
shuffled while the ids of the others can be broadcast; else texts are joined by id. Nothing is capped.

Edge cases: a null text is empty; texts shorter than ``length`` keep all bytes; a null id sorts before all others; rows
with the same id at the same start are not earlier than each other, so equal rows keep what the first keeps;
an empty table gives an empty result; further columns of any name are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastegraph.llm.wordhash import BASE, RANDOM, in_chunks, mix, powers_to
from tastegraph.plans.durable import durable

LENGTH = 100
GRAM = 24
HOT = 1 << 20
BUCKET_BYTES = 16 << 20
BROADCAST_IDS = 2_000_000
SEGMENT = 8 << 20
BLOCK_ANCHORS = 1 << 21
NO_ID = -(1 << 63)

_POSITION = np.uint64((1 << 24) - 1)

ANCHORS = (
    T.StructType()
    .add("bucket", T.LongType())
    .add("direct", T.BooleanType())
    .add("hashes", T.BinaryType())
    .add("counts", T.BinaryType())
    .add("ids", T.BinaryType())
    .add("at", T.BinaryType())
)
FOUND = T.StructType().add("id", T.LongType()).add("at", T.IntegerType()).add("hot", T.LongType())
RUNS = (
    T.StructType()
    .add("bucket", T.LongType())
    .add("shared", T.BinaryType())
    .add("tails", T.BinaryType())
    .add("sizes", T.BinaryType())
    .add("left", T.BinaryType())
    .add("low", T.BinaryType())
    .add("high", T.BinaryType())
    .add("ids", T.BinaryType())
    .add("rows", T.BinaryType())
    .add("at", T.BinaryType())
    .add("k1", T.LongType())
    .add("k2", T.LongType())
)
STARTS = T.StructType().add("id", T.LongType()).add("row", T.LongType()).add("first", T.LongType()).add("last", T.LongType())


class Anchored:
    """The anchors of a list of texts: ``doc``, ``at`` (position in the text), ``low`` and ``high`` (the windows it
    serves start that many bytes before it), ``hash`` (of its bytes)."""

    def __init__(self, texts: list[bytes], length: int, gram: int = GRAM):
        self.length = length
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.starts = np.cumsum(sizes) - sizes
        up, self.down = powers_to(len(self.data) + 1)
        self.up = up
        steps = np.cumsum(RANDOM[self.data] * up[: len(self.data)], dtype=np.uint64)
        self.sums = np.concatenate((np.zeros(1, np.uint64), steps))
        parts = [self._part(s, min(s + SEGMENT, len(self.data)), sizes, gram) for s in range(0, len(self.data), SEGMENT)]
        whole = np.concatenate(parts, 1) if parts else np.zeros((3, 0), np.int64)
        # a run of windows that two segments share becomes two anchors with one place, which does no harm
        place, first, last = whole
        self.place = place
        self.doc = np.searchsorted(self.starts, place, "right") - 1
        self.at = place - self.starts[self.doc]
        self.low, self.high = place - last, place - first
        self.hash = self.hashes(place, place + gram)

    def _part(self, start: int, end: int, sizes: np.ndarray, gram: int) -> np.ndarray:
        """``(place, first, last)`` of the anchors of the windows that start in ``start:end``."""
        stop = min(end + self.length - 1, len(self.data))
        starts = np.arange(start, stop - gram + 1)
        if len(starts) < self.length - gram + 1:
            return np.zeros((3, 0), np.int64)
        keys = (self.hashes(starts, starts + gram) & ~_POSITION) | (starts - start).astype(np.uint64)
        width, span = self.length - gram + 1, 1
        least = keys
        while 2 * span <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            least = np.minimum(least[: len(keys) - width + 1], least[width - span :])
        inside = np.zeros(len(self.data) + 1, np.int32)
        long = sizes >= self.length
        np.add.at(inside, self.starts[long], 1)
        np.add.at(inside, (self.starts + sizes - self.length + 1)[long], -1)
        windows = np.flatnonzero(np.cumsum(inside)[start : start + len(least)] > 0)
        chosen = (least[windows] & _POSITION).astype(np.int64)
        if not len(chosen):
            return np.zeros((3, 0), np.int64)
        new = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
        last = np.concatenate((new[1:] - 1, [len(chosen) - 1]))
        return np.stack((chosen[new], windows[new], windows[last])) + start

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def keep(self, chosen: np.ndarray) -> None:
        for name in ("place", "doc", "at", "low", "high", "hash"):
            setattr(self, name, getattr(self, name)[chosen])


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def _batch(schema: T.StructType, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "int": pa.int32()}
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    arrays = [pa.array(c, kinds[f.dataType.simpleString()]) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=schema.names)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of batches whose last column is a text, with the texts as bytes."""
    for batch in batches:
        at = 0
        for chunk in in_chunks(batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()):
            yield batch.slice(at, len(chunk)), chunk
            at += len(chunk)


def anchor_blocks(docs: DataFrame, length: int, buckets: int) -> DataFrame:
    """Anchors of rows ``(id, text)``: each different hash of a block once, the others of it marked ``direct``."""

    def block(parts: list[tuple], number: int) -> pa.RecordBatch:
        ids, at, hashes = (np.concatenate(p) for p in zip(*parts, strict=True))
        _, where, counts = np.unique(hashes, return_index=True, return_counts=True)
        first = np.zeros(len(hashes), bool)
        first[where] = True
        count = np.zeros(len(hashes), np.uint32)
        count[where] = np.minimum(counts, 1 << 31)
        rows = []
        bucket, firsts = bucket_of(hashes, buckets), np.flatnonzero(first)
        for b in np.unique(bucket[firsts]).tolist():
            own = firsts[bucket[firsts] == b]
            rows.append((b, False, *(x[own].tobytes() for x in (hashes, count, ids, at))))
        if not first.all():
            rows.append((number % buckets, True, None, None, ids[~first].tobytes(), at[~first].tobytes()))
        return _batch(ANCHORS, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        parts, held, number = [], 0, TaskContext.get().partitionId()
        for batch, chunk in _texts(batches):
            found = Anchored(chunk, length)
            if len(found.hash):
                parts.append((batch.column(0).to_numpy()[found.doc], found.at.astype(np.int32), found.hash))
                held += len(found.hash)
            if held > BLOCK_ANCHORS:
                yield block(parts, number)
                parts, held = [], 0
        if parts:
            yield block(parts, number)

    return docs.mapInArrow(run, ANCHORS)


def repeated_anchors(blocks: DataFrame, hot: int) -> DataFrame:
    """``(id, at)`` of anchors whose hash occurs twice or more; ``hot`` names hashes of more than ``hot`` anchors."""

    def bucket(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        sent = [r for r in rows if not r["direct"]]
        ids, at = ([np.frombuffer(r[n], t) for r in rows if r["direct"]] for n, t in (("ids", np.int64), ("at", np.int32)))
        many = np.zeros(0, np.int64)
        if sent:
            hashes, counts, own, places = (
                np.concatenate([np.frombuffer(r[n], t) for r in sent])
                for n, t in (("hashes", np.uint64), ("counts", np.uint32), ("ids", np.int64), ("at", np.int32))
            )
            values, of = np.unique(hashes, return_inverse=True)
            total = np.bincount(of, counts, len(values))
            again = total[of] > 1
            ids.append(own[again])
            at.append(places[again])
            many = values[total > hot].view(np.int64)
        ids, at = np.concatenate(ids), np.concatenate(at)
        none = [None] * len(many)
        return pa.Table.from_batches([
            pa.RecordBatch.from_arrays([pa.array(ids), pa.array(at), pa.nulls(len(ids), pa.int64())], names=FOUND.names),
            pa.RecordBatch.from_arrays([pa.array(none, pa.int64()), pa.array(none, pa.int32()), pa.array(many)], names=FOUND.names),
        ])

    return blocks.groupBy("bucket").applyInArrow(bucket, FOUND)


def front_coded(strings: list[bytes]) -> tuple[bytes, bytes, bytes]:
    """Sorted strings as ``(shared, tails, sizes)``: the prefix shared with the one before, the rest, and its length."""
    shared, tails, before = bytearray(), [], b""
    for s in strings:
        n = shared_prefix(before, s, 0)
        shared.append(n)
        tails.append(s[n:])
        before = s
    return bytes(shared), b"".join(tails), bytes(map(len, tails))


def shared_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of two strings that are known to share ``known`` bytes."""
    end = min(len(a), len(b))
    if a[known:end] == b[known:end]:
        return end
    n = known
    while a[n] == b[n]:
        n += 1
    return n


class Run:
    """A front-coded sorted run, read from the front: the current string and what it shares with the one before."""

    def __init__(self, shared: bytes, tails: bytes, sizes: bytes):
        self.shared, self.tails, self.sizes = shared, tails, sizes
        self.at, self.offset, self.text = -1, 0, b""
        self.advance()

    def advance(self) -> bool:
        self.at += 1
        if self.at == len(self.shared):
            return False
        size = self.sizes[self.at]
        self.text = self.text[: self.shared[self.at]] + self.tails[self.offset : self.offset + size]
        self.offset += size
        return True


def merged(runs: list[Run]) -> Iterator[tuple[int, int, bytes, int]]:
    """``(run, entry, string, prefix shared with the string before)`` in sorted order, by a loser tree.

    ``shares[r]`` is what the current string of run r shares with the last winner it was compared with on its path,
    so two strings with different values are ordered without a look at their bytes.
    """
    size = 1
    while size < len(runs):
        size *= 2
    over: list[Run | None] = [*runs, *[None] * (size - len(runs))]
    shares = [0] * size

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's share becomes what it shares with the winner."""
        x, y = over[a], over[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        if shares[a] != shares[b]:
            return (a, b) if shares[a] > shares[b] else (b, a)
        n = shared_prefix(x.text, y.text, shares[a])
        first = len(x.text) == n or (len(y.text) > n and x.text[n] < y.text[n])
        if not first or (x.text == y.text and b < a):
            a, b = b, a
        shares[b] = n
        return a, b

    level, node = list(range(size)), size
    # loser at each inner node; node n has the children 2n and 2n + 1, run r is the leaf size + r
    tree: dict[int, int] = {}
    while len(level) > 1:
        node //= 2
        following = []
        for n in range(0, len(level), 2):
            winner, loser = play(level[n], level[n + 1])
            tree[node + n // 2] = loser
            following.append(winner)
        level = following
    champion = level[0]
    while (run := over[champion]) is not None:
        yield champion, run.at, run.text, shares[champion]
        if run.advance():
            shares[champion] = run.shared[run.at]
        else:
            over[champion] = None
        node = (champion + size) // 2
        while node:
            winner, loser = play(champion, tree[node])
            tree[node] = loser
            champion = winner
            node //= 2


def equal_windows(shared: np.ndarray, left: np.ndarray, low: np.ndarray, high: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For suffixes in sorted order, which windows (column d: d bytes before the anchor) have an earlier equal one.

    ``shared``: prefix shared with the suffix before; ``left``: the bytes before the anchor, nearest first; ``order``: the
    rank of ``(id, position)``, equal for equal places.
    """
    out = np.zeros((len(shared), left.shape[1] + 1), bool)
    lefts = np.zeros(len(shared), np.uint64)
    for d in range(left.shape[1] + 1):
        if d:
            lefts = lefts * BASE + RANDOM[left[:, d - 1]]
        own = np.flatnonzero((low <= d) & (high >= d))
        if len(own) < 2:
            continue
        group = np.cumsum(shared < length - d).astype(np.uint64)
        key = mix(mix(lefts[own]) + group[own] * BASE)
        by = np.argsort(key)
        ordered = key[by]
        new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
        least = np.minimum.reduceat(order[own][by], np.flatnonzero(new))
        later = order[own][by] > least[np.cumsum(new) - 1]
        out[own[by[later]], d] = True
    return out


def _intervals(ids, rows, at, gone: np.ndarray) -> pa.RecordBatch:
    """Runs of removed windows as rows of STARTS."""
    edge = np.diff(np.pad(gone.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    record, low = np.nonzero(edge == 1)
    _, after = np.nonzero(edge == -1)
    columns = [ids[record], rows[record], at[record] - after + 1, at[record] - low]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=STARTS.names)


def suffix_runs(docs: DataFrame, length: int, buckets: int, hot: np.ndarray) -> DataFrame:
    """Front-coded sorted runs of the suffixes at repeated anchors of rows ``(id, row, places, text)``.

    Rows without a bucket hold windows of hot anchors (``k1``, ``k2``), or windows removed for an equal context earlier
    in the task (neither); both have arrays of ids, rows and starts, the latter with the number of windows in ``low``.
    """

    def send(records: list[tuple]) -> Iterator[tuple]:
        by: dict[int, list[tuple]] = {}
        for r in records:
            by.setdefault(r[0], []).append(r)
        for bucket, own in by.items():
            own.sort(key=lambda r: r[1])
            shared, tails, sizes = front_coded([r[1] for r in own])
            left = b"".join(r[2] for r in own)
            low, high = bytes(r[3] for r in own), bytes(r[4] for r in own)
            ids, rows, at = (np.array([r[n] for r in own], np.int64).tobytes() for n in (5, 6, 7))
            yield bucket, shared, tails, sizes, left, low, high, ids, rows, at, None, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # (anchor hash, context hash, low, high) -> (id, row, at, bucket, suffix, left)
        kept: dict[tuple, tuple] = {}

        def flush() -> pa.RecordBatch:
            records = [(v[3], v[4], v[5], k[2], k[3], v[0], v[1], v[2]) for k, v in kept.items()]
            kept.clear()
            return _batch(RUNS, list(send(records)))

        for batch, chunk in _texts(batches):
            found = Anchored(chunk, length)
            places = batch.column(2).to_pylist()
            marks = np.concatenate([np.asarray(p, np.int64) + (n << 32) for n, p in enumerate(places)])
            found.keep(np.isin((found.doc << 32) + found.at, marks))
            ids, rows = (batch.column(n).to_numpy()[found.doc] for n in (0, 1))
            begin, end = found.place - found.high, found.place + length - found.low
            context = found.hashes(begin, end)
            bucket = bucket_of(found.hash, buckets)
            is_hot = np.isin(found.hash, hot)
            if is_hot.any():
                n = np.flatnonzero(is_hot)
                wide = (found.high - found.low + 1)[n]
                of = np.repeat(n, wide)
                first = begin[of] + np.arange(len(of)) - np.repeat(np.cumsum(wide) - wide, wide)
                middle = first + length // 2
                k1 = found.hashes(first, first + length)
                k2 = mix(found.hashes(first, middle) * BASE + found.hashes(middle, first + length))
                start = first - found.starts[found.doc[of]]
                # many windows to a row: unpacked beside the aggregation
                packed = [x.astype(np.int64).tobytes() for x in (ids[of], rows[of], start, k1.view(np.int64), k2.view(np.int64))]
                yield _batch(RUNS, [(None, None, packed[3], packed[4], None, None, None, *packed[:3], 1, None)])
            gone = []
            data = found.data.tobytes()
            fields = (found.hash, context, found.low, found.high, ids, rows, found.at, bucket, begin, found.place, end, is_hot)
            for h, c, lo, hi, doc, row, at, b, s, p, e, warm in zip(*(f.tolist() for f in fields), strict=True):
                if warm:
                    continue
                key, before = (h, c, lo, hi), kept.get((h, c, lo, hi))
                if before is None:
                    kept[key] = (doc, row, at, b, data[p:e], data[s:p])
                elif (doc, at) > (before[0], before[2]):
                    gone.append((doc, row, at - hi, at - lo))
                elif (doc, at) < (before[0], before[2]):
                    gone.append((before[0], before[1], before[2] - hi, before[2] - lo))
                    kept[key] = (doc, row, at, b, data[p:e], data[s:p])
                elif row != before[1]:
                    # another row at the same place: it is no earlier, so it is judged beside the first
                    kept[(h, c, lo, hi, row)] = (doc, row, at, b, data[p:e], data[s:p])
            if gone:
                doc, row, first, last = (np.array(x, np.int64).tobytes() for x in zip(*gone, strict=True))
                yield _batch(RUNS, [(None, None, last, None, None, None, None, doc, row, first, 0, None)])
            if len(kept) > BLOCK_ANCHORS // 16:
                yield flush()
        yield flush()

    return docs.mapInArrow(run, RUNS)


def merged_runs(runs: DataFrame, length: int, gram: int = GRAM) -> DataFrame:
    """The windows with an earlier equal one, from the runs of each bucket."""
    most = length - gram

    def bucket(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        size = sum(len(r["shared"]) for r in rows)
        base = np.cumsum([0, *[len(r["shared"]) for r in rows]])
        source, shared = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for n, (run, entry, _, prefix) in enumerate(merged([Run(r["shared"], r["tails"], r["sizes"]) for r in rows])):
            source[n], shared[n] = base[run] + entry, prefix
        ids, own, at = (np.concatenate([np.frombuffer(r[c], np.int64) for r in rows])[source] for c in ("ids", "rows", "at"))
        low, high = (np.concatenate([np.frombuffer(r[c], np.uint8) for r in rows]).astype(np.int64) for c in ("low", "high"))
        flat = np.frombuffer(b"".join(r["left"] for r in rows), np.uint8)
        ends = np.cumsum(high)
        # nearest byte first, zeros beyond the bytes that were sent
        column = np.arange(most)
        inside = column < high[:, None]
        left = np.zeros((size, most), np.uint8)
        left[inside] = flat[(ends[:, None] - 1 - column)[inside]]
        place = np.rec.fromarrays([ids, at])
        order = np.unique(place, return_inverse=True)[1]
        gone = equal_windows(shared, left[source], low[source], high[source], order, length)
        return pa.Table.from_batches([_intervals(ids, own, at, gone)])

    return runs.groupBy("bucket").applyInArrow(bucket, STARTS)


def _unpacked(rows: DataFrame, schema: str, columns: list[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                arrays = [np.frombuffer(batch.column(c)[at].as_py(), np.int64) for c in columns]
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=names)

    names = [f.split()[0] for f in schema.split(", ")]
    return rows.select(*columns).mapInArrow(run, schema)


def repeated_spans(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """``(id, row, spans)`` of rows ``(id, row, text)``: maximal runs of removed bytes as ``[start, end)`` pairs, for each
    text that loses any. ``row`` tells texts of the same id apart."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    found = durable(repeated_anchors(anchor_blocks(docs.select("id", "text"), length, buckets), hot))
    # at most one for each ``hot`` anchors of all texts
    warm = np.array([r.hot for r in found.where(F.col("hot").isNotNull()).select("hot").collect()], np.int64).view(np.uint64)
    places = durable(found.where(F.col("hot").isNull()).groupBy("id").agg(F.collect_list("at").alias("places")))
    some = docs.join(F.broadcast(places.select("id")), "id", "left_semi") if places.count() <= BROADCAST_IDS else docs
    marked = some.join(places.hint("shuffle_hash"), "id").select("id", "row", "places", "text")
    runs = durable(suffix_runs(marked, length, buckets, warm))
    merged_windows = merged_runs(runs.where(F.col("bucket").isNotNull()), length)
    local = _unpacked(runs.where("bucket is null and k1 = 0"), "id long, row long, first long, last long", ["ids", "rows", "at", "tails"])
    removed = merged_windows.unionByName(local)
    if len(warm):
        hashed = durable(_unpacked(
            runs.where("bucket is null and k1 = 1"), "id long, row long, first long, k1 long, k2 long", ["ids", "rows", "at", "tails", "sizes"]
        ))
        least = hashed.groupBy("k1", "k2").agg(F.min(F.struct("id", "first")).alias("least"), F.count(F.lit(1)).alias("n"))
        later = hashed.join(least.where("n > 1"), ["k1", "k2"]).where(F.struct("id", "first") > F.col("least"))
        removed = removed.unionByName(later.select("id", "row", "first", F.col("first").alias("last")))
    pairs = removed.groupBy("id", "row").agg(F.collect_list(F.struct("first", "last")).alias("pairs"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for starts in batch.column(2).to_pylist():
                spans: list[list[int]] = []
                for first, last in sorted((p["first"], p["last"] + length) for p in starts):
                    if spans and first <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], last)
                    else:
                        spans.append([first, last])
                out.append(spans)
            kind = pa.list_(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, kind)], names=["id", "row", "spans"])

    return pairs.mapInArrow(joined, "id long, row long, spans array<array<long>>")


def without_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans)`` of each row."""
    body = F.coalesce(docs[text], F.lit(""))
    own = docs.select(
        F.coalesce(docs[doc_id].cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(docs[doc_id], body).alias("row"),
        docs[doc_id].cast("long").alias("doc_id"), body.alias("text"),
    )
    spans = durable(repeated_spans(own.select("id", "row", "text"), length, hot))
    count = spans.count()
    keys = spans.select("id", "row")
    nothing = F.lit(0).cast("long")
    whole = own.join(F.broadcast(keys) if count <= BROADCAST_IDS else keys, ["id", "row"], "left_anti").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), nothing.alias("n_removed"), nothing.alias("n_spans"),
        F.sha2(F.col("text"), 256).alias("kept_sha256"), F.array().cast("array<array<long>>").alias("spans"),
    )
    cut = own.join(F.broadcast(keys), ["id", "row"], "left_semi") if count <= BROADCAST_IDS else own

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, spans_, data in zip(*(c.to_pylist() for c in (batch.column(0), batch.column(1), batch.column(2).cast(pa.binary()))), strict=True):
                kept, at = hashlib.sha256(), 0
                for start, end in spans_:
                    kept.update(data[at:start])
                    at = end
                kept.update(data[at:])
                gone = sum(e - s for s, e in spans_)
                rows.append((doc, len(data), gone, len(spans_), kept.hexdigest(), spans_))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    names = whole.columns
    shortened = cut.join(spans.hint("shuffle_hash"), ["id", "row"]).select("doc_id", "spans", "text").mapInArrow(apply, whole.schema)
    return whole.unionByName(shortened)
