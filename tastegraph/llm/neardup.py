"""Near-duplicate documents by a multi-index Hamming join of b-bit MinHash signatures.

A document's set is its distinct shingles; its signature has ``SYMBOLS`` minima of 16 bits each. The distance of
two signatures is the number of different symbols; pairs within ``MOST_ERRORS`` are wanted. The signature is
split into ``CHUNKS`` chunks. By the pigeonhole principle such a pair has a chunk with at most
``MOST_ERRORS // CHUNKS`` errors, so for each chunk all ways to leave out that many symbols are enumerated, and the
other symbols of the chunk are a key. Every pair under the distance threshold shares a key. The threshold is set
so that a pair of similarity 0.8 lies beyond it with probability 6e-5, one of 0.85 with 2e-7. Every pair found is
confirmed on the full sets.

* Equal sets are joined once, through the smallest id that has the set.
* Pairs inside a bucket are not emitted. Its members meet one pivot (the smallest id), then, in later rounds, 8, 64, 512
  ... further ones, but only members that are still in another component than the pivot, of a size and a bitmap that fit, and
  near it by a sketch; a pair that shares several keys of a chunk meets under one of them. A bucket ends when all members that
  have not been a pivot are connected. So a group of n near copies costs about n comparisons a round, and no link
  between different components is lost.
* The sets of documents that share a bucket, and only those, are hashed a second time for the confirmation.

Edge cases: a null or empty text, or one of blanks, has an empty set and links to nothing; a text shorter than a
shingle is one shingle; rows with the same id are one document; rows without an id link to nothing and are kept; an
empty table gives an empty result; further columns of any name pass ``deduplicate`` untouched.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastegraph.llm.components import components
from tastegraph.llm.wordhash import in_chunks, mix, shingle_sets
from tastegraph.plans.durable import durable

SYMBOLS = 36
CHUNKS = 6
MOST_ERRORS = 17
PERCENT = 80
# Tables of up to so many ids, at most 128 bytes each, are broadcast.
BROADCAST_IDS = 100_000
# Pivots of a bucket in a round, as a multiple of those in the round before.
GROWTH = 8
# A sketch has three bits each of ``TRAITS`` minima (the signature's and further ones), twenty to a number. The masks select
# the low two bits and the high bit of each. Of two sets of similarity 0.8 more than ``MOST_APART`` differ with
# probability 1e-6.
TRAITS, MOST_APART = 120, 42
PARTS = TRAITS // 20
LOW_BITS = sum(3 << (3 * n) for n in range(20))
HIGH_BITS = sum(4 << (3 * n) for n in range(20))
MARK_BITS = 30
SKETCH = [f"s{n}" for n in range(PARTS)]
# A bitmap has a bit for each of 64 * MAPS remainders of the set's hashes: whether an odd number of them has it. Two bitmaps
# differ in at most as many bits as the sets in elements, so a pair with too many different bits is not similar.
MAPS = 8
BITMAP = [f"b{n}" for n in range(MAPS)]

_constants = np.random.default_rng(711).integers(0, 1 << 63, (2, TRAITS), dtype=np.uint64)
FACTORS, SHIFTS = _constants[0] | np.uint64(1), _constants[1]

SIGNED = (
    T.StructType()
    .add("doc_id", T.LongType())
    .add("n", T.LongType())
    .add("f1", T.LongType())
    .add("f2", T.LongType())
    .add("signature", T.BinaryType())
)
for _name in (*SKETCH, *BITMAP):
    SIGNED.add(_name, T.LongType())
KEYED = (
    T.StructType().add("key", T.LongType()).add("id", T.LongType()).add("n", T.LongType()).add("out", T.LongType())
)
SETS = T.StructType().add("id", T.LongType()).add("hashes", T.BinaryType())


def _flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), sizes


def traits(sets: list[np.ndarray]) -> np.ndarray:
    """One row of 16-bit minima per set; zeros for an empty one."""
    flat, sizes = _flat(sets)
    out = np.zeros((len(sets), TRAITS), np.uint16)
    filled = np.flatnonzero(sizes)
    if len(filled):
        starts = (np.cumsum(sizes) - sizes)[filled]
        for n, (factor, shift) in enumerate(zip(FACTORS, SHIFTS, strict=True)):
            least = np.minimum.reduceat(flat * factor + shift, starts)
            out[filled, n] = (mix(least) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def prints(sets: list[np.ndarray]) -> np.ndarray:
    """Two independent sums of each set's mixed hashes: equal for equal sets."""
    flat, sizes = _flat(sets)
    ends = np.cumsum(sizes)
    out = []
    for salt in (np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(flat ^ salt), dtype=np.uint64)))
        out.append((sums[ends] - sums[ends - sizes]).view(np.int64))
    return np.stack(out, 1) if len(sets) else np.zeros((0, 2), np.int64)


def chunk_keys(signature: np.ndarray, errors: int = MOST_ERRORS, chunks: int = CHUNKS) -> tuple[np.ndarray, np.ndarray]:
    """For rows of symbols, all keys of all chunks with ``errors // chunks`` symbols left out, and what was left out.

    A pair that agrees in more symbols of a chunk than a key holds shares several keys of it; the one that counts leaves
    out the last agreeing symbols. Whether a left-out symbol lies behind all kept ones is marked in its lowest bit, so a
    pair sees at each key whether it is the one: see ``first_key``.
    """
    width, left_out = SYMBOLS // chunks, errors // chunks
    assert left_out == 2
    keys, outs = [], []
    wide = signature.astype(np.int64)
    for chunk in range(chunks):
        place = range(chunk * width, (chunk + 1) * width)
        for kept in itertools.combinations(place, width - left_out):
            h = np.full(len(signature), hash(kept) & 0x7FFFFFFF, np.uint64)
            for symbol in kept:
                h = mix(h + signature[:, symbol].astype(np.uint64))
            keys.append(h.view(np.int64))
            one, two = (wide[:, n] * 2 + (n > kept[-1]) for n in place if n not in kept)
            outs.append(one << 20 | two)
    return np.stack(keys, 1), np.stack(outs, 1)


def first_key(left: str, right: str) -> Column:
    """Whether a pair's key is the one of its chunk that counts: each left-out symbol differs or lies behind all kept ones."""
    apart = F.col(left).bitwiseXOR(F.col(right))
    fine = []
    for at in (0, 20):
        same = F.shiftright(apart, at).bitwiseAND(F.lit(0xFFFFF)) == 0
        behind = F.shiftright(F.col(left), at).bitwiseAND(F.lit(1)) == 1
        fine.append(~same | behind)
    return fine[0] & fine[1]


def sketches(minima: np.ndarray) -> np.ndarray:
    """``PARTS`` numbers for each row of minima."""
    bits = (minima & np.uint16(7)).astype(np.int64).reshape(len(minima), PARTS, -1)
    return (bits << (3 * np.arange(bits.shape[2]))).sum(axis=2)


def traits_apart(left: list[str], right: list[str]) -> Column:
    """How many minima differ according to two sketches; equal ones never count."""
    total = F.lit(0)
    for a, b in zip(left, right, strict=True):
        x = F.col(a).bitwiseXOR(F.col(b))
        carried = (x.bitwiseAND(F.lit(LOW_BITS)) + F.lit(LOW_BITS)).bitwiseOR(x)
        total = total + F.bit_count(carried.bitwiseAND(F.lit(HIGH_BITS)))
    return total


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """``MAPS`` numbers for each set."""
    flat, sizes = _flat(sets)
    bits = 64 * MAPS
    place = np.repeat(np.arange(len(sets)), sizes) * bits + (mix(flat) % np.uint64(bits)).astype(np.int64)
    odd = (np.bincount(place, minlength=len(sets) * bits) & 1).astype(np.uint8).reshape(len(sets), bits)
    return np.packbits(odd, axis=1, bitorder="little").view(np.int64)


def sizes_and_bits_allow(n: str, m: str, left: list[str], right: list[str], percent: int) -> Column:
    """Whether the sizes and the bitmaps leave room for the similarity."""
    n, m = F.shiftright(F.col(n), MARK_BITS), F.shiftright(F.col(m), MARK_BITS)
    fits = F.lit(100) * F.least(n, m) >= F.lit(percent) * F.greatest(n, m)
    apart = F.lit(0)
    for a, b in zip(left, right, strict=True):
        apart = apart + F.bit_count(F.col(a).bitwiseXOR(F.col(b)))
    return fits & (apart * F.lit(100 + percent) <= (n + m) * F.lit(100 - percent))


def binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _chunks(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """Ids and texts of rows ``(id, text)``, few at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part, at = batch.slice(start, rows), 0
            for chunk in in_chunks(part.column(1).cast(pa.binary()).to_pylist()):
                yield part.column(0).slice(at, len(chunk)), chunk
                at += len(chunk)


def signed(docs: DataFrame, words: int) -> DataFrame:
    """``(doc_id, n, f1, f2, signature, s0 ...)`` of rows ``(doc_id, text)``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, chunk in _chunks(batches):
            sets = list(shingle_sets(chunk, words))
            marks, minima = prints(sets), traits(sets)
            columns = [pa.array([len(s) for s in sets], pa.int64()), pa.array(marks[:, 0]), pa.array(marks[:, 1])]
            parts = [pa.array(part) for rows in (sketches(minima), bitmaps(sets)) for part in np.ascontiguousarray(rows.T)]
            yield pa.RecordBatch.from_arrays([ids, *columns, binary(minima[:, :SYMBOLS]), *parts], names=SIGNED.names)

    return docs.mapInArrow(rows, SIGNED)


def keyed(heads: DataFrame) -> DataFrame:
    """``(key, id, n, out)``: the keys of each signature."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                symbols = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint16).reshape(-1, SYMBOLS)
                keys, out = chunk_keys(symbols)
                ids, n = (np.repeat(part.column(c).to_numpy(), keys.shape[1]) for c in (0, 1))
                arrays = [pa.array(x) for x in (keys.ravel(), ids, n, out.ravel())]
                yield pa.RecordBatch.from_arrays(arrays, names=KEYED.names)

    return heads.select("id", "n", "signature").mapInArrow(rows, KEYED)


def hashed_sets(docs: DataFrame, words: int) -> DataFrame:
    """``(id, hashes)`` of rows ``(doc_id, text)``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, chunk in _chunks(batches):
            sets = shingle_sets(chunk, words)
            yield pa.RecordBatch.from_arrays([ids, binary(sets)], names=SETS.names)

    return docs.mapInArrow(rows, SETS)


def confirmed(pairs: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs ``(a, b, ca, cb, ha, hb)`` whose sets are similar, without the sets."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for at in range(batch.num_rows):
                a, b = (np.frombuffer(batch.column(c)[at].as_buffer(), np.uint64) for c in (4, 5))
                shared = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * shared >= percent * (len(a) + len(b) - shared):
                    keep.append(at)
            chosen = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(c).take(chosen) for c in range(4)], names=["a", "b", "ca", "cb"])

    return pairs.mapInArrow(rows, "a long, b long, ca long, cb long")


def _by_id(rows: DataFrame, ids: DataFrame, key: str, count: int) -> DataFrame:
    return rows.join(F.broadcast(ids) if count <= BROADCAST_IDS else ids, key, "left_semi")


def set_links(heads: DataFrame, docs: DataFrame, words: int, percent: int = PERCENT) -> DataFrame:
    """Links ``(a, b)`` between different sets that connect all that are similar (a spanning part of them)."""
    spark = docs.sparkSession
    # A set of fewer than four has no other one at 0.8 of the union; in general one element more or less decides.
    least = -(-percent // (100 - percent)) if percent < 100 else 1 << 62
    # an id can have several sets: the size travels with bits of the fingerprint, which tell them apart
    mark = F.shiftleft("n", MARK_BITS) + F.col("f1").bitwiseAND(F.lit((1 << MARK_BITS) - 1))
    heads = heads.where(F.col("n") >= least).withColumn("n", mark)
    keys, traits_of = keyed(heads), [*SKETCH, *BITMAP]
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1).select("key")
    marks = heads.select("id", "n", *traits_of)
    marks = F.broadcast(marks) if heads.count() <= BROADCAST_IDS else marks
    active = durable(
        keys.join(shared, "key", "left_semi").join(marks, ["id", "n"]).select(*KEYED.names, *traits_of, F.col("id").alias("comp"))
    )
    ids = durable(active.select(F.col("id").alias("doc_id")).distinct())
    sets = durable(hashed_sets(_by_id(docs, ids, "doc_id", ids.count()), words))
    left = sets.select(F.col("id").alias("a"), F.col("hashes").alias("ha"))
    right = sets.select(F.col("id").alias("b"), F.col("hashes").alias("hb"))
    found = [spark.createDataFrame([], "a long, b long")]
    fields = ["id", "n", "out", "comp", *traits_of]
    theirs = {c: f"p_{c}" for c in fields}
    salts = 1
    while not active.isEmpty():
        salt = F.pmod(F.xxhash64("id"), F.lit(salts))
        pivots = durable(
            active.groupBy("key", salt.alias("salt")).agg(F.min(F.struct(*fields)).alias("p"))
            .select("key", *[F.col(f"p.{c}").alias(name) for c, name in theirs.items()])
        )
        # all conditions belong to the join, so that a pair they exclude is no row
        near = (
            (active["key"] == pivots["key"]) & (F.col("id") != F.col("p_id")) & (F.col("comp") != F.col("p_comp"))
            & first_key("out", "p_out") & sizes_and_bits_allow("n", "p_n", BITMAP, [theirs[c] for c in BITMAP], percent)
            & (traits_apart(SKETCH, [theirs[c] for c in SKETCH]) <= MOST_APART)
        )
        swap = F.col("id") > F.col("p_id")
        ends = [("id", "p_id", "a"), ("p_id", "id", "b"), ("comp", "p_comp", "ca"), ("p_comp", "comp", "cb")]
        columns = [F.when(swap, F.col(two)).otherwise(F.col(one)).alias(name) for one, two, name in ends]
        pairs = durable(active.join(pivots, near).select(*columns).distinct())
        met = pairs.join(left, "a").join(right, "b").select("a", "b", "ca", "cb", "ha", "hb")
        new = durable(confirmed(met, percent))
        # only the pivot's own set leaves: another set of its id has still to meet the others
        met_all = pivots.select("key", F.col("p_id").alias("id"), F.col("p_n").alias("n"))
        active = active.join(met_all, ["key", "id", "n"], "left_anti")
        if not new.isEmpty():
            found.append(new.select("a", "b"))
            # only the components that the new links join are worked out anew
            joined = components(new.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
            active = active.join(joined.select(F.col("id").alias("comp"), F.col("component").alias("_new")), "comp", "left")
            active = active.withColumn("comp", F.coalesce("_new", "comp")).drop("_new")
        open_keys = active.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
        open_keys = open_keys.where(F.col("lo") != F.col("hi")).select("key")
        active = durable(active.join(open_keys, "key", "left_semi").select(*KEYED.names, *traits_of, "comp"))
        salts *= GROWTH
    return reduce(DataFrame.unionByName, found)


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of each row: documents are linked where the intersection of
    their shingle sets is at least ``percent`` hundredths of the union."""
    own = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    sets = durable(signed(own, words))
    named = sets.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    content = ["n", "f1", "f2"]
    same = [F.max(c).alias(c) for c in ("signature", *SKETCH, *BITMAP)]
    heads = durable(named.groupBy(*content).agg(F.min("doc_id").alias("id"), *same))
    links = set_links(heads, own.where(F.col("doc_id").isNotNull()), words, percent)
    # rows with one id but different sets are one document
    copies = named.join(heads.select(*content, "id"), content).select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    own_component = components(links.unionByName(copies)).withColumnRenamed("id", "doc_id")
    component = F.coalesce("component", "doc_id")
    return sets.join(own_component, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def deduplicate(docs: DataFrame, words: int = 5, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with the smallest id of their component, one row for each id, and rows without an id."""
    found = near_duplicates(docs, words, percent, doc_id, text)
    # a row travels as one struct beside the names used here, so that no column of the documents can clash with them
    rows = docs.select(docs[doc_id].cast("long").alias("id"), F.struct("*").alias("row"))
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("id")).distinct()
    stay = rows.join(gone, "id", "left_anti")
    # repeated ids are rare: only those are ranked, the others pass without a shuffle of texts
    twice = found.where(F.col("kept") & F.col("doc_id").isNotNull()).groupBy("doc_id").count().where("count > 1")
    twice = durable(twice.select(F.col("doc_id").alias("id")))
    if twice.isEmpty():
        return stay.select("row.*")
    once = stay.join(twice, "id", "left_anti")
    content = F.col("row").getField(text)
    ranked = Window.partitionBy("id").orderBy(F.xxhash64(content), content)
    first = stay.join(twice, "id", "left_semi").withColumn("rank", F.row_number().over(ranked)).where("rank = 1")
    return once.select("row.*").unionAll(first.select("row.*"))
