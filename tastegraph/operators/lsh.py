"""Locality-sensitive similarity joins: MinHash bands for Jaccard, sign bands for cosine.

All signatures are aggregates over ``(set, element)`` rows, ``min`` or ``sum`` per (set, band). The rows are dealt by set
before they are spread over the bands, so the shuffle holds an element once and not once a band; a set that holds
a third of all rows is not dealt but combined map-side. A band row leaves the aggregate with its
hashes and goes straight into the bucket join; full signatures are only put together on request.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tastegraph.functions.hashing import (
    LARGE_PRIME,
    affine_hash,
    hash_params,
    projection_signs,
    text_id,
)
from tastegraph.operators.setjoin import (
    SHORT,
    Cosine,
    Jaccard,
    distinct_sets,
    exact_pairs,
    may_reach,
    prepared,
    short_apart,
    short_sketch,
    sizes_allow,
    sketched,
    verify,
)
from tastegraph.plans.copies import expand_copies, fingerprint, group_copies, has_copies
from tastegraph.plans.durable import durable
from tastegraph.plans.pairing import BLOCK_ROWS, pairs_within

BANDS = 33
ROWS = 5
BITS = 150
# Sign bands of sets: the share of pairs at the threshold that must be found, and the most signs and rows for it.
RECALL = 0.99
MOST_BITS, MOST_ROWS = 600, 64
# A pair at the threshold differs in so many standard errors more signs than expected with probability 3e-5.
SIGMAS = 4.0
# Sets of more elements than this are combined map-side; there are few of them.
LARGE_SET = 65536
# Sign bands that more than this share of unrelated pairs have in common are not joined by buckets.
COMMON_SHARE = 1 / 16
# Vectors of a block, at most and where there are enough for so many blocks; cells of a product that are held at a time.
BLOCK_VECTORS, BLOCKS, STRIP_CELLS = 16384, 12, 1 << 23
# Pairs whose bands are compared at a time.
SHARING_PAIRS = 65536
# Copies of a set in one row of the bucket join of candidates.
PART_IDS = 64
# Bands whose buckets travel with all rows of a set.
FIRST_BANDS = 8
FIRST = [f"f{n}" for n in range(FIRST_BANDS)]
# Signs that fit one number.
WORD_BITS = 50


def params_frame(spark, count: int = BANDS * ROWS) -> DataFrame:
    """The hash functions ``(n, a, b)`` as a table; its size is the parameter ``count``."""
    return spark.createDataFrame(hash_params(count), "n int, a long, b long")


def _band_params(bands: int, rows: int) -> Column:
    params = hash_params(bands * rows)
    return F.array(
        *[
            F.struct(
                F.lit(band).alias("band"),
                *[
                    F.lit(value).cast("long").alias(f"{name}{j}")
                    for j in range(rows)
                    for name, value in zip("ab", params[band * rows + j][1:])
                ],
            )
            for band in range(bands)
        ]
    )


def _per_band(
    sets: DataFrame, bands: int, rows: int, code: Callable[[Column], Column] | None, values: list[Column], large_set: int
) -> DataFrame:
    """``(id, band, …)``: aggregates over the codes of each set, with the band's parameters beside them.

    The rows of a set meet in one task with their codes alone and are spread there, one row per element and band; those of
    large sets are spread where they are, and the aggregate combines them before the shuffle.
    """
    value = F.col("element") if code is None else code(F.col("element"))
    large = F.broadcast(sets.groupBy("id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > large_set).select("id"))
    coded = sets.select("id", value.alias("code"))
    dealt = coded.join(large, "id", "left_anti").repartition("id")

    def banded(frame: DataFrame) -> DataFrame:
        return frame.select("id", "code", F.inline(_band_params(bands, rows))).groupBy("id", "band").agg(*values)

    return banded(dealt).unionByName(banded(coded.join(large, "id", "left_semi")))


def minhash_bands(
    sets: DataFrame,
    bands: int = BANDS,
    rows: int = ROWS,
    prime: int | None = LARGE_PRIME,
    universe: Column | None = None,
    code: Callable[[Column], Column] | None = text_id,
    large_set: int = LARGE_SET,
) -> DataFrame:
    """``(id, band, h0 … h<rows-1>)``: the minimum of each hash over the set's elements.

    ``code`` turns an element into a non-negative integer. ``code=None`` with ``prime=SMALL_PRIME`` is the plain
    family on numeric elements: small numbers then never wrap, and sets above the modulus look alike.
    ``universe`` is an optional final modulus.
    """
    element = F.col("code")
    least = [
        F.min(affine_hash(element, F.col(f"a{j}"), F.col(f"b{j}"), prime, universe)).alias(f"h{j}") for j in range(rows)
    ]
    return _per_band(sets, bands, rows, code, least, large_set)


def signature_rows(bands: DataFrame, rows: int = ROWS) -> DataFrame:
    """Band rows as one row per hash: ``(id, n, h)``."""
    hashes = F.array(*[F.col(f"h{j}") for j in range(rows)])
    return bands.select("id", "band", F.posexplode(hashes).alias("j", "h")).select(
        "id", (F.col("band") * rows + F.col("j")).cast("int").alias("n"), "h"
    )


def signatures(bands: DataFrame, rows: int = ROWS) -> DataFrame:
    """``(id, signature)``: all hashes of a set in order; bands × rows values per set."""
    band = F.struct("band", F.array(*[F.col(f"h{j}") for j in range(rows)]).alias("h"))
    listed = bands.groupBy("id").agg(F.array_sort(F.collect_list(band)).alias("bands"))
    return listed.select("id", F.flatten(F.col("bands.h")).alias("signature"))


def bucket_pairs(
    bands: DataFrame, keys: list[str], carry: list[str] = (), keep=None, block_rows: int = BLOCK_ROWS, shown: list[str] | None = None
) -> DataFrame:
    """Distinct pairs ``(a, b, …)`` that share a bucket in at least one band, with the carried columns that are ``shown`` (all).

    The bucket is the 64-bit hash of band and key values: narrower to shuffle than the key, and a
    collision could only add a candidate, which verification removes.
    """
    # Read by the bucket count and by both sides of the pairing.
    buckets = durable(bands.select("id", *carry, F.xxhash64("band", *keys).alias("bucket")))
    met = pairs_within(buckets, ["bucket"], "id", list(carry), keep=keep, block_rows=block_rows)
    return met.select(
        F.col("a_id").alias("a"),
        F.col("b_id").alias("b"),
        *[F.col(f"{side}_{c}").alias(f"{c}{side}") for c in (carry if shown is None else shown) for side in "ab"],
    ).distinct()


def minhash_candidates(
    df: DataFrame,
    set_col: str,
    element_col: str,
    bands: int = BANDS,
    rows: int = ROWS,
    prime: int | None = LARGE_PRIME,
    universe: Column | None = None,
    code: Callable[[Column], Column] | None = text_id,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Candidate pairs ``(a, b)`` of sets with an equal band; feeds ``candidates=`` of the predictors."""
    unique, members = prepared(distinct_sets(df, set_col, element_col))
    banded = minhash_bands(unique, bands, rows, prime, universe, code)
    return first_met(banded, [f"h{j}" for j in range(rows)], members, block_rows)


def first_met(
    banded: DataFrame, keys: list[str], members: DataFrame, block_rows: int = BLOCK_ROWS, part_ids: int = PART_IDS
) -> DataFrame:
    """Distinct pairs ``(a, b)`` of all members, copies included, that share a bucket in at least one band.

    The rows of a bucket carry the buckets of the bands before theirs, and a pair is given where it meets first. Copies
    travel as lists of ids, at most some ``part_ids`` a row, and are spread where their pair has met. So only the
    rows of sets are shuffled or written, and never the pairs, however many there are.
    """
    code = F.struct("band", F.xxhash64("band", *keys).alias("bucket"))
    signed = banded.groupBy("id").agg(F.array_sort(F.collect_list(code)).alias("bands"))
    parts = F.ceil(F.col("copies") / F.lit(float(part_ids)))
    listed = members.groupBy("rep", F.pmod(F.xxhash64("id"), parts).alias("part")).agg(F.sort_array(F.collect_list("id")).alias("ids"))
    # read by the bucket count, by the pairing and for the pairs of copies
    held = durable(
        signed.join(listed, F.col("id") == F.col("rep")).select(F.get("ids", 0).alias("head"), "ids", F.col("bands.bucket").alias("codes"))
    )
    rows = held.select("head", "ids", "codes", F.posexplode("codes").alias("band", "bucket")).select(
        "head", "ids", "bucket", F.slice("codes", 1, F.col("band")).alias("before")
    )
    met = pairs_within(
        rows, ["bucket"], "head", ["ids", "before"],
        # a bucket is a hash of its band too, so no two bands have the same one
        lambda left, right: ~F.arrays_overlap(left("before"), right("before")),
        block_rows,
    )
    across = met.select(F.explode("a_ids").alias("x"), "b_ids").select("x", F.explode("b_ids").alias("y"))
    copied = held.where(F.size("ids") > 1).select("ids", F.posexplode("ids").alias("at", "x"))
    inside = copied.select("x", F.explode(F.slice("ids", F.col("at") + 2, F.size("ids"))).alias("y"))
    return across.unionByName(inside).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def jaccard_lsh_join(
    df: DataFrame,
    set_col: str,
    element_col: str,
    threshold: float = 0.5,
    bands: int = BANDS,
    rows: int = ROWS,
    prime: int | None = LARGE_PRIME,
    universe: Column | None = None,
    code: Callable[[Column], Column] | None = text_id,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Pairs of sets ``(a, b, similarity)``: MinHash candidates, checked exactly against the threshold."""
    unique, members = prepared(distinct_sets(df, set_col, element_col))
    banded = minhash_bands(unique, bands, rows, prime, universe, code)
    return checked_sets(banded, [f"h{j}" for j in range(rows)], unique, members, Jaccard, threshold, block_rows)


def checked_sets(banded, keys, unique, members, measure, threshold, block_rows):
    """Pairs of sets that share a bucket, checked exactly.

    The rows of a bucket carry the buckets of the first few bands, and a pair that shares one of these is given in the first such band
    only: pairs of near copies are hardly ever shuffled more than once, however many bands they share.
    """
    sketches = sketched(unique, members)
    code = F.struct("band", F.xxhash64("band", *keys).alias("bucket"))
    signed = banded.groupBy("id").agg(F.array_sort(F.collect_list(code)).alias("bands"))
    first = [F.get("bands.bucket", F.lit(n)).alias(f"f{n}") for n in range(FIRST_BANDS)]
    sized = signed.select("id", "bands", *first).join(sketches.select("id", "n", *short_sketch(F.col("sketch"))), "id")
    rows = sized.select("id", "n", *SHORT, *FIRST, F.inline("bands"))

    def keep(left, right):
        near = may_reach(measure, threshold, left("n"), right("n"), short_apart(left, right))
        given = F.lit(False)
        for n, name in enumerate(FIRST):
            # a bucket is a hash of its band too, so both rows are of one band; both are named, so that both sides keep the same columns
            given = given | ((left("band") > n) & (right("band") > n) & left(name).eqNullSafe(right(name)))
        return sizes_allow(measure, threshold, left("n"), right("n")) & ~given & near

    found = bucket_pairs(rows, ["bucket"], ["n", "band", *SHORT, *FIRST], keep, block_rows, ["n"])
    return expand_copies(verify(found, unique, sketches, measure, threshold, short=True), members, block_rows)


def most_apart(threshold: float, bits: int, sigmas: float = SIGMAS) -> int:
    """How many of their signs two sets at the threshold may differ in."""
    share = math.acos(min(threshold, 1.0)) / math.pi
    return min(bits, math.floor(bits * share + sigmas * math.sqrt(bits * share * (1 - share))))


def sign_text(banded: DataFrame) -> DataFrame:
    """``(id, signature)``: the keys of all bands of a set, as text of 0 and 1."""
    parts = F.array_sort(F.collect_list(F.struct("band", "key")))
    return banded.groupBy("id").agg(F.array_join(F.transform(parts, lambda s: s["key"]), "").alias("signature"))


def sign_words(signed: DataFrame, bits: int) -> tuple[DataFrame, list[str]]:
    """The signatures as numbers of ``WORD_BITS`` signs, and the names of these columns."""
    names = [f"w{n}" for n in range(-(-bits // WORD_BITS))]
    return signed.select("*", *[
        F.conv(F.substring("signature", WORD_BITS * n + 1, WORD_BITS), 2, 10).cast("long").alias(w) for n, w in enumerate(names)
    ]), names


def bits_apart(left: list[Column], right: list[Column]) -> Column:
    total = F.lit(0)
    for one, two in zip(left, right, strict=True):
        total = total + F.bit_count(one.bitwiseXOR(two))
    return total


def sign_shape(threshold: float, recall: float = RECALL, bits: int = MOST_BITS) -> tuple[int, int]:
    """``(rows, bands)``: the most rows per band with which a pair at the threshold shares a band with probability
    ``recall``, in at most ``bits`` signs (or one row per band). Nothing else enters, so the recall holds at any size."""
    agreement = 1.0 - math.acos(min(threshold, 1.0)) / math.pi
    shape = 1, 1
    for rows in range(1, MOST_ROWS + 1):
        met = agreement**rows
        bands = max(1, math.ceil(math.log(1.0 - recall) / math.log1p(-met))) if met < 1 else 1
        if rows == 1 or rows * bands <= bits:
            shape = rows, bands
    return shape


def sign_bands(
    sets: DataFrame,
    bands: int,
    rows: int,
    prime: int = LARGE_PRIME,
    code: Callable[[Column], Column] | None = text_id,
    large_set: int = LARGE_SET,
) -> DataFrame:
    """``(id, band, key)``: signs of random ±1 projections of each set's 0/1 vector, ``rows`` per band.

    The sign of an element under a hash function is the parity of its hash, so the projections are
    sums of integers and do not depend on the order of rows.
    """
    element = F.col("code")
    signed = [
        F.sum(F.lit(1) - F.lit(2) * (affine_hash(element, F.col(f"a{j}"), F.col(f"b{j}"), prime) % 2)).alias(f"s{j}")
        for j in range(rows)
    ]
    sums = _per_band(sets, bands, rows, code, signed, large_set)
    key = F.concat(*[F.when(F.col(f"s{j}") >= 0, "1").otherwise("0") for j in range(rows)])
    return sums.select("id", "band", key.alias("key"))


def cosine_lsh_join(
    df: DataFrame,
    set_col: str,
    element_col: str,
    threshold: float = 0.47,
    bits: int | None = None,
    rows: int | None = None,
    recall: float = RECALL,
    code: Callable[[Column], Column] | None = text_id,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Pairs of sets ``(a, b, similarity)``: sign-band candidates, exact 0/1 cosine.

    Without ``rows`` the shape of the bands follows from ``threshold`` and ``recall`` alone (``sign_shape``): a pair at
    the threshold is found with that probability, a closer one more likely, however many sets there are. With ``rows`` the
    ``bits`` form ``bits / rows`` bands, rounded up. Pairs whose signatures as a whole are too far apart for the
    threshold (``most_apart``) are left out.

    Bands that more than ``COMMON_SHARE`` of unrelated pairs share leave little out, and their buckets grow with the square of the
    number of sets: the pairs that reach the threshold are then found by their rarest elements, and those without a common
    band leave afterwards. The result is the same.
    """
    unique, members = prepared(distinct_sets(df, set_col, element_col))
    if rows is None:
        rows, bands = sign_shape(threshold, recall, bits or MOST_BITS)
    else:
        bands = -(-(bits or BITS) // rows)
    limit = most_apart(threshold, rows * bands)
    if 1 - (1 - 0.5**rows) ** bands > COMMON_SHARE:
        exact = durable(exact_pairs(unique, members, Cosine, threshold, block_rows))
        ends = durable(exact.select(F.explode(F.array("a", "b")).alias("id")).distinct())
        signed = sign_text(sign_bands(durable(unique.join(ends, "id", "left_semi")), bands, rows, code=code))
        return expand_copies(_sharing(exact, signed, rows, bands, limit), members, block_rows)
    banded = durable(sign_bands(unique, bands, rows, code=code))
    # most pairs of a bucket are far apart over all signs; only the others are compared element by element
    words, names = sign_words(sign_text(banded), rows * bands)
    sized = banded.join(durable(words.join(members.select("id", "n"), "id").select("id", "n", *names)), "id")

    def keep(left, right):
        near = bits_apart([left(w) for w in names], [right(w) for w in names]) <= limit
        return sizes_allow(Cosine, threshold, left("n"), right("n")) & near

    found = bucket_pairs(sized, ["key"], ["n", *names], keep, block_rows, ["n"])
    return expand_copies(verify(found, unique, sketched(unique, members), Cosine, threshold), members, block_rows)


def _sharing(pairs: DataFrame, signed: DataFrame, rows: int, bands: int, limit: int) -> DataFrame:
    """The pairs whose signatures have an equal band and differ in at most ``limit`` signs."""
    words, names = sign_words(signed, rows * bands)
    signed = durable(words)
    for end in "ab":
        held = signed.select(F.col("id").alias(end), F.col("signature").alias(f"{end}_signature"), *[F.col(w).alias(f"{end}_{w}") for w in names])
        pairs = pairs.join(held, end)
    near = bits_apart([F.col(f"a_{w}") for w in names], [F.col(f"b_{w}") for w in names]) <= limit
    shared = F.lit(False)
    for band in range(bands):
        part = [F.substring(f"{end}_signature", band * rows + 1, rows) for end in "ab"]
        shared = shared | (part[0] == part[1])
    return pairs.where(near & shared).select("a", "b", "similarity")


def _sign_keys(dims: int, bands: int, rows: int):
    """Arrow-batched band keys of dense vectors: one matrix product per batch."""
    signs = np.array(projection_signs(dims, bands * rows), dtype="float64").T

    @F.pandas_udf("array<string>")
    def keys(vectors: pd.Series) -> pd.Series:
        if vectors.empty:
            return pd.Series([], dtype="object")
        bits = np.where(np.stack(vectors.to_numpy()) @ signs >= 0, "1", "0")
        return pd.Series([["".join(row[b * rows : (b + 1) * rows]) for b in range(bands)] for row in bits])

    return keys


def _dots():
    """Arrow-batched inner products of two vector columns."""

    @F.pandas_udf("double")
    def dots(left: pd.Series, right: pd.Series) -> pd.Series:
        if left.empty:
            return pd.Series([], dtype="float64")
        return pd.Series(np.einsum("ij,ij->i", np.stack(left.to_numpy()), np.stack(right.to_numpy())))

    return dots


def _all_cosines(
    vectors: DataFrame, threshold: float, block_rows: int, dims: int, bands: int | None = None, rows: int | None = None
) -> DataFrame:
    """Pairs ``(a, b, similarity)`` of ``(id, vector, norm)`` by matrix products of blocks of bounded size.

    With ``bands`` only those that share one of the sign bands, of at most 16 ``rows``. What is sent is the square of the number of
    vectors over the size of a block, so blocks are large and a product is worked out in strips.
    """
    signs = np.array(projection_signs(dims, bands * rows), dtype="float64").T if bands else None
    most, cells = SHARING_PAIRS, STRIP_CELLS

    def coded(vectors: np.ndarray) -> np.ndarray:
        bits = (vectors @ signs >= 0).reshape(len(vectors), bands, rows)
        return (bits * (1 << np.arange(rows))).sum(axis=2).astype("uint16")

    def sharing(left: np.ndarray, right: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        parts = [slice(at, at + most) for at in range(0, len(x), most)]
        return np.concatenate([(left[x[p]] == right[y[p]]).any(axis=1) for p in parts] or [np.zeros(0, bool)])
    kind = vectors.schema["id"].dataType
    arrow = to_arrow_type(kind)
    schema = T.StructType().add("block", T.LongType()).add("ids", T.ArrayType(kind)).add("data", T.BinaryType())
    schema = schema.add("codes", T.BinaryType())

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column(0).to_pylist(), np.stack(b.column(1).to_numpy(zero_copy_only=False))) for b in batches if b.num_rows]
        if held:
            ids = [i for part, _ in held for i in part]
            whole = np.concatenate([v for _, v in held])
            codes = coded(whole).tobytes() if bands else b""
            whole = whole / np.sqrt((whole * whole).sum(axis=1, keepdims=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([ids], pa.list_(arrow)), pa.array([whole.tobytes()], pa.binary()), pa.array([codes], pa.binary())],
                names=schema.names,
            )

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one pair of blocks at a time, copied out of its batch and dropped before the next
        for batch in batches:
            for n in range(batch.num_rows):
                (r,) = batch.slice(n, 1).to_pylist()
                left = np.frombuffer(r["ldata"]).reshape(len(r["lids"]), -1)
                right = np.frombuffer(r["rdata"]).reshape(len(r["rids"]), -1)
                codes = [np.frombuffer(r[c], "uint16").reshape(-1, bands) for c in ("lcodes", "rcodes")] if bands else []
                lids, rids = pa.array(r["lids"], arrow), pa.array(r["rids"], arrow)
                height = max(1, cells // len(right))
                for top in range(0, len(left), height):
                    cosines = left[top : top + height] @ right.T
                    x, y = np.nonzero(cosines >= threshold)
                    if r["block"] == r["other"]:
                        x, y = x[x + top < y], y[x + top < y]
                    values = cosines[x, y]
                    x = x + top
                    if bands:
                        shared = sharing(*codes, x, y)
                        x, y, values = x[shared], y[shared], values[shared]
                    yield pa.RecordBatch.from_arrays([lids.take(pa.array(x)), rids.take(pa.array(y)), pa.array(values)], names=["x", "y", "similarity"])

    held = vectors.count()
    count = max(1, -(-held // max(block_rows, min(BLOCK_VECTORS, -(-held // BLOCKS)))))
    table = durable(vectors.select("id", "vector").repartition(count).mapInArrow(blocks, schema))
    left = table.select(
        "block", F.col("ids").alias("lids"), F.col("data").alias("ldata"), F.col("codes").alias("lcodes"),
        F.explode(F.sequence(F.col("block"), F.lit(count - 1).cast("long"))).alias("other"),
    )
    right = table.select(
        F.col("block").alias("other"), F.col("ids").alias("rids"), F.col("data").alias("rdata"), F.col("codes").alias("rcodes")
    )
    found = T.StructType().add("x", kind).add("y", kind).add("similarity", T.DoubleType())
    # written here, with small Arrow batches: a row has two blocks, and a batch of the usual size dozens
    pairs = durable(left.join(right, "other").mapInArrow(products, found))
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "similarity")


def cosine_join_vectors(
    df: DataFrame,
    id_col: str,
    vector_col: str,
    dims: int,
    threshold: float = 0.47,
    bits: int = BITS,
    rows: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Pairs of dense vectors ``(a, b, similarity)`` with an exact cosine of at least ``threshold``.

    Without ``rows`` all pairs are compared, block by block, as matrix products: nothing is missed. With ``rows``
    the candidates come from ``bits // rows`` bands of random signs; a pair of cosine c is then found with probability
    ``1 - (1 - p**rows)**(bits // rows)``, p = 1 - acos(c) / pi, whatever the number of vectors.

    Bands that more than ``COMMON_SHARE`` of unrelated pairs share leave little out: the blocks are then multiplied, and the pairs
    without a common band leave there, instead of all others being shuffled. The result is the same.

    Vectors of another length, of norm 0 or with a null, NaN or infinite component have no cosine and form no pair. Identical vectors are
    joined once.
    """
    vectors = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    usable = (F.col("norm") > 0) & ~F.isnan("norm") & (F.col("norm") < float("inf"))
    vectors = durable(vectors.where(F.size("vector") == dims).withColumn("norm", F.sqrt(squares)).where(usable))
    one, two = fingerprint(F.col("vector"))
    members = durable(group_copies(vectors.select("id", F.lit(dims).alias("n"), one, two)))
    unique = vectors
    if has_copies(members):
        unique = vectors.join(members.where(F.col("id") == F.col("rep")).select("id"), "id", "left_semi")

    if rows is None:
        return expand_copies(_all_cosines(unique, threshold, block_rows, dims), members, block_rows)
    if 1 - (1 - 0.5**rows) ** (bits // rows) > COMMON_SHARE and rows <= 16:
        found = _all_cosines(unique, threshold, block_rows, dims, bits // rows, rows)
        return expand_copies(found, members, block_rows)
    keys = _sign_keys(dims, bits // rows, rows)
    banded = unique.select("id", F.posexplode(keys(F.col("vector"))).alias("band", "key"))
    found = bucket_pairs(banded, ["key"], block_rows=block_rows)
    left = unique.select(F.col("id").alias("a"), F.col("vector").alias("va"), F.col("norm").alias("la"))
    right = unique.select(F.col("id").alias("b"), F.col("vector").alias("vb"), F.col("norm").alias("lb"))
    checked = (
        found.join(left, "a")
        .join(right, "b")
        .select("a", "b", (_dots()("va", "vb") / (F.col("la") * F.col("lb"))).alias("similarity"))
        .where(F.col("similarity") >= threshold)
    )
    return expand_copies(checked, members, block_rows)
