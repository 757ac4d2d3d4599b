"""Cosine join of sets by sorted permutations of their sign signatures.

A signature has one sign for each of ``bits`` random projections. Sets with a small angle differ in few bits, so in some
permutation of the bits the first different one comes late and they are sorted close together. Each permutation is one
global order, numbered densely over range partitions; a set meets the ``neighbours`` next ones in it, across partition
edges. So there are at most ``sets * neighbours * permutations`` candidates, whatever the data look like; recall falls where
more sets than that are close to one, and is to be measured (``cosine_permuted_quality``). Candidates whose signatures
differ in more bits than a pair at the threshold does, but for ``SIGMAS`` standard errors, leave before the exact check.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.operators.lsh import SIGMAS, bits_apart, most_apart, sign_bands, sign_text, sign_words
from tastegraph.operators.setjoin import (
    SHORT,
    Cosine,
    distinct_sets,
    may_reach,
    prepared,
    short_apart,
    short_sketch,
    sizes_allow,
    sketched,
    verify,
)
from tastegraph.plans.copies import expand_copies
from tastegraph.plans.durable import durable
from tastegraph.plans.numbering import dense_numbers

BITS, NEIGHBOURS, PERMUTATIONS = 150, 150, 10
# Signs are worked out in groups of so many.
GROUP = 10


def permutations(count: int, bits: int) -> list[list[int]]:
    """``count`` orders of the bits, from digests, so that every engine has the same."""
    return [
        sorted(range(bits), key=lambda n: hashlib.md5(f"{p}:{n}".encode()).hexdigest()) for p in range(count)
    ]


def signatures(sets: DataFrame, bits: int = BITS) -> DataFrame:
    """``(id, signature)``: the signs of each set as text of 0 and 1."""
    return sign_text(sign_bands(sets, bits // GROUP, GROUP))


def neighbour_pairs(rows: DataFrame, group: str, place: str, carry: list[str], neighbours: int) -> DataFrame:
    """Each row with the next ``neighbours`` rows of its group, as ``a_`` and ``b_`` columns; places are 0, 1, 2 ...

    Places are cut into blocks of that length: a row meets its own block and the next, so no join group is larger than
    two blocks.
    """
    block = F.floor(F.col(place) / neighbours)
    left = rows.select(group, block.alias("block"), F.col(place).alias("_l"), *[F.col(c).alias(f"a_{c}") for c in carry])
    right = rows.select(
        group, F.explode(F.array(block, block - 1)).alias("block"), F.col(place).alias("_r"),
        *[F.col(c).alias(f"b_{c}") for c in carry],
    )
    return left.join(right, [group, "block"]).where((F.col("_r") > F.col("_l")) & (F.col("_r") <= F.col("_l") + neighbours))


def cosine_permuted_join(
    df: DataFrame,
    set_col: str,
    element_col: str,
    threshold: float = 0.47,
    bits: int = BITS,
    neighbours: int = NEIGHBOURS,
    permuted: int = PERMUTATIONS,
    sigmas: float = SIGMAS,
) -> DataFrame:
    """Pairs of sets ``(a, b, similarity)``: candidates that are neighbours in one of ``permuted`` orders, exact 0/1 cosine.

    ``bits`` is a multiple of ten. Equal sets are one in the orders and take no neighbours from each other.
    """
    unique, members = prepared(distinct_sets(df, set_col, element_col))
    signed = durable(signatures(unique, bits).join(members.select("id", "n"), "id"))
    orders = F.array(*[
        F.struct(F.lit(p).alias("permutation"), F.array(*[F.lit(n + 1) for n in order]).alias("order"))
        for p, order in enumerate(permutations(permuted, bits))
    ])
    own, words = sign_words(signed, bits)
    keyed = own.select("*", F.inline(orders)).select(
        "permutation", "id", "n", *words,
        F.array_join(F.transform("order", lambda at: F.substring(F.col("signature"), at, F.lit(1))), "").alias("key"),
    )
    placed = dense_numbers(keyed, ["key", "id"], ["permutation"], "place").select("permutation", "place", "id", "n", *words)
    sketches = sketched(unique, members)
    placed = placed.join(sketches.select("id", *short_sketch(F.col("sketch"))), "id")
    met = neighbour_pairs(placed, "permutation", "place", ["id", "n", *words, *SHORT], neighbours)
    near = bits_apart([F.col(f"a_{w}") for w in words], [F.col(f"b_{w}") for w in words]) <= most_apart(threshold, bits, sigmas)
    apart = short_apart(lambda c: F.col(f"a_{c}"), lambda c: F.col(f"b_{c}"))
    # most pairs with near signatures are far from the threshold; those that a sketch rules out leave before they are shuffled
    reach = may_reach(Cosine, threshold, F.col("a_n"), F.col("b_n"), apart)
    met = met.where(near & sizes_allow(Cosine, threshold, F.col("a_n"), F.col("b_n")) & reach)
    swap = F.col("a_id") > F.col("b_id")
    found = met.select(
        F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b"),
        F.when(swap, F.col("b_n")).otherwise(F.col("a_n")).alias("na"), F.when(swap, F.col("a_n")).otherwise(F.col("b_n")).alias("nb"),
    ).distinct()
    return expand_copies(verify(found, unique, sketches, Cosine, threshold, short=True), members)
