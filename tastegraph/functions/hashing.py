"""Hash families for MinHash and sign projections, and numeric ids for text elements."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 48-bit linear congruential generator of java.util.Random (public specification).
LCG_MULTIPLIER = 0x5DEECE66D
LCG_INCREMENT = 0xB
LCG_MASK = (1 << 48) - 1

# The modulus of the hash family, and a prime above 2^32 for large universes.
SMALL_PRIME = 12251
LARGE_PRIME = 4294967311


def _next_ints(seed: int, count: int) -> list[int]:
    state = (seed ^ LCG_MULTIPLIER) & LCG_MASK
    out = []
    for _ in range(count):
        state = (state * LCG_MULTIPLIER + LCG_INCREMENT) & LCG_MASK
        word = state >> 16
        out.append(word - (1 << 32) if word >= (1 << 31) else word)
    return out


def hash_params(count: int) -> list[tuple[int, int, int]]:
    """``(n, a, b)`` for each hash function; a and b lie in 1..19999."""

    def coefficient(value: int) -> int:
        rest = abs(value) % 10000
        return (rest if value >= 0 else -rest) + 10000

    return [(n, *(coefficient(v) for v in _next_ints(n, 2))) for n in range(count)]


def affine_hash(
    x: Column, a: Column, b: Column, prime: int | None = SMALL_PRIME, universe: Column | None = None
) -> Column:
    """``((a*x + b) mod prime) mod universe`` on non-negative longs."""
    # x mod prime keeps the product inside 64 bits and has the same residue.
    h = a * x + b if prime is None else (a * (x % F.lit(prime)) + b) % F.lit(prime)
    return h if universe is None else h % universe


def text_id(element: Column) -> Column:
    """48-bit code of an element of any type by its text form, equal in every engine that has md5.

    Small numbers must be mixed as well: the hash family ``a*x + b`` with small a and x never wraps around its
    modulus, so it would rise with x in every function. Codes only propose candidates: an equal code of different
    elements adds one, and verification compares the elements.
    """
    return F.conv(F.substring(F.md5(element.cast("string")), 1, 12), 16, 10).cast("long")


def projection_signs(dims: int, bits: int) -> list[list[int]]:
    """±1 projection matrix, one row per bit; the sign is the parity of a digest digit."""
    return [
        [1 - 2 * (int(hashlib.md5(f"{d}:{b}".encode()).hexdigest()[0], 16) & 1) for d in range(dims)]
        for b in range(bits)
    ]
