"""Exact similarity joins on sets, by prefix filtering.

Elements are ordered by how many sets hold them, rarest first. Two sets that are similar enough must
share an element among the first few of each, so only those prefixes are joined; an element that a
third of all rows hold comes last in every set and stays out of the join unless the sets consist of
little else. Identical sets are joined once, through a representative.

Pairs that meet are told apart by sketches before any elements are compared: each element flips one bit of a set's
sketch, so two sketches differ in no more bits than the sets do in elements. A pair whose sketches differ in more than
the threshold leaves room for cannot reach it; nothing else is dropped.

Sets of up to ``PACKED_SET`` elements are joined as rows of numbers (``operators.packed``). Pairs with a larger set are
found in long form (``prefix_candidates``), where no set has to fit in a row.

In long form the prefix is cut at a popularity class instead of a row number: that needs a small histogram per
set (map-side combined) rather than a sort of all rows of a set in one task. A class is a whole
number of the common order, so the prefix can only be longer than required, never shorter.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.operators.packed import (
    SLACK,
    cosine_least,
    cosine_partner,
    in_block_pairs,
    jaccard_least,
    jaccard_partner,
    packed_sets,
    pairs_that_may_reach,
)
from tastegraph.plans.copies import expand_copies, has_copies, set_copies
from tastegraph.plans.durable import durable
from tastegraph.plans.lookup import lookup
from tastegraph.plans.pairing import BLOCK_ROWS, pairs_within

# A sketch has at least so many bits for each element, in 64-bit words whose number is a power of two.
SKETCH_BITS, LEAST_WORDS, MOST_WORDS = 4, 16, 4096

# Sets of up to so many elements are compared as rows, in blocks of at most about so many elements and sets.
PACKED_SET, BLOCK_ELEMENTS, BLOCK_SETS = 65536, 1 << 18, 512

# Elements up to this popularity class (64 holders) are counted for every pair that shares them: at
# most 32 pairs per row, and pairs of sets without busier elements need no second look.
DIRECT_CLASS = 48


class Jaccard:
    """|A∩B| / |A∪B|"""

    @staticmethod
    def value(common: Column, na: Column, nb: Column) -> Column:
        return common / (na + nb - common)

    @staticmethod
    def size_ratio(threshold: float) -> float:
        return threshold

    @staticmethod
    def needed(threshold: float, na: Column, nb: Column) -> Column:
        return F.lit(threshold / (1.0 + threshold)) * (na + nb)

    # the same of arrays, and the size up to which a set reaches the threshold with one of size ``n`` by so many common elements
    least_common, largest_partner = staticmethod(jaccard_least), staticmethod(jaccard_partner)


class Cosine:
    """|A∩B| / √(|A|·|B|)"""

    @staticmethod
    def value(common: Column, na: Column, nb: Column) -> Column:
        return common / F.sqrt(na.cast("double") * nb)

    @staticmethod
    def size_ratio(threshold: float) -> float:
        return threshold * threshold

    @staticmethod
    def needed(threshold: float, na: Column, nb: Column) -> Column:
        return F.lit(threshold) * F.sqrt(na.cast("double") * nb)

    least_common, largest_partner = staticmethod(cosine_least), staticmethod(cosine_partner)


def sizes_allow(measure, threshold: float, na: Column, nb: Column) -> Column:
    """Whether two sizes leave room for the threshold at all."""
    return F.least(na, nb) >= F.lit(measure.size_ratio(threshold) * (1.0 - SLACK)) * F.greatest(na, nb)


def distinct_sets(df: DataFrame, set_col: str, element_col: str) -> DataFrame:
    """Distinct ``(id, element)``; a null is no element, and rows without a set id belong to no set."""
    return df.select(F.col(set_col).alias("id"), F.col(element_col).alias("element")).dropna().distinct()


def sketched(sets: DataFrame, members: DataFrame) -> DataFrame:
    """``(id, n, sketch)`` of distinct ``(id, element)`` rows, written once; ``sketch`` is an array of 16 … 4096 longs.

    An element flips bit ``h % 64`` of word ``h / 64``, modulo the number of words; with half as many words a sketch is that of
    its two halves flipped together, so sketches of any two lengths compare at the shorter one.
    """
    wanted = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("n") * F.lit(SKETCH_BITS / 64)))).cast("long")
    words = F.greatest(F.lit(LEAST_WORDS), F.least(F.lit(MOST_WORDS), wanted)).alias("words")
    sizes = members.select("id", "n", words)
    hashed = lookup(sets.select("id", F.xxhash64("element").alias("h")), sizes, "id", "n", written=True)
    one = F.lit(1).cast("long")
    flips = hashed.select(
        "id", "n", F.expr("shiftrightunsigned(h, 6) & (words - 1)").alias("slot"),
        F.call_function("shiftleft", one, F.expr("cast(h & 63 as int)")).alias("bit"),
    )
    # a zero for each word, so that the words in order are the whole sketch
    zeros = sizes.join(sets.select("id").distinct(), "id", "left_semi").select(
        "id", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("words") - 1)).alias("slot"), F.lit(0).cast("long").alias("bit")
    )
    filled = flips.unionByName(zeros).groupBy("id", "n", "slot").agg(F.bit_xor("bit").alias("bits"))
    listed = filled.groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("slot", "bits"))).alias("held"))
    return durable(listed.select("id", "n", F.col("held.bits").alias("sketch")))


def _folded(sketch: Column, word: Column | int, words: Column) -> Column:
    """One word of a sketch at a length of ``words``."""
    word = F.lit(word).cast("int") if isinstance(word, int) else word
    places = F.sequence(word, F.size(sketch) - 1, words)
    return F.aggregate(places, F.lit(0).cast("long"), lambda held, at: held.bitwiseXOR(F.get(sketch, at)))


def short_sketch(sketch: Column) -> list[Column]:
    """The sketch at its least length, as columns for ``short_apart``."""
    return [_folded(sketch, word, F.lit(LEAST_WORDS)).alias(name) for word, name in enumerate(SHORT)]


SHORT = [f"s{word}" for word in range(LEAST_WORDS)]


def may_reach(measure, threshold: float, na: Column, nb: Column, apart: Column) -> Column:
    """Whether sets that differ in at least ``apart`` elements can have the similarity."""
    return apart <= na + nb - F.lit(2) * F.ceil(measure.needed(threshold, na, nb) * F.lit(1.0 - SLACK))


def short_apart(left, right) -> Column:
    total = F.lit(0)
    for word in SHORT:
        total = total + F.bit_count(left(word).bitwiseXOR(right(word)))
    return total


def _sketches_apart(left: Column, right: Column) -> Column:
    words = F.least(F.size(left), F.size(right))
    return F.aggregate(
        F.sequence(F.lit(0), words - 1), F.lit(0),
        lambda total, word: total + F.bit_count(_folded(left, word, words).bitwiseXOR(_folded(right, word, words))),
    )


def verify(
    candidates: DataFrame, sets: DataFrame, sketches: DataFrame, measure, threshold: float, block_elements: int = BLOCK_ELEMENTS,
    short: bool = False,
) -> DataFrame:
    """Exact similarity of candidate pairs ``(a, b, na, nb)``, kept at ``threshold`` and above.

    Pairs whose sketches rule them out leave first, so elements are compared for little more than the result.
    Sets of up to ``PACKED_SET`` elements are compared as rows; pairs with a larger one stay in long form, so no larger set
    has to fit in a row or a task. ``short`` says that sketches of the least length have been compared before; they are the whole
    sketches where the smaller set has few elements.
    """
    known = F.least("na", "nb") <= F.lit(LEAST_WORDS * 64 // SKETCH_BITS) if short else F.lit(False)
    candidates = durable(candidates.select("a", "b", "na", "nb"))
    near = _near(candidates.where(~known), sketches, measure, threshold, block_elements)
    candidates = near.unionByName(candidates.where(known)) if short else near
    wide = F.greatest("na", "nb") > F.lit(PACKED_SET)

    def listed(ids: DataFrame) -> DataFrame:
        return sets.join(ids, "id", "left_semi").groupBy("id").agg(F.collect_list("element").alias("elements"))

    packed = _common_packed(candidates.where(~wide), listed, block_elements)
    # the long form reads all sets
    if not candidates.where(wide).isEmpty():
        packed = packed.unionByName(_common_long(candidates.where(wide), sets))
    return _similar(packed, measure, threshold)


def _near(candidates: DataFrame, sketches: DataFrame, measure, threshold: float, block_elements: int) -> DataFrame:
    """The candidates that their sketches do not rule out, written once; a sketch is sent once to each pair of blocks."""
    placed, homes = _placed(candidates, block_elements)
    held = sketches.join(homes.select("id"), "id", "left_semi").select("id", F.col("sketch").alias("held"))
    apart = in_block_pairs(placed, _sent(placed).join(held, "id"), sketched=True)
    return durable(apart.where(may_reach(measure, threshold, F.col("na"), F.col("nb"), F.col("value"))).drop("value"))


def _similar(common: DataFrame, measure, threshold: float) -> DataFrame:
    return common.where(F.col("common") > 0).select(
        "a", "b", measure.value(F.col("common"), F.col("na"), F.col("nb")).alias("similarity")
    ).where(F.col("similarity") >= threshold)


def _common_packed(pairs: DataFrame, listed: Callable[[DataFrame], DataFrame], block_elements: int) -> DataFrame:
    """``(a, b, na, nb, common)`` of pairs of sets that fit in a row; ``listed`` gives the rows ``(id, elements)`` of some ids.

    Near copies come in groups, whose pairs grow with the square of their size. A set belongs to the smallest set it is paired
    with, and the sets of one such hub are cut into blocks of bounded size. A set is sent once to each pair of blocks that
    has pairs of it, and not once for each of its pairs.
    """
    placed, homes = _placed(pairs, block_elements)
    held = listed(homes.select("id")).select("id", F.col("elements").alias("held"))
    found = in_block_pairs(placed, _sent(placed).join(held, "id"), sketched=False)
    return found.withColumnRenamed("value", "common")


def _sent(placed: DataFrame) -> DataFrame:
    """The sets ``id`` that each pair of blocks needs, once each."""
    return placed.select("one", "two", F.explode(F.array("a", "b")).alias("id")).distinct()


def _placed(pairs: DataFrame, block_elements: int) -> tuple[DataFrame, DataFrame]:
    """The pairs with the two blocks ``(one, two)`` they lie in, and the block ``home`` of each set ``id``."""
    ends = pairs.select(F.inline(F.array(
        F.struct(F.col("a").alias("id"), F.col("na").alias("n"), F.col("a").alias("low")),
        F.struct(F.col("b").alias("id"), F.col("nb").alias("n"), F.col("a").alias("low")),
    )))
    ends = durable(ends.groupBy("id").agg(F.max("n").alias("n"), F.min("low").alias("hub")))
    hubs = ends.groupBy("hub").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("elements"))
    blocks = F.greatest(F.ceil(F.col("elements") / block_elements), F.ceil(F.col("members") / BLOCK_SETS))
    home = F.struct("hub", F.pmod(F.xxhash64("id"), blocks).alias("block"))
    homes = durable(lookup(ends, hubs, "hub", "members").select("id", home.alias("home")))
    placed = pairs
    for end in "ab":
        placed = placed.join(homes.select(F.col("id").alias(end), F.col("home").alias(f"_{end}")), end)
    placed = placed.select("a", "b", "na", "nb", F.least("_a", "_b").alias("one"), F.greatest("_a", "_b").alias("two"))
    return durable(placed), homes


def _common_long(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``(a, b, na, nb, common)``: the smaller set's elements are looked up in the larger one, both in long form."""
    smaller_a = F.col("na") <= F.col("nb")
    oriented = pairs.select(
        "a",
        "b",
        "na",
        "nb",
        F.when(smaller_a, F.col("a")).otherwise(F.col("b")).alias("small"),
        F.when(smaller_a, F.col("b")).otherwise(F.col("a")).alias("large"),
    )
    probe = sets.select(F.col("id").alias("small"), "element")
    build = sets.select(F.col("id").alias("large"), "element")
    return (
        oriented.join(probe, "small")
        .join(build, ["large", "element"], "left_semi")
        .groupBy("a", "b", "na", "nb")
        .agg(F.count(F.lit(1)).alias("common"))
    )


def _popularity_class(holders: Column) -> Column:
    """Monotone classes of the holder count: exact to 32, then 16 per doubling."""
    return F.when(holders <= 32, holders).otherwise(
        F.lit(32) + F.ceil((F.log2(holders) - F.lit(5.0)) * F.lit(16.0))
    ).cast("int")


def _prefixes(sets: DataFrame, sketches: DataFrame, measure, threshold: float) -> DataFrame:
    """``(element, id, n, before, upto, direct)`` rows to be joined: each set's prefix and its elements
    with few holders. ``before`` counts the set's elements in lower classes, ``upto`` those up to the
    element's class or up to the directly counted ones, whichever reaches further."""
    holders = sets.groupBy("element").agg(F.count(F.lit(1)).alias("holders"))
    ranked = lookup(sets, holders, "element", "holders").select(
        "id", "element", _popularity_class(F.col("holders")).alias("klass"), "holders"
    )
    direct = F.col("klass") <= DIRECT_CLASS
    histogram = ranked.groupBy("id", "klass").agg(F.count(F.lit(1)).alias("rows"))
    # At most a few hundred classes per set.
    classes = Window.partitionBy("id")
    required = F.ceil(F.lit(measure.size_ratio(threshold) * (1.0 - SLACK)) * F.col("n"))
    places = (
        histogram.withColumn("upto", F.sum("rows").over(classes.orderBy("klass")))
        .withColumn("before", F.col("upto") - F.col("rows"))
        .withColumn("counted", F.coalesce(F.sum(F.when(direct, F.col("rows"))).over(classes), F.lit(0)))
        .join(sketches.select("id", "n"), "id")
        .where(direct | (F.col("before") <= F.col("n") - required))
        .select("id", "klass", "rows", "n", "before", F.greatest("upto", "counted").alias("upto"))
    )
    prefix = lookup(ranked.where(F.col("holders") > 1), places, ["id", "klass"], "rows").select(
        "element", "id", "n", "before", "upto", direct.alias("direct")
    )
    return lookup(prefix, sketches.select("id", F.col("n").alias("_n"), *short_sketch(F.col("sketch"))), "id", "_n").drop("_n")


def prefix_candidates(
    sets: DataFrame, sketches: DataFrame, measure, threshold: float, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Pairs ``(a, b, na, nb, met, left_over)`` that the prefix, position and short sketches cannot rule out:
    ``met`` common elements are known and at most ``left_over`` more can be common."""

    def needed(na, nb):
        return F.ceil(measure.needed(threshold, na, nb) * F.lit(1.0 - SLACK))

    def keep(left, right):
        # The prefix each set needs for this partner's size; shorter than the one for any partner.
        spare = needed(left("n"), right("n"))
        in_prefixes = (left("before") <= left("n") - spare) & (right("before") <= right("n") - spare)
        near = may_reach(measure, threshold, left("n"), right("n"), short_apart(left, right))
        # the same on both sides, as is the element; both are named, so that both sides of the join keep the same columns
        direct = left("direct") & right("direct")
        return sizes_allow(measure, threshold, left("n"), right("n")) & (direct | in_prefixes) & near

    prefix = durable(_prefixes(sets, sketches, measure, threshold))
    met = pairs_within(
        prefix, ["element"], "id", ["n", "before", "upto", "direct", *SHORT], keep=keep, block_rows=block_rows
    )
    counted = met.groupBy(F.col("a_id").alias("a"), F.col("b_id").alias("b")).agg(
        F.max("a_n").alias("na"),
        F.max("b_n").alias("nb"),
        F.max("a_upto").alias("ua"),
        F.max("b_upto").alias("ub"),
        F.count(F.lit(1)).alias("met"),
    )
    # Common elements up to the last class met have all been met; later ones fit in what is left of
    # either set.
    left_over = F.least(F.col("na") - F.col("ua"), F.col("nb") - F.col("ub"))
    return counted.withColumn("left_over", left_over).where(
        F.col("met") + F.col("left_over") >= needed(F.col("na"), F.col("nb"))
    )


def prepared(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(unique, members)``: the distinct sets' rows and the copy groups, both written once."""
    sets = durable(sets)
    members = durable(set_copies(sets))
    if not has_copies(members):
        return sets, members
    heads = members.where(F.col("id") == F.col("rep")).select("id")
    return durable(sets.join(heads, "id", "left_semi")), members


def _exact_join(df, set_col, element_col, measure, threshold, block_rows):
    if threshold <= 0:
        raise ValueError("an exact set join needs a threshold above 0")
    unique, members = prepared(distinct_sets(df, set_col, element_col))
    return expand_copies(exact_pairs(unique, members, measure, threshold, block_rows), members, block_rows)


def exact_pairs(unique: DataFrame, members: DataFrame, measure, threshold: float, block_rows: int) -> DataFrame:
    """``(a, b, similarity)`` of all pairs of distinct sets at ``threshold`` and above; pairs with a set that does not fit in a row
    are found in long form."""
    narrow, fits = unique, F.col("n") <= PACKED_SET
    wide = not members.where(~fits).isEmpty()
    if wide:
        narrow = unique.join(members.where(fits).select("id"), "id", "left_semi")
    packed, quiet = packed_sets(narrow, members, block_rows)
    found = pairs_that_may_reach(packed, measure, threshold, quiet, block_rows)

    def listed(ids: DataFrame) -> DataFrame:
        return packed.join(ids, "id", "left_semi").select("id", F.col("numbers").alias("elements"))

    pairs = _similar(_common_packed(found, listed, BLOCK_ELEMENTS), measure, threshold)
    if not wide:
        return pairs
    # all that can be paired with a wide set
    large = members.where(F.col("n") >= F.lit(measure.size_ratio(threshold) * (1.0 - SLACK) * PACKED_SET)).select("id")
    return pairs.unionByName(
        _long_pairs(unique.join(large, "id", "left_semi"), members, measure, threshold, block_rows)
    )


def _long_pairs(sets: DataFrame, members: DataFrame, measure, threshold: float, block_rows: int) -> DataFrame:
    """``(a, b, similarity)`` of the pairs that have a set of more than ``PACKED_SET`` elements."""
    sets = durable(sets)
    sketches = sketched(sets, members)
    found = prefix_candidates(sets, sketches, measure, threshold, block_rows)
    candidates = durable(found.where(F.greatest("na", "nb") > PACKED_SET))
    settled = candidates.where(F.col("left_over") == 0).select(
        "a", "b", measure.value(F.col("met"), F.col("na"), F.col("nb")).alias("similarity")
    )
    open_pairs = verify(candidates.where(F.col("left_over") > 0), sets, sketches, measure, threshold)
    return settled.where(F.col("similarity") >= threshold).unionByName(open_pairs)


def jaccard_join(
    df: DataFrame, set_col: str, element_col: str, threshold: float = 0.5, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """All pairs of sets ``(a, b, similarity)`` with Jaccard ≥ threshold."""
    return _exact_join(df, set_col, element_col, Jaccard, threshold, block_rows)


def cosine_join(
    df: DataFrame, set_col: str, element_col: str, threshold: float = 0.47, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """All pairs of sets ``(a, b, similarity)`` whose 0/1 vectors have cosine ≥ threshold."""
    return _exact_join(df, set_col, element_col, Cosine, threshold, block_rows)
