"""Pearson similarity of users or items over the keys both have rated.

The sums behind r come from a co-rating self-join. Three things keep it within bounds:

* A pair with one common key has r = 0 and no effect anywhere, so a pair needs two. Hence the pairs
  inside a key's group need not be formed when that key is the most popular one of *both* members:
  the pair is found through another key or it is not needed, and the skipped key's term is added
  from two columns that travel with the row. A key that is everybody's most popular one forms no pairs.
* Test-set consumers pass ``only``: a pair must hold a wanted id.
* Under a key with more than ``block_rows`` members rows are sorted into classes (in the tail or not, wanted or not)
  before pairing, and only classes that can form a pair meet, in blocks of bounded size (``plans.pairing``). Rows
  without a partner are neither copied nor joined.
* The pairs of all other keys are not shuffled. Ids are cut into ranges of about ``TASK_PAIRS`` pairs, every pair belongs
  to one range, and a key sends the list of its members once to each range that it has members in. At most that is an
  entry a pair, as many as pairs would be; it is far less where the members of a key lie in few ranges.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.functions.columns import correlation
from tastegraph.plans.durable import durable
from tastegraph.plans.lookup import lookup
from tastegraph.plans.pairing import BLOCK_ROWS, pairs_across, pairs_within

MAX_TAIL = 2
# Keys of up to so many members are nobody's tail: their pairs cost less than columns that travel with every row.
PLAIN_ROWS = 256
# About so many pairs meet in a task, which holds the sums of each.
TASK_PAIRS = 1 << 21
# Fewer pairs are not worth a task of their own.
LEAST_PAIRS = 1 << 16
# The pairs of a range go to one task for each so many rows of one of its ids.
SPREAD_ROWS = 1024
# Ids of more keys than this have no list of hashes.
MOST_KEYS = 4096


def _sides(ratings: DataFrame, by: str) -> DataFrame:
    key = "item" if by == "user" else "user"
    return ratings.select(
        F.col(by).alias("id"), F.col(key).alias("key"), F.col("rating").cast("double").alias("r")
    )


def _popular_tail(rows: DataFrame, length: int, plain: int) -> DataFrame:
    """The ``length`` most popular keys of each id, of those with more than ``plain`` members, as columns k0, r0, k1, r1."""
    rows = rows.where(F.col("size") > plain)
    if length == 1:
        top = rows.groupBy("id").agg(F.max(F.struct("size", "key", "r")).alias("t"))
        return top.select("id", F.col("t.key").alias("k0"), F.col("t.r").alias("r0"))
    # rank <= constant is planned with a group limit before the shuffle, so a busy id stays small.
    by_size = Window.partitionBy("id").orderBy(F.col("size").desc(), F.col("key").desc())
    ranked = rows.withColumn("rank", F.row_number().over(by_size)).where(F.col("rank") <= length)
    return ranked.groupBy("id").agg(
        *[
            F.max(F.when(F.col("rank") == n + 1, F.col(c))).alias(f"{name}{n}")
            for n in range(length)
            for c, name in (("key", "k"), ("r", "r"))
        ]
    )


def _in_tail(key: Column, length: int) -> Column:
    hit = F.lit(False)
    for n in range(length):
        hit = hit | F.coalesce(key == F.col(f"k{n}"), F.lit(False))
    return hit


def _sums(rows: DataFrame, a: str, b: str, x: str, y: str, extra: list[Column] = (), dealt: list[str] = ()) -> DataFrame:
    """``dealt`` are further columns that follow from the pair."""
    x, y = F.col(x), F.col(y)
    return rows.groupBy(a, b, *dealt).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(x).alias("sx"),
        F.sum(y).alias("sy"),
        F.sum(x * x).alias("sxx"),
        F.sum(y * y).alias("syy"),
        F.sum(x * y).alias("sxy"),
        *extra,
    )


def _finish(sums: DataFrame, min_support: int, keep_zero: bool) -> DataFrame:
    r = correlation(*[F.col(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    pairs = sums.where(F.col("n") >= min_support).select("a", "b", "n", r.alias("similarity"))
    return pairs if keep_zero else pairs.where(F.col("similarity") != 0)


def _useful_pairs(rows: DataFrame, carry: list[str], tail: bool, only: bool, block_rows: int) -> DataFrame:
    """Pairs under a key that are not both in the tail, and of which at least one is wanted."""
    if not tail and not only:
        return pairs_within(rows, ["key"], "id", carry, block_rows=block_rows, size="size")
    in_tail = F.col("in_tail") if tail else F.lit(False)
    wanted = F.col("wanted") if only else F.lit(True)
    classes = {"rest": wanted & ~in_tail, "tail": wanted & in_tail, "unwanted": ~wanted & ~in_tail}
    counts = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), *[F.sum(c.cast("long")).alias(f"n_{name}") for name, c in classes.items()]
    )
    counts = counts.withColumn("n_other", F.col("size") - F.col("n_rest")).where(
        ((F.col("n_rest") > 0) & (F.col("size") > 1)) | ((F.col("n_unwanted") > 0) & (F.col("n_tail") > 0))
    )
    rows = durable(lookup(rows.drop("size"), counts, "key", "size"))
    rest = rows.where(classes["rest"])
    met = pairs_within(rest, ["key"], "id", carry, block_rows=block_rows, size="n_rest").unionByName(
        pairs_across(rest, rows.where(~classes["rest"]), ["key"], "id", carry, ("n_rest", "n_other"), block_rows)
    )
    if tail and only:
        unwanted, tails = rows.where(classes["unwanted"]), rows.where(classes["tail"])
        met = met.unionByName(
            pairs_across(unwanted, tails, ["key"], "id", carry, ("n_unwanted", "n_tail"), block_rows)
        )
    return met


def _owned(mine: Column, other: Column) -> Column:
    """Whether the pairs of two ranges belong to ``mine``: half of the other ranges, above and below."""
    return ((mine + other) % 2 == 0) == (other > mine)


def _share(member: Column, shares: Column) -> Column:
    return F.pmod(F.xxhash64(member), shares).cast("int")


# What a row is, as a bit, and the bits of those it can form a pair with: not both in the tail, one wanted.
REST, TAIL, UNWANTED, UNWANTED_TAIL = 1, 2, 4, 8
PARTNERS = {REST: 15, TAIL: REST | UNWANTED, UNWANTED: REST | TAIL, UNWANTED_TAIL: REST}


def _partners(kind: Column) -> Column:
    bits = F.lit(0)
    for one, others in PARTNERS.items():
        bits = F.when(kind == one, F.lit(others)).otherwise(bits)
    return bits


def _kind(tail: bool, only: bool) -> Column:
    in_tail = F.col("in_tail") if tail else F.lit(False)
    wanted = F.col("wanted") if only else F.lit(True)
    return F.when(wanted, F.when(in_tail, TAIL).otherwise(REST)).otherwise(F.when(in_tail, UNWANTED_TAIL).otherwise(UNWANTED))


def _kinds(entries: Column) -> Column:
    return F.aggregate(entries, F.lit(0), lambda bits, e: bits.bitwiseOR(e["kind"]))


def _ranges(per_id: DataFrame, count: int, spread_rows: int) -> tuple[DataFrame, DataFrame, int]:
    """``per_id`` with the range of each id, the ranges ``(block, first, shares)`` and the number of tasks.

    A range whose ids have many pairs, or an id with more than ``spread_rows`` rows, is dealt to several tasks by the partners.
    """
    placed = durable(per_id.repartitionByRange(count, "id").withColumn("block", F.spark_partition_id()))
    shares = F.greatest(
        F.ceil(F.sum("load") / F.lit(4.0 * TASK_PAIRS)), F.ceil(F.max("rows") / F.lit(float(spread_rows))), F.lit(1)
    )
    # one row for each range, so the running total is over few rows
    ranges = placed.groupBy("block").agg(shares.cast("int").alias("shares"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("shares").over(before), F.lit(0)).cast("int")
    ranges = durable(ranges.select("block", first.alias("first"), "shares"))
    return placed, ranges, ranges.agg(F.sum("shares")).first()[0] or 1


def _sent_lists(rows: DataFrame, ranges: DataFrame, carry: list[str]) -> DataFrame:
    """``(task, shares, share, own, entries)``: under each key, the members of a range, ``own`` in number, and after them
    those whose pairs with them belong to the range."""
    entry = F.struct("id", *carry).alias("entry")
    lists = rows.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("block", entry))).alias("held"))

    def of(block: Column) -> Column:
        own = F.filter("held", lambda e: e["block"] == block)["entry"]
        others = F.filter("held", lambda e: _owned(block, e["block"]))["entry"]
        return F.struct(block.alias("block"), own.alias("own"), others.alias("others"))

    def part(share: Column) -> Column:
        mine = F.filter("others", lambda e: _share(e["id"], F.col("shares")) == share)
        return F.struct(share.alias("share"), F.when(F.col("shares") == 1, F.col("others")).otherwise(mine).alias("others"))

    split = lists.select(F.inline(F.transform(F.array_distinct("held.block"), of)))
    # one row for each range
    dealt = split.join(F.broadcast(ranges), "block").select(
        "own", "first", "shares", F.inline(F.transform(F.sequence(F.lit(0), F.col("shares") - 1), part))
    )
    if "kind" in carry:
        # Every kind can form a pair with REST, so where that is among the members all entries stay. As a generator, so that the
        # bits are not worked out again for each entry.
        rest = F.exists("own", lambda e: e["kind"] == REST)
        of_own, of_others = (F.when(~rest, _kinds(F.col(c))).alias(f"of_{c}") for c in ("own", "others"))
        dealt = dealt.select("*", F.inline(F.array(F.struct(rest.alias("rest"), of_own, of_others))))
        every = F.col("of_own").bitwiseOR(F.col("of_others"))
        own = F.filter("own", lambda e: e["partners"].bitwiseAND(every) != 0)
        others = F.filter("others", lambda e: e["partners"].bitwiseAND(F.col("of_own")) != 0)
        dealt = dealt.withColumns(
            {
                "own": F.when(F.col("rest"), F.col("own")).otherwise(own),
                "others": F.when(F.col("rest"), F.col("others")).otherwise(others),
            }
        )
    return dealt.where((F.size("own") > 0) & (F.size("own") + F.size("others") > 1)).select(
        (F.col("first") + F.col("share")).alias("task"),
        "share",
        "shares",
        F.size("own").alias("own"),
        F.concat("own", "others").alias("entries"),
    )


def _sent_pairs(met: DataFrame, ranges: DataFrame, carry: list[str]) -> DataFrame:
    """Pairs, to the tasks that ``_sent_lists`` sends theirs to: the side in the range that the pair belongs to is ``l``."""
    turned = (F.col("a_block") != F.col("b_block")) & ~_owned(F.col("a_block"), F.col("b_block"))

    def side(name: str) -> Column:
        return F.struct(*[F.col(f"{name}_{c}").alias(c) for c in ("id", *carry)])

    split = met.select(
        F.when(turned, F.col("b_block")).otherwise(F.col("a_block")).alias("block"),
        F.when(turned, side("b")).otherwise(side("a")).alias("l"),
        F.when(turned, side("a")).otherwise(side("b")).alias("r"),
    )
    share = _share(F.col("r.id"), F.col("shares"))
    return split.join(F.broadcast(ranges), "block").select(
        (F.col("first") + share).alias("task"), share.alias("share"), "shares", F.lit(1).alias("own"), "l", "r"
    )


def pearson_pairs(
    ratings: DataFrame,
    by: str = "user",
    min_support: int = 1,
    only: DataFrame | None = None,
    keep_zero: bool = False,
    block_rows: int = BLOCK_ROWS,
    spread_rows: int = SPREAD_ROWS,
) -> DataFrame:
    """``(a, b, n, similarity)`` with a < b, for pairs with at least ``min_support`` common keys.

    Pairs with r = 0 are left out unless ``keep_zero``. ``only`` is a one-column frame of distinct
    ids of which each pair must hold at least one. ``ratings`` must hold one row per (user, item).
    """
    need = max(min_support, 1 if keep_zero else 2)
    rows = _sides(ratings, by)
    popularity = durable(rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1))
    all_pairs, most = popularity.agg(F.sum(F.col("size") * (F.col("size") - 1.0) / 2), F.max("size")).first()
    all_pairs, most = all_pairs or 0, most or 0
    plain = min(PLAIN_ROWS, block_rows)
    tail = min(need - 1, MAX_TAIL) if most > plain else 0
    rows = lookup(rows, popularity, "key", "size", written=True)

    carry = ["r"]
    per_id = rows.groupBy("id").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("load"))
    if tail:
        per_id = per_id.join(_popular_tail(rows, tail, plain), "id", "left")
        carry += [f"{c}{n}" for n in range(tail) for c in "kr"]
    if only is not None:
        marked = only.select(F.col(only.columns[0]).alias("id"), F.lit(True).alias("wanted"))
        per_id = per_id.join(marked, "id", "left")
    cores = rows.sparkSession.sparkContext.defaultParallelism
    count = max(math.ceil(all_pairs / TASK_PAIRS), min(cores, math.ceil(all_pairs / LEAST_PAIRS)), 1)
    per_id, ranges, tasks = _ranges(per_id, count, spread_rows)
    rows = lookup(rows, per_id, "id", "rows", written=True).drop("rows", "load")
    if tail:
        rows = rows.withColumn("in_tail", _in_tail(F.col("key"), tail))
    if only is not None:
        rows = rows.withColumn("wanted", F.coalesce("wanted", F.lit(False)))
    if tail or only is not None:
        rows = rows.withColumn("kind", _kind(tail > 0, only is not None)).withColumn("partners", _partners(F.col("kind")))
        carry += ["kind", "partners"]
    sent = _sent_lists(rows.where(F.col("size") <= block_rows), ranges, carry)
    if most > block_rows:
        busy = rows.where(F.col("size") > block_rows)
        met = _useful_pairs(busy, [*carry, "block"], tail > 0, only is not None, block_rows)
        sent = sent.unionByName(_sent_pairs(met, ranges, carry), allowMissingColumns=True)
        sent = sent.repartitionById(tasks, "task").withColumn("entries", F.coalesce("entries", F.array("l", "r"))).drop("l", "r")
    else:
        sent = sent.repartitionById(tasks, "task")
    lefts = sent.select("*", F.posexplode("entries").alias("at", "l")).where(F.col("at") < F.col("own"))
    met = lefts.select("task", "shares", "share", "at", "l", F.posexplode("entries").alias("to", "r")).where(
        (F.col("to") > F.col("at")) & ((F.col("shares") == 1) | (_share(F.col("r.id"), F.col("shares")) == F.col("share")))
    )
    if "kind" in carry:
        met = met.where(F.col("l.partners").bitwiseAND(F.col("r.kind")) != 0)
    shared = []
    for n in range(tail):
        partner = F.lit(None).cast("double")
        for m in range(tail):
            partner = F.when(F.col(f"l.k{n}") == F.col(f"r.k{m}"), F.col(f"r.r{m}")).otherwise(partner)
        met = met.withColumn(f"y{n}", partner).withColumn(f"x{n}", F.when(F.col(f"y{n}").isNotNull(), F.col(f"l.r{n}")))
        shared += [F.max(f"x{n}").alias(f"x{n}"), F.max(f"y{n}").alias(f"y{n}")]
    # A pair meets in one task under all its keys, always with the same side as l.
    sums = _sums(
        met.select(
            "task",
            F.col("l.id").alias("a"),
            F.col("r.id").alias("b"),
            F.col("l.r").alias("x"),
            F.col("r.r").alias("y"),
            *[c for n in range(tail) for c in (f"x{n}", f"y{n}")],
        ),
        "a",
        "b",
        "x",
        "y",
        shared,
        ["task"],
    )
    for n in range(tail):
        x, y = F.col(f"x{n}"), F.col(f"y{n}")
        there = y.isNotNull()

        def plus(name, term):
            return (F.col(name) + F.when(there, term).otherwise(F.lit(0.0))).alias(name)

        sums = sums.select(
            "a",
            "b",
            (F.col("n") + there.cast("long")).alias("n"),
            plus("sx", x),
            plus("sy", y),
            plus("sxx", x * x),
            plus("syy", y * y),
            plus("sxy", x * y),
            *[f"{c}{m}" for m in range(n + 1, tail) for c in "xy"],
        )
    # r is the same for both orders of the sides
    sums = sums.withColumns({"a": F.least("a", "b"), "b": F.greatest("a", "b")})
    return _finish(sums, need, keep_zero)


def pearson_of(
    candidates: DataFrame, ratings: DataFrame, by: str = "user", min_support: int = 1, keep_zero: bool = False
) -> DataFrame:
    """Pearson of given pairs ``(a, b)`` only: each pair meets its own ratings, no co-rating join.

    Most candidates have too few common keys, so the ratings are sent only to pairs that ``_may_support`` leaves.
    """
    rows = _sides(ratings, by)
    need = max(min_support, 1 if keep_zero else 2)
    mine = rows.select(F.col("id").alias("a"), "key", F.col("r").alias("x"))
    theirs = rows.select(F.col("id").alias("b"), "key", F.col("r").alias("y"))
    met = _may_support(candidates.select("a", "b"), rows, need).join(mine, "a").join(theirs, ["b", "key"])
    return _finish(_sums(met, "a", "b", "x", "y"), need, keep_zero)


def _may_support(candidates: DataFrame, rows: DataFrame, need: int, most_keys: int = MOST_KEYS) -> DataFrame:
    """The pairs but those that surely have fewer than ``need`` common keys, by lists of 16-bit hashes of the keys.

    Common keys have equal hashes, and of c common keys at most as many hashes are lost as coincide in the first list:
    no pair with enough keys is left out. A pair that holds an id of more than ``most_keys`` keys is not looked at.
    """
    short = (F.pmod(F.xxhash64("key"), F.lit(65536)) - F.lit(32768)).cast("short")
    sizes = rows.groupBy("id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most_keys).select("id")
    # read by both sides
    lists = durable(rows.join(sizes, "id", "left_anti").groupBy("id").agg(F.collect_list(short).alias("held")))
    twice = F.size("ha") - F.size(F.array_distinct("ha"))
    near = F.size(F.array_intersect("ha", "hb")) + twice >= need
    return (
        candidates.join(lists.select(F.col("id").alias("a"), F.col("held").alias("ha")), "a", "left")
        .join(lists.select(F.col("id").alias("b"), F.col("held").alias("hb")), "b", "left")
        .where(F.col("ha").isNull() | F.col("hb").isNull() | near)
        .select("a", "b")
    )
