"""Benchmark decontamination by a prefix-filtered join of word windows, in DataFrame operations only.

A window is ``window`` consecutive words of an item (an item of fewer words is one window). A document
contains it if all its words occur there in order, so the join threshold is full containment and the
necessary prefix of a window is one shingle: its rarest word over all documents. The steps:

1. count, over all documents, the words that items use (partial aggregation, joined to their vocabulary);
2. order each window's words by rarity and keep the rarest with its offset in the window;
3. meet the documents' words with these prefix words, apply the positional bound (the window must start at
   or after the first word) and the length bound (it must end at or before the last one), and verify the
   words of the span exactly;
4. add up the covered words of each document (running maximum of span ends) and its items.

Documents are read twice and exploded inside one stage; only verified hits and one row per document are
shuffled. Benchmark windows are broadcast while they are measured to be small; beyond ``BROADCAST_BYTES``
the words travel to the windows instead, and the spans are verified after a join back to their documents.

Words are compared with A-Z in lower case and all other letters as they are. Matching keys use a stronger
lower case, which only adds candidates.

Edge cases: a null text or one without words has no hits; items without words or text have no windows; equal
items each count; rows of the same id and text are judged together and returned as often as they came; a null
id is an id like others; other columns of any name pass ``decontaminate`` untouched; empty tables are fine.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.plans.durable import durable

WINDOW = 13
# A document is contaminated when at least one in so many of its words is hit.
SHARE = 20
BROADCAST_BYTES = 16 << 20
# All of ASCII but digits and letters; applied to texts before lower-casing.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text in their own case."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def lowered(text: Column) -> Column:
    """A-Z in lower case, everything else unchanged."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def item_windows(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """``(item_id, span, n)``: the windows of each item, words joined by blanks."""
    plain = items.select(F.col(item_id).alias("item_id"), words(lowered(F.col(text))).alias("words"))
    sized = plain.where(F.size("words") > 0).withColumn("n", F.least(F.size("words"), F.lit(window)))
    starts = F.explode(F.sequence(F.lit(1), F.size("words") - F.col("n") + 1)).alias("at")
    return sized.select("item_id", "words", "n", starts).select(
        "item_id", F.array_join(F.slice("words", F.col("at"), F.col("n")), " ").alias("span"), "n"
    )


def small(table: DataFrame, text: str, most: int = BROADCAST_BYTES) -> bool:
    """Whether the rows of a table, measured by its text column, may be broadcast."""
    size = table.agg(F.sum(F.octet_length(text) + 64)).first()[0]
    return (size or 0) <= most


def rarest_words(spans: DataFrame, docs: DataFrame, text: str, most: int) -> DataFrame:
    """``(span, n, token, offset)``: the rarest word of each window; windows with an unused word drop out."""
    inside = spans.select("span", "n", F.posexplode(F.split("span", " ")).alias("offset", "word")).withColumn(
        "token", F.lower("word")
    )
    vocabulary = inside.select("token").distinct()
    if small(vocabulary, "token", most):
        vocabulary = F.broadcast(vocabulary)
    found = docs.select(F.explode(words(F.col(text))).alias("word")).select(F.lower("word").alias("token"))
    counts = found.join(vocabulary, "token").groupBy("token").agg(F.count(F.lit(1)).alias("uses"))
    ranked = inside.join(counts, "token", "left").groupBy("span", "n").agg(
        F.min(F.struct(F.coalesce("uses", F.lit(0)).alias("uses"), "token", "offset")).alias("best")
    )
    return ranked.where(F.col("best.uses") > 0).select("span", "n", "best.token", "best.offset")


def span_hits(docs: DataFrame, prefixes: DataFrame, most: int) -> DataFrame:
    """Verified spans ``(*key, n_words, start, end, span)`` of documents ``(*key, text)``, and for each
    document one row more with null spans."""
    key = ["_k1", "_k2", "doc_id"]
    # the blank first entry stands for the document itself; it makes positions count from 1
    listed = F.concat(F.array(F.lit("")), F.col("_words")).alias("_listed")
    own = docs.select(*key, words(F.col("text")).alias("_words"))
    # "at" is the first word of the span
    first = F.col("pos") - F.col("offset")
    fits = (first >= 1) & (first + F.col("n") - 1 <= F.col("n_words"))
    same = lowered(F.array_join(F.slice("_words", first, F.col("n")), " ")) == F.col("span")
    columns = [*key, "n_words", first.alias("start"), (first + F.col("n")).alias("end"), "span"]
    if small(prefixes, "span", most):
        placed = own.select(*key, "_words", F.size("_words").alias("n_words"), F.posexplode(listed).alias("pos", "word"))
        met = placed.join(F.broadcast(prefixes), F.lower("word") == F.col("token"), "left")
        return met.where((F.col("pos") == 0) | (F.col("span").isNotNull() & fits & same)).select(*columns)
    placed = own.select(*key, F.size("_words").alias("n_words"), F.posexplode("_words").alias("pos0", "word")).select(
        *key, "n_words", (F.col("pos0") + 1).alias("pos"), F.lower("word").alias("token")
    )
    candidates = placed.join(prefixes, "token").where(fits)
    texts = own.dropDuplicates(["_k1", "_k2"]).select("_k1", "_k2", "_words")
    verified = candidates.join(texts, ["_k1", "_k2"]).where(same).select(*columns)
    nothing = [F.lit(None).cast(verified.schema[c].dataType).alias(c) for c in ("start", "end", "span")]
    return verified.unionByName(own.select(*key, F.size("_words").alias("n_words"), *nothing))


def keyed(docs: DataFrame, doc_id: str, text: str) -> list[Column]:
    """128 bits for the id and the text of a row; rows equal in both are one document."""
    fields = [docs[doc_id], docs[text]]
    return [F.xxhash64(*fields).alias("_k1"), F.xxhash64(F.lit(29), *reversed(fields)).alias("_k2")]


def contamination(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    share: int = SHARE,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per document: ``(_k1, _k2, doc_id, n_words, n_hit, n_items, items, contaminated)``."""
    key = ["_k1", "_k2"]
    own = docs.select(*keyed(docs, doc_id, text), docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    uses = durable(item_windows(items, item_id, item_text, window))
    spans = uses.select("span", "n").distinct()
    prefixes = durable(rarest_words(spans, own, "text", broadcast_bytes))
    hits = durable(span_hits(own, prefixes, broadcast_bytes))

    each = hits.where(F.col("start").isNull()).groupBy(*key).agg(
        F.first("doc_id").alias("doc_id"), F.max("n_words").cast("long").alias("n_words"), F.count(F.lit(1)).alias("_rows")
    )
    found = hits.where(F.col("start").isNotNull())
    before = Window.partitionBy(*key).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.col("end") - F.greatest(F.col("start"), F.coalesce(F.max("end").over(before), F.lit(0)))
    covered = (
        found.groupBy(*key, "start").agg(F.max("end").alias("end"))
        .select(*key, F.greatest(fresh, F.lit(0)).alias("fresh"))
        .groupBy(*key).agg(F.sum("fresh").alias("n_hit"))
    )
    named = (
        found.select(*key, "span").distinct()
        .join(uses.select("span", F.col("item_id").cast("string").alias("item")).distinct(), "span")
        .groupBy(*key).agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return (
        each.join(covered, key, "left").join(named, key, "left")
        .select(
            *key, "doc_id", "n_words", hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
            listed.alias("items"), ((hit > 0) & (F.lit(share) * hit >= F.col("n_words"))).alias("contaminated"),
            F.explode(F.sequence(F.lit(1), F.col("_rows").cast("int"))).alias("_copy"),
        )
        .drop("_copy")
    )


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    bad = contamination(docs, items, doc_id, text, **options).where("contaminated").select("_k1", "_k2").distinct()
    # a row travels as one struct, so that no column of it can clash with the keys
    own = docs.select(*keyed(docs, doc_id, text), F.struct("*").alias("row"))
    return own.join(bad, ["_k1", "_k2"], "left_anti").select("row.*")
