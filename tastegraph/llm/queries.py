"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph.catalog.inputs import table
from tastegraph.llm import (
    bitslice,
    decontaminate,
    infill,
    licenses,
    manifest,
    neardup,
    packing,
    pii,
    pseudolik,
    quality,
    setrelations,
    shards,
    suffixes,
)
from tastegraph.llm.oracles import ORACLES


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", pii.find_spans("text").alias("found"))

    def of(*kinds: str) -> Column:
        return F.filter("found", lambda s: s["kind"].isin(*kinds))

    base = of(*pii.BASE_KINDS)
    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in pii.BASE_KINDS]
    return docs.select(
        "doc_id", *counts, F.sha2(pii.listed(base), 256).alias("base_sha256"), pii.listed(F.col("found")).alias("spans")
    )


def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with its shard; a shard holds at most 32 MiB of text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = shards.shards(docs, F.col("doc_id"))
    return found.select(F.col("row.doc_id").alias("doc_id"), "shard", "depth", "row_bytes", "shard_bytes")


def op3_bitslice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitslice.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.Model:
    """Grades from the labels: 0 for bad text, 1 for good text that is toxic, 2 for good text that is not."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("toxic") == 0, 2)
    return quality.fit_on(docs, table(spark, sf_dir, "labels"), grade)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.graded(docs, quality_model(spark, docs, sf_dir))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "documents").select("doc_id", licenses.find_licenses("text").alias("found"))
    return found.select("doc_id", F.size("found").cast("long").alias("n_licenses"), licenses.listed(F.col("found")).alias("licenses"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=2)


def op8_pseudolik(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores are rounded: sums of floats differ in their last digits from run to run."""
    found = pseudolik.pseudo_likelihood(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", F.round("log_likelihood", 3).alias("log_likelihood"), F.round("mean", 5).alias("mean_log_likelihood")
    )


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op11_setrelations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setrelations.linked(table(spark, sf_dir, "documents"))


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digested(table(spark, sf_dir, "documents"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest, and for each row the root that its proof gives for its text as it may have been changed since."""
    docs = table(spark, sf_dir, "documents")
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    text = F.when(changed, manifest.tampered(F.col("text"))).otherwise(F.col("text"))
    leaves = docs.select(
        "doc_id",
        manifest.group_key(F.col("lang")).alias("group"),
        manifest.leaf(*[F.col(c) for c in manifest.FIELDS]).alias("leaf"),
        manifest.leaf(*[F.col(c) for c in manifest.FIELDS[:-1]], text).alias("found"),
    )
    proven = manifest.proofs(leaves).withColumn("folded_root", manifest.folded(F.col("found"), F.col("path")))
    return proven.select(
        "doc_id", "leaf", "subroot", "root", manifest.proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


__all__ = ["ORACLES", "QUERIES"]

QUERIES = {
    "op1_pii": op1_pii,
    "op2_shards": op2_shards,
    "op3_bitslice": op3_bitslice,
    "op4_quality": op4_quality,
    "op5_packing": op5_packing,
    "op6_licenses": op6_licenses,
    "op7_minhash": op7_minhash,
    "op8_pseudolik": op8_pseudolik,
    "op9_decontaminate": op9_decontaminate,
    "op10_suffixes": op10_suffixes,
    "op11_setrelations": op11_setrelations,
    "op12_infill": op12_infill,
    "op13_manifest": op13_manifest,
}
