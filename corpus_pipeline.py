"""A pipeline from raw documents to packed training sequences; counted as part of ``tastegraph.llm``.

Each stage takes ``(spark, docs, sf_dir)`` and works on all documents that the stage before kept. All but the last return
documents with the columns they came with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph.catalog.inputs import table
from tastegraph.llm import decontaminate, neardup, packing, pii, quality
from tastegraph.llm.queries import quality_model
from tastegraph.plans.durable import scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likely to have the highest grade."""
    return quality.select_good(docs, quality_model(spark, docs, sf_dir))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group linked by 0.8 of their five-word shingles."""
    return neardup.deduplicate(docs, words=5)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less than a twentieth of whose words lie in passages of benchmark items."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def privacy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked; ``n_chars`` follows the text."""
    masked = pii.redact(docs)
    return masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in token sequences."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", privacy_stage),
    ("packing", packing_stage),
]

# The classifier and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each result written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
