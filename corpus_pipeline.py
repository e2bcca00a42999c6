"""From raw documents to training sequences, one operator per stage.

Quality classifier, exact dedup, n-gram Jaccard join, benchmark decontamination and
power-of-two packing. Each stage works on what the one before it kept; all but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from waypost.llm.decontaminate import drop_leaks
from waypost.llm.exact_dedup import drop_copies
from waypost.llm.jaccard import drop_near_copies
from waypost.llm.packing import pack_documents
from waypost.llm.quality import fit, keep_good
from waypost.workspace import release, settle, sweep


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labels of ``docs``."""
    return keep_good(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles and a similarity of 0.8 the one with the smallest id."""
    return drop_near_copies(docs, n=5, share=(80, 100))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences of the documents that are left, with their ids."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard_join", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("packing", packing),
]

#: The first and the last stage have no SQL; tests/llm checks each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again.

    What a stage has read, and the shuffle files of its steps, go once it is written.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
        if before is not None:
            release(before)
        sweep(spark)
        before = docs
    return docs
