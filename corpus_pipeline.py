"""The corpus pipeline: from raw documents to packed token sequences.

Each stage works on all that the one before it kept. Rows with nulls in any
column, empty texts, repeated rows and empty tables have the results that the
operators define; the columns of ``documents``, and any others, pass through
every stage but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpath.llm import common, decontaminate, packing, quality, simhash, suffix_dedup


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects; it learns from the labels table."""
    common.configure(spark)
    net = quality.fit(*quality.training_rows(docs, common.read(spark, sf_dir, "labels")))
    column = common.fresh(docs, "score")
    return quality.scored(docs, net, column).filter(F.col(column) >= quality.ACCEPT).drop(column)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash component, the one with the smallest doc_id."""
    common.configure(spark)
    return simhash.representatives(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out passages of over 50 words that repeat; a document left without text stays as an empty one."""
    common.configure(spark)
    cut = suffix_dedup.cleaned(docs, suffix_dedup.PASSAGE_LENGTH, suffix_dedup.PASSAGE_WORDS)
    return cut.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")) if "n_chars" in docs.columns else cut


def benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that contain a benchmark item."""
    return decontaminate.clean(docs, common.read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut every document's token ids into sequences of power-of-two lengths, the ids included."""
    common.configure(spark)
    return packing.pack(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", benchmark_items),
    ("packing", packed),
]

# SQL cannot express the classifier, the fingerprints or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is stored and read again."""
    docs = common.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
