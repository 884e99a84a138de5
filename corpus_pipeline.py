"""The corpus pipeline: each stage reads what the one before has written and calls one operator of ``atomweft.llm``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atomweft.llm import decontamination, mixing, quality, simhash, suffix_dedup
from atomweft.llm.common import checkpoint_dir, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Bytes of a repeated passage that is cut: fifty short words.
PASSAGE_BYTES = 200


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the limits of their language and source."""
    return quality.keep_good(docs).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingle sets of similarity 0.8 or more."""
    return simhash.drop_near_duplicates(docs, similarity=0.8).select(COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that also occur elsewhere; documents of which no word is left go. n_chars follows the text."""
    found = suffix_dedup.remove_repeats(docs, length=PASSAGE_BYTES)
    found = found.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return found.where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"), remove="documents").select(COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in the mixture of the sources."""
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("decontamination", decontaminated),
    ("mixing", mixed),
]

#: The near-duplicate stage and the schedule are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared folder and reread by the next."""
    docs = table(spark, sf_dir, "documents")
    base = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{k}-{name}")
        docs = spark.read.parquet(f"{base}/{k}-{name}")
    return docs
