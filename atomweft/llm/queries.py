"""The registered queries of this subpackage: thin calls of the operators with production parameters, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atomweft.llm import collocations, decontamination, fill_in_middle, language_id, lm_scoring, mixing, quality, simhash, sql, suffix_dedup, token_files, toxicity, url_rules, warc
from atomweft.llm.common import checkpoint_dir, cut, table

#: host, path, verdict
URL_RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), folds=5, fold=0)


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), rules)


def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archives(table(spark, sf_dir, "pages"), path, least_bytes=0)
    return warc.resolve(cut(warc.read_archives(spark, path))).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("f0")), 16, "0").alias("fingerprint"), "component_id")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.summarise(decontamination.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=400, with_text=False)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"), folds=7, fold=2)


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = f"{checkpoint_dir(spark)}/ids-{uuid.uuid4().hex}"
    token_files.write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_files.placed(token_files.read_ids(spark, path)).select("doc_id", "start", "n_tokens", "ids_crc32")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    restored = fill_in_middle.restore(F.col("output"), F.col("form"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_url_rules": op2_url_rules,
        "op3_warc_revisits": op3_warc_revisits,
        "op4_language_id": op4_language_id,
        "op5_simhash": op5_simhash,
        "op6_decontamination": op6_decontamination,
        "op7_quality_rules": op7_quality_rules,
        "op8_pfair_mixing": op8_pfair_mixing,
        "op9_suffix_dedup": op9_suffix_dedup,
        "op10_lm_scoring": op10_lm_scoring,
        "op11_token_files": op11_token_files,
        "op12_fill_in_middle": op12_fill_in_middle,
        "op13_collocations": op13_collocations,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_url_rules": sql.URL_RULES,
        "op3_warc_revisits": sql.WARC,
        "op6_decontamination": sql.DECONTAMINATION,
        "op7_quality_rules": sql.QUALITY,
        "op12_fill_in_middle": sql.FILL_IN_MIDDLE,
        "op13_collocations": sql.COLLOCATIONS,
    }
