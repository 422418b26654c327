"""The thin ``opN_`` queries: each applies its operator to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weft.llm import bpe_trie, fingerprint, langid, license, ngram_join, packing, quality, rules, sstable, substring
from weft.llm.common import ready
from weft.llm.oracles import ORACLES  # noqa: F401


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary())


def op3_multiset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_documents(table(spark, sf_dir, "documents"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op5_sstable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sstable.round_trip(table(spark, sf_dir, "documents"), vocabulary())


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_documents(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply_rules(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup_documents(table(spark, sf_dir, "documents"))


def op9_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_trie.encode_documents(table(spark, sf_dir, "documents"), vocabulary())


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan_licenses(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (op1_quality_gam, op2_packing, op3_multiset_fingerprint, op4_ngram_jaccard_join, op5_sstable, op6_language_id, op7_quality_rules, op8_substring_dedup, op9_bpe_trie, op10_license_scan)
}
