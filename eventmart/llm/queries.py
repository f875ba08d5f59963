"""Registered queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import collocations, contamination, filter_audit, language_id, neighbours, packing, pii, secret_scan, sentencepieces, simhash, sketches, suffix_dedup, toxicity
from .common import read_table, scratch
from .oracle import ORACLE_SQL  # noqa: F401


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file; it has the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.fit(docs))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(read_table(spark, sf_dir, "documents"))


def op4_approximate_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(read_table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0, k=20)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), length=2048, end_id=1)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), window=50)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(read_table(spark, sf_dir, "documents"), scratch(spark, "ledger"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.encode_documents(read_table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.compare_with_edits(read_table(spark, sf_dir, "documents"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle_words=3, radius=3)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read_table(spark, sf_dir, "documents"), longest=3, least=10, share=50, top=2000)


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), window=10)


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_language_id": op2_language_id,
    "op3_pii": op3_pii,
    "op4_approximate_neighbours": op4_approximate_neighbours,
    "op5_packing": op5_packing,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_secret_scan": op7_secret_scan,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_fingerprints": op9_fingerprints,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_filter_audit": op11_filter_audit,
    "op12_collocations": op12_collocations,
    "op13_decontamination": op13_decontamination,
}
