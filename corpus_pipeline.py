"""The corpus pipeline: five stages, each written as Parquet and read again by the next.

1. toxicity: documents that the classifier rejects go
2. SimHash near-dedup: of each group of near copies one document stays
3. suffix-array dedup: passages of 50 bytes or more that an earlier document has are cut
4. PII: personal data is replaced by its kind
5. packing: what is left becomes token sequences

Stages 1 to 4 return the columns of their input, extra ones included; a document whose
text was cut to nothing stays, with an empty text.  Null texts count as empty, and empty
texts are near copies of one another (fingerprint zero).  Rows that repeat a doc_id are
documents of their own; rows without one come after all others.  An empty table passes
through every stage; the last one then gives no row.  Texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eventmart.llm import packing, pii, simhash, suffix_dedup, toxicity
from eventmart.llm.common import read_table, written
from eventmart.llm.queries import vocabulary


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents with a score under 0.5; learns from the labels of its input's documents."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group: 3-word shingles, at most 3 differing bits."""
    return simhash.representatives(docs, shingle_words=3, radius=3)


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts the 50-byte strings that also start in a document with a smaller doc_id."""
    return suffix_dedup.without_repeats(docs, window=50)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; keeps every document."""
    return pii.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a sequence of at most 2048 tokens."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), length=2048, end_id=1)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("suffix_dedup", suffix_dedup_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: Hashing, learning and suffix arrays are beyond SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
