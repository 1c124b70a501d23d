"""Corpus pipeline: stages from raw documents to packed training sequences.

Every stage works on all documents that the one before kept; all but the last return the columns
of `documents`. Null and empty texts pass each filter that finds nothing in them. Rows that repeat
an id are judged one by one, except that near-duplicate removal keeps a single row of a repeated
document. An empty table gives no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from signals.llm import decontaminate, ngram_join, quality, secrets
from signals.llm.common import staged, table
from signals.llm.packing import pack
from signals.llm.tokens import vocabulary_path

#: Near duplicates: shingles of five words, similarity of 0.8 or more.
NEAR = ngram_join.Rule(k=5, num=80, den=100)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of linked documents."""
    return ngram_join.keep_one(docs, NEAR)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of any benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live-looking secrets masked in their texts."""
    return secrets.mask_live(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the token sequences of all documents."""
    return pack(docs, vocabulary_path())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("packing", packing),
]
#: A fitted classifier and token ids are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    name, last = STAGES[-1]
    return staged(last(spark, docs, sf_dir), f"pipeline-{name}")
