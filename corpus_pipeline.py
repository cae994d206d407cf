"""Corpus pipeline: rules, classifier, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
it as Parquet in the shared folder and reads it back as the next stage's docs.
Every stage but the last returns the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shipwise.llm.common import discard, read_table, store
from shipwise.llm.packing import pack
from shipwise.llm.quality_model import keep_scored
from shipwise.llm.quality_rules import keep_quality
from shipwise.llm.queries import bpe_path
from shipwise.llm.simhash import keep_one_per_component
from shipwise.llm.substring import remove_repeats


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the threshold table keeps. Null and empty texts go."""
    return keep_quality(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of 0.3 or more.

    The score is learned from all labelled documents of ``sf_dir``, also those
    the rules rejected. Null ids and texts, and repeated rows, are scored like any
    other row; without both labels all stay.
    """
    documents, labels = (read_table(spark, sf_dir, name) for name in ("documents", "labels"))
    return keep_scored(docs, labels, threshold=0.3, labelled=documents)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of the smallest doc_id.

    Documents without words are near-duplicates of each other. Rows of one id and
    text stay once, rows with a null id once for each text.
    """
    return keep_one_per_component(docs, n_words=4, radius=4)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 13-word windows that a document of a smaller doc_id holds.

    All rows stay, null texts as null. Rows with a null id neither remove nor lose
    words, and rows of one doc_id don't remove each other's.
    """
    return remove_repeats(docs, window=13)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens in sequences of 1024, as the packing query returns them.

    A null or empty text is its end token alone; repeated rows are packed each.
    """
    return pack(docs, bpe_path(), size=1024, end_id=0)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]

# Scores, XXH64 fingerprints and token ids are beyond SQL; the tests hold the
# pipeline against brute-force stages instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), "pipeline")
        if before is not None:
            discard(before)
        before = docs
    return docs
