"""Training rows of the classifiers: a bounded sample of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 5; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def training_rows(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, max_bytes: int) -> DataFrame:
    """(doc_id, text, label) of at most ``max_rows`` labelled rows outside the held-out fold.

    The rows are those of the smallest id hashes among labels that are 0 or 1,
    one per doc_id (the larger label if they differ). A text of over
    ``max_bytes`` is no training row; it is scored whole like any other.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & (fold(F.col("doc_id")) != 0))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )
    # At most max_rows narrow rows.
    rows = docs.filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= max_bytes)
    return rows.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).select("doc_id", "text", "label")


def scored(rows: DataFrame, threshold: float) -> DataFrame:
    """doc_id, held_out, score, predicted from rows (doc_id, score)."""
    return rows.select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
