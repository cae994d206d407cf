"""Contiguous shards of near equal bytes from global byte prefix sums.

Documents in id order are cut at equal byte targets. Running totals come from
per-partition totals: one range partitioning of narrow rows, a total per
partition, a prefix over these totals, and a running sum within each
partition. All of it is DataFrame work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import narrow, scalar_row, store

ROWS_PER_RANGE = 200_000


def shard_by_bytes(
    docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the text's UTF-8 bytes plus 1. A document goes to the shard
    that holds its byte midpoint, so a shard misses its target by at most half
    a document at either end. ``slot`` counts 0, 1, ... in a shard in id order.

    Null text counts as empty (size 1, crc32 0). Null ids come first. Rows
    with equal ids are ordered by crc32, size, then position in the table;
    the row order is total, so a hot id splits over ranges like any other.
    An empty table gives no rows. Extra columns are not read.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    rows = store(
        narrow(docs, id_col, text_col).select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
            F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    seen = scalar_row(rows, n=F.count(F.lit(1)), size=F.sum("size"))
    n, total = seen["n"], seen["size"] or 1
    n_ranges = max(1, -(-n // rows_per_range))
    order = ["doc_id", "text_crc32", "size", "row"]
    # Stored, so that the range of a row is fixed before it is read twice.
    ranged = store(rows.repartitionByRange(n_ranges, *order).withColumn("part", F.spark_partition_id()))

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
        .select(
            "part",
            F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        )
    )
    inside = Window.partitionBy("part").orderBy(*order)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.col("bytes_before") + F.sum("size").over(running) - F.col("size")
    # One row per range: at most the number of ranges chosen above.
    placed = store(
        ranged.join(F.broadcast(offsets), "part").select(
            "doc_id", "size", "text_crc32",
            F.expr("rows_before").alias("rows_before"),
            F.row_number().over(inside).alias("at"),
            start.alias("start"),
        ).select(
            "doc_id", "size", "text_crc32",
            (F.col("rows_before") + F.col("at") - 1).alias("position"),
            # Decimal: twice the bytes times the shards may pass a long.
            F.least(
                F.floor(
                    (F.col("start").cast("decimal(28,0)") * 2 + F.col("size")) * F.lit(n_shards)
                    / F.lit(2 * total).cast("decimal(28,0)")
                ).cast("int"),
                F.lit(n_shards - 1),
            ).alias("shard"),
        )
    )
    first = placed.groupBy("shard").agg(F.min("position").alias("first_position"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("position") - F.col("first_position")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
