"""Encodings cut by time (X2): no order learns from itself or from a later one.

Ranked training rows fall into time blocks of equal size; all test rows are one
more block. A row is encoded from the totals of all rows minus those of its own
and later blocks, that is, from earlier blocks alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.exprs import attach_one_row

BLOCKS, SMOOTHING = 10, 20.0


def time_block(n_train: int, blocks: int = BLOCKS, rank: str = "rank") -> Column:
    """Block 0 to ``blocks - 1`` of a training row; ``blocks`` for every later row."""
    return F.least(F.floor(F.col(rank) * blocks / F.lit(max(n_train, 1))), F.lit(blocks)).cast("int")


def earlier_totals(rows: DataFrame, key: str, values: dict[str, Column], block: str = "block", blocks: int = BLOCKS) -> DataFrame:
    """(key, block, sums over earlier blocks) for every key and block.

    One row per (key, block) is summed first, with map-side combine, so the
    window sees at most ``blocks + 1`` rows a key, whatever its share of the rows.
    """
    sums = rows.where(F.col(key).isNotNull()).groupBy(key, block).agg(*[F.sum(v).alias(n) for n, v in values.items()])
    # a key needs its totals in blocks without rows of it too
    grid = sums.select(key).distinct().withColumn(block, F.explode(F.sequence(F.lit(0), F.lit(blocks))))
    before = Window.partitionBy(key).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    dense = grid.join(sums, [key, block], "left")
    return dense.select(key, block, *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in values])


def target_encoding(ranked: DataFrame, key: str, n_train: int, target: str = "is_late", smoothing: float = SMOOTHING,
                    blocks: int = BLOCKS, out: str | None = None) -> DataFrame:
    """``ranked`` with the smoothed target mean of its ``key`` over earlier blocks.

    ``(late + smoothing * rate) / (rows + smoothing)``, where ``rate`` is the
    mean of all earlier blocks. An unseen or null key gets that rate; the first
    block has no past and gets null. Test rows learn from all training rows, not
    from each other.
    """
    out = out or f"{key}_target_rate"
    rows = ranked.withColumn("_block", time_block(n_train, blocks))
    past = rows.where(F.col("_block") < blocks)
    totals = earlier_totals(past, key, {"_late": F.col(target), "_rows": F.lit(1)}, "_block", blocks)
    # one row a block
    overall = past.groupBy("_block").agg(F.sum(target).alias("_l"), F.count(F.lit(1)).alias("_n"))
    rates = overall.select(F.map_from_entries(F.collect_list(F.struct("_block", F.struct("_l", "_n")))).alias("_blocks"))
    joined = attach_one_row(rows.join(totals, [key, "_block"], "left"), rates)
    earlier = F.filter(F.map_entries("_blocks"), lambda e: e["key"] < F.col("_block"))
    total = lambda f: F.aggregate(earlier, F.lit(0).cast("long"), lambda acc, e: acc + e["value"][f])
    rate = F.when(total("_n") > 0, total("_l") / total("_n"))
    seen = F.coalesce(F.col("_rows"), F.lit(0))
    value = (F.coalesce(F.col("_late"), F.lit(0)) + F.lit(smoothing) * rate) / (seen + F.lit(smoothing))
    return joined.withColumn(out, value).select(*ranked.columns, out)


def log_volume(ranked: DataFrame, key: str, n_train: int, blocks: int = BLOCKS, out: str | None = None) -> DataFrame:
    """``ranked`` with log(1 + rows of its ``key`` in earlier blocks); 0 for an unseen key, null for a null one."""
    out = out or f"{key}_log_volume"
    rows = ranked.withColumn("_block", time_block(n_train, blocks))
    totals = earlier_totals(rows.where(F.col("_block") < blocks), key, {"_rows": F.lit(1)}, "_block", blocks)
    value = F.when(F.col(key).isNotNull(), F.log1p(F.coalesce(F.col("_rows"), F.lit(0)).cast("double")))
    return rows.join(totals, [key, "_block"], "left").withColumn(out, value).select(*ranked.columns, out)
