"""Gradient histograms over all rows (M8): gains of every split from one aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .trees import split_gain


def bin_of(value: Column, cuts: Sequence[float]) -> Column:
    """Cut points below the value; null for a null."""
    return sum((F.when(value > c, 1).otherwise(0) for c in cuts), F.lit(0)).cast("long")


def split_gains(rows: DataFrame, leaf: str, cuts: dict[str, Sequence[float]], grad: str, hess: str, l2: float) -> DataFrame:
    """(leaf, feature, bin, n_left, gain) of each split "up to bin" that leaves rows on both sides.

    One grouping by (leaf, feature, bin) with map-side partial sums; the running
    sums see at most one row a bin. Nulls of a feature count in no bin.
    """
    cells = F.array(*[
        F.when(F.col(f).isNotNull(), F.struct(F.lit(f).alias("feature"), bin_of(F.col(f).cast("double"), c).alias("bin")))
        for f, c in cuts.items()
    ])
    sums = (
        rows.select(leaf, F.col(grad).alias("_g"), F.col(hess).alias("_h"), F.explode(F.filter(cells, lambda x: x.isNotNull())).alias("c"))
        .groupBy(leaf, "c.feature", "c.bin").agg(F.sum("_g").alias("_g"), F.sum("_h").alias("_h"), F.count(F.lit(1)).alias("_n"))
    )
    whole = Window.partitionBy(leaf, "feature")
    left = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    out = sums.select(
        leaf, "feature", "bin", *[F.sum(c).over(left).alias(f"{c}l") for c in ("_g", "_h", "_n")], *[F.sum(c).over(whole).alias(f"{c}t") for c in ("_g", "_h", "_n")]
    )
    gain = split_gain(F.col("_gl"), F.col("_hl"), F.col("_gt"), F.col("_ht"), l2)
    return out.where("_nl < _nt").select(leaf, "feature", "bin", F.col("_nl").alias("n_left"), gain.alias("gain"))
