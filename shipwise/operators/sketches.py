"""Mergeable distinct counts (A7, A26, opt-in): stored HyperLogLog sketches, merged over any window.

Exact distinct counts are the library's default. A sketch is a few KB of bytes a
group that can be stored per day and merged later without reading the rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG2_SIZE = 12


def relative_error(log2_size: int = LOG2_SIZE) -> float:
    """Standard error of an estimate."""
    return 1.04 / 2 ** (log2_size / 2)


def sketch_by(df: DataFrame, keys: Sequence[str | Column], value: str, log2_size: int = LOG2_SIZE) -> DataFrame:
    """One sketch of the non-null values per group, in a column ``sketch``; partial sketches are merged map-side."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(F.col(value).cast("string"), F.lit(log2_size)).alias("sketch"))


def merge_sketches(sketches: DataFrame, keys: Sequence[str | Column], name: str = "distinct") -> DataFrame:
    """Distinct counts of coarser groups from stored sketches."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).cast("long").alias(name))
