"""Report sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import round_half_even

REPORT_NAMES = ["training_summary", "feature_importance", "error_analysis", "tuning_summary", "calibration_summary"]


def write_report(df: DataFrame, path: str) -> str:
    """Small report to one CSV file with a header (reports are tens of rows,
    so a single partition is safe here only)."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def write_frame(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Large frames go to parquet, optionally partitioned (e.g. by purchase month)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def save_reports(out_dir: str, reports: dict[str, DataFrame | None]) -> list[str]:
    """Write each non-empty report; the first (training summary) is always written."""
    written = []
    for i, name in enumerate(REPORT_NAMES):
        df = reports.get(name)
        if df is None:
            continue
        if i > 0 and df.isEmpty():
            continue
        written.append(write_report(df, f"{out_dir.rstrip('/')}/{name}"))
    return written


def top_rows(df: DataFrame, n: int = 10, digits: int = 4) -> DataFrame:
    """Console view: first ``n`` rows with doubles rounded."""
    cols = [
        round_half_even(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols).limit(n)


# Tables keyed by order: bucketing all three on order_id co-locates the order
# frame's aggregates and joins.
ORDER_KEYED_TABLES = ["orders", "order_items", "order_payments"]


def stage_bucketed(spark, tables: dict[str, DataFrame], database: str = "shipwise_stage", buckets: int = 64,
                   key: str = "order_id") -> dict[str, DataFrame]:
    """Write the order-keyed tables as catalog tables bucketed and sorted by ``key``.

    Reading them back, Spark knows they are hash-partitioned by ``key`` into
    ``buckets`` parts. The per-order aggregates and the joins to orders then
    need no exchange on these tables, as long as the dimensions they meet
    are broadcast. Tables are written once (for example by an ingestion job)
    and reused by every run. On a cluster the catalog's warehouse is shared
    storage. Size ``buckets`` like shuffle partitions (a few hundred MB each).
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    out = dict(tables)
    for name in ORDER_KEYED_TABLES:
        (
            tables[name].write.mode("overwrite").format("parquet")
            .bucketBy(buckets, key).sortBy(key)
            .saveAsTable(f"{database}.{name}")
        )
        out[name] = spark.table(f"{database}.{name}")
    return out
