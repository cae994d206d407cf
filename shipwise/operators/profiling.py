"""Raw-table profiling: grain, duplicates, dependencies, join cardinality,
missingness, category shares and the modelling funnel.

Each report is a small DataFrame built from one-row aggregates (``unionByName``
or ``unpivot``), never a driver loop over data rows. Every table is scanned
once per report; group-by-key counts use map-side partial aggregation, so a
hot key costs one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import attach_one_row, key_label, round_half_even, safe_ratio


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def key_grain(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """rows, declared key, uniqueness, duplicate rows on the key.

    Null key values count as equal (they group together), as in the reference.
    """
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_rows_on_key"),
    ).select(
        F.lit(table).alias("table"),
        "rows",
        F.lit(key_label(key)).alias("declared_key"),
        (F.col("duplicate_rows_on_key") == 0).alias("key_is_unique"),
        "duplicate_rows_on_key",
    )


def grain_report(tables: dict[str, DataFrame], keys: dict[str, Sequence[str]]) -> DataFrame:
    return _union([key_grain(tables[name], name, key) for name, key in keys.items()])


def row_fingerprint(columns: Sequence[str]) -> Column:
    """128 bits of a row: two 64-bit hashes, the second one over the null flags too."""
    cols = [F.col(f"`{c}`") for c in columns]
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cols])
    return F.struct(F.xxhash64(*cols).alias("a"), F.xxhash64(nulls, *reversed(cols)).alias("b"))


def exact_duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier identical row (A12): one-row ``count``.

    Fingerprints are counted first: 16 bytes a row are shuffled. Whole rows are
    grouped only where a fingerprint occurs twice, so equal fingerprints of
    different rows don't count.
    """
    marked = df.withColumn("_fp", row_fingerprint(df.columns))
    twice = marked.groupBy("_fp").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_fp")
    return (
        marked.join(twice, "_fp", "left_semi").groupBy(*[F.col(f"`{c}`") for c in df.columns])
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("count"))
    )


def dependency_violations(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one distinct non-null ``value`` (A13): one-row ``count``.

    Null keys form no group (the reference's group-by drops them).
    """
    per_key = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count_distinct(value).alias("_d"))
    return per_key.agg(F.count(F.when(F.col("_d") > 1, 1)).cast("long").alias("count"))


# Check labels of the consistency report.
DEPENDENCY_CHECKS = [
    ("orders with >1 customer_id", "order_id", "customer_id"),
    ("orders with >1 order_status", "order_id", "order_status"),
]
DUPLICATE_CHECK_TABLES = ["orders", "order_items", "order_payments"]


def consistency_report(orders: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Duplicate and functional-dependency checks as one report."""
    rows = [
        dependency_violations(orders, key, value).select(F.lit(label).alias("check"), "count")
        for label, key, value in DEPENDENCY_CHECKS
    ]
    for name in DUPLICATE_CHECK_TABLES:
        rows.append(
            exact_duplicate_count(tables[name]).select(F.lit(f"exact duplicate rows in {name}").alias("check"), "count")
        )
    return _union(rows)


def join_cardinality(
    left: DataFrame, right: DataFrame, on: str, left_name: str, right_name: str
) -> DataFrame:
    """Left rows, unmatched left rows, max and mean right rows per key.

    Unmatched rows come from a ``left_anti`` join against the right keys; null
    keys match each other as in the reference's merge. The per-key right
    counts drop null keys. An empty right side gives 0 for max and mean.
    """
    left_keys = left.select(on)
    right_keys = right.select(on)
    unmatched = left_keys.join(
        right_keys.distinct().withColumnRenamed(on, "_rk"), F.col(on).eqNullSafe(F.col("_rk")), "left_anti"
    ).agg(F.count(F.lit(1)).cast("long").alias("unmatched_left_rows"))
    left_rows = left_keys.agg(F.count(F.lit(1)).cast("long").alias("left_rows"))
    per_key = right_keys.where(F.col(on).isNotNull()).groupBy(on).agg(F.count(F.lit(1)).alias("_n"))
    right_stats = per_key.agg(
        F.coalesce(F.max("_n"), F.lit(0)).cast("long").alias("max_right_per_key"),
        F.coalesce(round_half_even(F.avg("_n"), 2), F.lit(0.0)).alias("mean_right_per_key"),
    )
    return (
        attach_one_row(attach_one_row(left_rows, unmatched), right_stats)
        .select(
            F.lit(f"{left_name} -> {right_name}").alias("join"),
            F.lit(on).alias("on"),
            "left_rows",
            "unmatched_left_rows",
            "max_right_per_key",
            "mean_right_per_key",
        )
    )


def join_report(tables: dict[str, DataFrame]) -> DataFrame:
    """The five joins of the order frame."""
    t = tables
    return _union(
        [
            join_cardinality(t["orders"], t["customers"], "customer_id", "orders", "customers"),
            join_cardinality(t["orders"], t["order_items"], "order_id", "orders", "order_items"),
            join_cardinality(t["orders"], t["order_payments"], "order_id", "orders", "order_payments"),
            join_cardinality(t["order_items"], t["products"], "product_id", "order_items", "products"),
            join_cardinality(t["order_items"], t["sellers"], "seller_id", "order_items", "sellers"),
        ]
    )


def unmatched_count(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Left rows with no right row on ``on`` (J7), one-row ``unmatched``."""
    return left.join(right.select(on), on, "left_anti").agg(F.count(F.lit(1)).cast("long").alias("unmatched"))


def missingness(df: DataFrame, table: str) -> DataFrame:
    """One row per column with nulls: missing count and percent, rounded 2.

    One aggregate pass computes every column's null count, then ``unpivot``.
    """
    cols = df.columns
    one = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count(F.when(F.col(f"`{c}`").isNull(), 1)).cast("long").alias(c) for c in cols],
    )
    long = one.unpivot("_total", cols, "column", "missing")
    return long.where(F.col("missing") > 0).select(
        F.lit(table).alias("table"),
        "column",
        "missing",
        round_half_even(F.col("missing") / F.col("_total") * 100, 2).alias("missing_pct"),
    )


def missingness_report(tables: dict[str, DataFrame]) -> DataFrame:
    """All tables' missingness rows, sorted by table, then percent descending (T5)."""
    report = _union([missingness(df, name) for name, df in tables.items()])
    return report.orderBy(F.asc("table"), F.desc_nulls_last("missing_pct"), F.asc("column"))


def value_shares(df: DataFrame, col: str, count_name: str = "n_orders") -> DataFrame:
    """Counts per value with null as its own row, and percent of all rows."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias(count_name))
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    return attach_one_row(counts, total).select(
        col, count_name, round_half_even(safe_ratio(count_name, "_total") * 100, 2).alias("share_pct")
    )


# Funnel stage labels.
FUNNEL_STAGES = [
    "1. all raw orders",
    "2. status == delivered",
    "3. + has delivered_customer_date",
    "4. + has estimated_delivery_date",
    "5. + has purchase_timestamp",
]


def funnel(orders: DataFrame) -> DataFrame:
    """Cumulative gates to the modelling subset in one scan."""
    gates = [
        F.lit(True),
        F.col("order_status") == "delivered",
        F.col("order_delivered_customer_date").isNotNull(),
        F.col("order_estimated_delivery_date").isNotNull(),
        F.col("order_purchase_timestamp").isNotNull(),
    ]
    sums = []
    cond = None
    for i, gate in enumerate(gates):
        cond = gate if cond is None else (cond & gate)
        sums.append(F.count(F.when(F.coalesce(cond, F.lit(False)), 1)).cast("long").alias(f"s{i}"))
    one = orders.agg(*sums)
    stack_args = ", ".join(f"'{label}', s{i}" for i, label in enumerate(FUNNEL_STAGES))
    long = one.selectExpr("s0 AS _raw", f"stack({len(FUNNEL_STAGES)}, {stack_args}) AS (stage, n_orders)")
    return long.select(
        "stage", "n_orders", round_half_even(safe_ratio("n_orders", "_raw") * 100, 2).alias("share_of_raw_pct")
    )
