"""Rate-by-group, lift, buckets, corridors, pivots and dispersion on the model dataset.

Every operator is a lazy aggregate. Group keys are low-cardinality (states,
buckets, months), so map-side partial aggregation keeps the shuffles small even
when one group holds a third of the rows. Scalars like the base rate stay in
the plan as a one-row aggregate joined on a constant key. A global aggregate
always returns exactly one row, so broadcasting it is bounded by construction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions.exprs import round_half_even
from .quantiles import percentile_columns

TARGET = "is_late"


def rate_by(
    df: DataFrame,
    keys: str | Sequence[str],
    target: str = TARGET,
    drop_null_keys: bool = True,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """``orders`` (row count) and ``late_rate`` (mean target) per group.

    The reference's notebooks drop null group keys; ``drop_null_keys=False`` keeps them.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if drop_null_keys:
        df = df.dropna(subset=keys)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("orders"), F.avg(target).alias("late_rate"), *extra
    )


def base_rate(df: DataFrame, target: str = TARGET, name: str = "base_rate") -> DataFrame:
    """One-row global rate (A10)."""
    return df.agg(F.avg(target).alias(name))


def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row."""
    return X.attach_one_row(df, one_row)


def with_lift(
    groups: DataFrame, dataset: DataFrame, target: str = TARGET, digits: int | None = 2, rate: str = "late_rate"
) -> DataFrame:
    """``lift_vs_base = late_rate / base rate`` (F20), rounded half-even when ``digits`` is set."""
    return _lift(with_scalar(groups, base_rate(dataset, target, "_base_rate")), rate, digits)


def _lift(df: DataFrame, rate: str, digits: int | None) -> DataFrame:
    lift = X.safe_ratio(rate, "_base_rate")  # null, not an ANSI error, when nothing is late
    if digits is not None:
        lift = round_half_even(lift, digits)
    return df.withColumn("lift_vs_base", lift).drop("_base_rate")


def rate_and_lift(
    df: DataFrame, keys: str | Sequence[str], target: str = TARGET, digits: int | None = 2
) -> DataFrame:
    """``rate_by`` with ``lift_vs_base`` against the rate of all rows, those of null keys included.

    Rows are grouped once: the base rate sums the groups, null keys too,
    before they are dropped.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    sums = [F.count(target).alias("_n"), F.sum(target).alias("_hits")]
    groups = rate_by(df, keys, target, drop_null_keys=False, extra=sums)
    base = groups.agg((F.sum("_hits") / F.sum("_n")).alias("_base_rate"))
    return _lift(with_scalar(groups.dropna(subset=keys), base), "late_rate", digits).drop("_n", "_hits")


def min_volume(df: DataFrame, threshold: int, col: str = "orders") -> DataFrame:
    """HAVING-style volume filter, inclusive."""
    return df.where(F.col(col) >= threshold)


def top_k_values(df: DataFrame, key: str, k: int, drop_null: bool = True) -> DataFrame:
    """The k most frequent values of ``key``, ties by key (T1). Bounded to k rows."""
    if drop_null:
        df = df.where(F.col(key).isNotNull())
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(key)).limit(k)


def restrict_to(df: DataFrame, key: str, values: DataFrame) -> DataFrame:
    """Membership filter against a computed list (P7) as a semi join."""
    return df.join(values.select(key), key, "left_semi")


def late_rate_top_values(dataset: DataFrame, key: str = "customer_state", k: int = 10) -> DataFrame:
    """Late rate of the k most common values of ``key`` (minimum slice)."""
    top = top_k_values(dataset, key, k)
    return rate_by(restrict_to(dataset, key, top), key)


def top_by(df: DataFrame, col: str, k: int, ascending: bool, keys: Sequence[str]) -> DataFrame:
    """Riskiest / safest groups (T2): order by rate then keys, keep k."""
    order = F.asc_nulls_last(col) if ascending else F.desc_nulls_last(col)
    return df.orderBy(order, *[F.asc(k_) for k_ in keys]).limit(k)


# ----------------------------------------------------------------- time views


def with_time_labels(dataset: DataFrame, ts: str = "order_purchase_timestamp") -> DataFrame:
    return dataset.where(F.col(ts).isNotNull()).withColumns(
        {
            "year_month": X.year_month(ts),
            "iso_year_week": X.iso_year_week(ts),
            "weekday": X.weekday_name(ts),
            "weekday_index": X.weekday_mon0(ts),
            "hour": F.hour(ts),
        }
    )


def weekday_rates(spark: SparkSession, dataset: DataFrame) -> DataFrame:
    """Rate by weekday over the complete Monday-first domain (J8); empty days stay null."""
    domain = spark.createDataFrame(
        [(i, name) for i, name in enumerate(X.WEEKDAY_ORDER)], "weekday_index int, weekday string"
    )
    rates = rate_by(with_time_labels(dataset), "weekday")
    return domain.join(rates, "weekday", "left").select("weekday_index", "weekday", "orders", "late_rate")


def window_quantiles(dataset: DataFrame, key: str, value: str = "estimated_delivery_days") -> DataFrame:
    """Exact (interpolated) p25 / median / p75 per group (A9), distributed (see ``quantiles``)."""
    counts = dataset.groupBy(key).agg(F.count(F.lit(1)).alias("orders"))
    q = percentile_columns(dataset, value, {"median_window": 0.5, "p25": 0.25, "p75": 0.75}, [key])
    return counts.join(q, key, "left").select(key, "orders", "median_window", "p25", "p75")


def box_stats(dataset: DataFrame, value: str, by: str = TARGET) -> DataFrame:
    """Box-plot numbers per class (A20): quartiles, 1.5 IQR whiskers, outlier count.

    Exact quartiles per class, then whiskers and outliers. The bounds of the
    classes (a handful) reach the rows as one map, so no row is shuffled by
    its class. Rows of a null class are left out.
    """
    rows = dataset.where(F.col(value).isNotNull() & F.col(by).isNotNull())
    counts = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    quart = (
        counts.join(percentile_columns(rows, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, [by]), by)
        .withColumn("_lo", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")))
        .withColumn("_hi", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    )
    v = F.col(value)
    inside = (v >= F.col("_lo")) & (v <= F.col("_hi"))
    bounds = quart.select(F.map_from_entries(F.collect_list(F.struct(F.col(by), F.struct("_lo", "_hi")))).alias("_bounds"))
    stats = (
        X.attach_one_row(rows.select(by, value), bounds)
        .withColumn("_class", F.element_at("_bounds", F.col(by)))
        .withColumns({c: F.col("_class").getField(c) for c in ("_lo", "_hi")})
        .groupBy(by)
        .agg(
            F.min(F.when(inside, v)).alias("whisker_low"),
            F.max(F.when(inside, v)).alias("whisker_high"),
            F.sum(F.when(~inside, 1).otherwise(0)).cast("long").alias("outliers"),
        )
    )
    return quart.drop("_lo", "_hi").join(stats, by)


# ----------------------------------------------------------------- corridors

CORRIDOR_KEYS = ["primary_seller_state", "customer_state"]


def corridor_stats(dataset: DataFrame, keys: Sequence[str] = CORRIDOR_KEYS) -> DataFrame:
    """Orders and late rate per (seller state, customer state) plus a same-state flag."""
    a, b = keys
    return rate_by(dataset, list(keys)).withColumn("is_same_state", F.col(a) == F.col(b))


def corridor_lift(dataset: DataFrame, keys: Sequence[str] = CORRIDOR_KEYS) -> DataFrame:
    """``corridor_stats`` with the unrounded lift against all rows, in one grouping."""
    a, b = keys
    return rate_and_lift(dataset, list(keys), digits=None).withColumn("is_same_state", F.col(a) == F.col(b))


def corridor_axis_top(corridors: DataFrame, axis: str, k: int) -> DataFrame:
    """Top-k members of one axis by summed volume."""
    return (
        corridors.groupBy(axis)
        .agg(F.sum("orders").alias("axis_orders"))
        .orderBy(F.desc("axis_orders"), F.asc(axis))
        .limit(k)
    )


def corridor_pivot(
    corridors: DataFrame,
    value: str,
    row_values: DataFrame,
    col_values: Sequence[str],
    keys: Sequence[str] = CORRIDOR_KEYS,
    min_orders: int | None = None,
    fill: float | None = None,
) -> DataFrame:
    """Seller state x customer state matrix of ``value``.

    Rows are restricted to ``row_values`` with a semi join, columns to the
    given list (passing it avoids the extra distinct job). Cells under
    ``min_orders`` are masked to null before the pivot; ``fill`` fills
    missing cells (0 for counts).
    """
    a, b = keys
    cell = F.col(value)
    if min_orders is not None:
        cell = F.when(F.col("orders") >= min_orders, cell)
    src = restrict_to(corridors, a, row_values).where(F.col(b).isin(list(col_values)))
    pivoted = src.withColumn("_cell", cell).groupBy(a).pivot(b, list(col_values)).agg(F.first("_cell"))
    if fill is not None:
        pivoted = pivoted.fillna(fill, subset=list(col_values))
    return pivoted


def weighted_dispersion(df: DataFrame, rate: str = "late_rate", weight: str = "orders") -> DataFrame:
    """Min, max, weighted mean and population weighted std of group rates."""
    stats = df.agg(
        F.min(rate).alias("min_rate"),
        F.max(rate).alias("max_rate"),
        (F.sum(F.col(rate) * F.col(weight)) / F.sum(weight)).alias("weighted_mean"),
        F.sum(weight).alias("_w"),
    )
    dev = F.col(rate) - F.col("weighted_mean")
    spread = (
        X.attach_one_row(df, stats.select("weighted_mean", "_w"))
        .agg((F.sum(dev * dev * F.col(weight)) / F.first("_w")).alias("_var"))
    )
    return X.attach_one_row(stats.drop("_w"), spread).select(
        "min_rate", "max_rate", "weighted_mean", F.sqrt("_var").alias("weighted_std")
    )


# ----------------------------------------------------------------- cohorts


def primary_values(order_items: DataFrame, value: str, alias: str) -> DataFrame:
    """Per order, the most frequent non-null ``value`` among its items."""
    return order_items.groupBy("order_id").agg(F.mode(value, deterministic=True).alias(alias))


def seller_volumes(order_items: DataFrame) -> DataFrame:
    """Distinct orders per seller over all items."""
    return order_items.groupBy("seller_id").agg(F.count_distinct("order_id").alias("seller_orders"))


# Cohort bucket edges and labels.
SELLER_VOLUME_EDGES = [0, 10, 50, 200, 1000]
SELLER_VOLUME_LABELS = ["1-10", "11-50", "51-200", "201-1000", "1000+"]
ITEM_COUNT_EDGES = [0, 1, 2, 4, 99]
ITEM_COUNT_LABELS = ["1", "2", "3-4", "5+"]
WEIGHT_QUANTILES = [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]
WEIGHT_LABELS = ["q1 (lightest)", "q2", "q3", "q4", "q5 (heaviest)"]
DELIVERY_WINDOW_EDGES = [0.0, 10.0, 20.0, 30.0, float("inf")]
DELIVERY_WINDOW_LABELS = ["0-10d", "10-20d", "20-30d", "30d+"]


def seller_volume_frame(dataset: DataFrame, order_items: DataFrame) -> DataFrame:
    """Dataset rows with their primary seller and its order volume."""
    primary = primary_values(order_items, "seller_id", "primary_seller_id")
    vol = seller_volumes(order_items)
    primary = primary.join(vol, primary.primary_seller_id == vol.seller_id, "left").drop("seller_id")
    return dataset.join(primary, "order_id", "left")


def with_seller_volume_bucket(cohort: DataFrame) -> DataFrame:
    """Volume bucket (F16); the top edge is data dependent: max(1001, max volume + 1)."""
    cohort = X.attach_one_row(cohort, cohort.agg(F.greatest(F.lit(1001), F.max("seller_orders") + 1).alias("_top")))
    edges = [*SELLER_VOLUME_EDGES, F.col("_top")]
    return cohort.withColumn(
        "seller_volume_bucket", X.bucket_right_closed("seller_orders", edges, SELLER_VOLUME_LABELS)
    ).drop("_top")


def seller_volume_cohort_frame(dataset: DataFrame, order_items: DataFrame) -> DataFrame:
    """Dataset with primary seller, its volume and the volume bucket."""
    return with_seller_volume_bucket(seller_volume_frame(dataset, order_items))


def bucket_cohort(df: DataFrame, bucket: str, labels: Sequence[str], extra: Sequence[Column] = ()) -> DataFrame:
    """Rate per bucket, only buckets with rows, with the bucket ordinal."""
    return rate_by(df, bucket, extra=extra).withColumn("bucket_index", bucket_index(bucket, labels))


def bucket_index(bucket: str, labels: Sequence[str]) -> Column:
    """Ordinal of a bucket label."""
    return F.array_position(F.array(*[F.lit(x) for x in labels]), F.col(bucket)).cast("int") - 1


def bucket_lift(df: DataFrame, bucket: str, labels: Sequence[str]) -> DataFrame:
    """``bucket_cohort`` with the lift against all rows of ``df``, in one grouping."""
    return rate_and_lift(df, bucket).withColumn("bucket_index", bucket_index(bucket, labels))


def quantile_edges(df: DataFrame, value: str, qs: Sequence[float]) -> DataFrame:
    """Exact interpolated quantile edges as a one-row array column."""
    named = {f"_e{i}": q for i, q in enumerate(qs)}
    one = percentile_columns(df, value, named)
    return one.select(F.array(*[F.col(n) for n in named]).alias("_edges"))


def quantile_bucket(df: DataFrame, value: str, qs: Sequence[float], labels: Sequence[str], out: str) -> DataFrame:
    """Quantile bins, right-closed with the lowest edge included.

    Duplicate edges collapse: a value goes to the first bin whose upper edge
    is >= value, and bins whose lower edge equals their upper edge get no rows.
    """
    edges = quantile_edges(df, value, qs)
    v = F.col(value)
    e = F.col("_edges")
    expr = None
    for i, label in enumerate(labels):
        lo, hi = e[i], e[i + 1]
        lower = (v >= lo) if i == 0 else (v > lo)
        cond = lower & (v <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return X.attach_one_row(df, edges).withColumn(out, expr).drop("_edges")


def cohort_tables(df: DataFrame, buckets: dict[str, Column], target: str = TARGET) -> DataFrame:
    """Rates of all cohorts in one pass: (cohort, bucket, orders, late_rate, lift_vs_base).

    Each row names its bucket in every cohort; one grouping covers them all, so
    ``df`` is read once, and partial sums are combined before the shuffle. A null
    bucket counts in the base rate only.
    """
    names = F.array(*[F.struct(F.lit(n).alias("cohort"), b.cast("string").alias("bucket")) for n, b in buckets.items()])
    base = F.struct(F.lit(None).cast("string").alias("cohort"), F.lit(None).cast("string").alias("bucket"))
    named = F.concat(F.array(base), F.filter(names, lambda c: c["bucket"].isNotNull()))
    sums = (
        df.select(F.explode(named).alias("c"), F.col(target).alias("_y"))
        .groupBy("c.cohort", "c.bucket").agg(F.count(F.lit(1)).alias("orders"), F.sum("_y").alias("_late"))
    )
    total = sums.where(F.col("cohort").isNull()).select((F.col("_late") / F.col("orders")).alias("_base"))
    rates = X.attach_one_row(sums.where(F.col("cohort").isNotNull()), total)
    rate = F.col("_late") / F.col("orders")
    return rates.select("cohort", "bucket", "orders", rate.alias("late_rate"), X.round_half_even(rate / F.col("_base"), 2).alias("lift_vs_base"))
