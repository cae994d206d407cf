"""Order-level frame: one row per order with item, payment, product and seller aggregates.

Plan shape (what ``explain`` shows):

* items are left-joined to products and sellers. There is no broadcast hint, so
  Spark broadcasts them only when their measured size is under the broadcast
  threshold, at plan time from file statistics or at run time under AQE.
  Beyond that a shuffled join is used, and AQE splits skewed item partitions.
* one ``groupBy('order_id')`` computes the item, product and seller aggregates
  together, so items are shuffled once for the whole frame.
* payments get their own ``groupBy('order_id')``.
* customers join the narrow order rows first; the aggregates arrive
  hash-partitioned by ``order_id`` and join without another exchange on
  their side, so the wide frame is never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import all_null, product3, to_number
from ..sources.contracts import require_tables

# Raw product measures (column spelling as in the source data).
PRODUCT_MEASURES = [
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
    "product_photos_qty",
    "product_name_lenght",
    "product_description_lenght",
]

ITEM_AGG_COLUMNS = ["item_count", "total_price", "total_freight_value", "unique_sellers"]
PAYMENT_AGG_COLUMNS = ["payment_value", "payment_installments_max", "payment_type_mode", "payment_type_count"]
PRODUCT_AGG_COLUMNS = [
    "avg_product_weight_g",
    "avg_product_volume_cm3",
    "avg_product_photos_qty",
    "avg_product_name_length",
    "avg_product_description_length",
    "missing_product_metadata_share",
]
SELLER_AGG_COLUMNS = ["seller_state_nunique", "primary_seller_state"]


def sum_or_zero(col: str | Column) -> Column:
    """Sum where a group with only nulls gives 0.0 (pandas rule), not null."""
    return F.coalesce(F.sum(col), F.lit(0.0))


def mode_or_unknown(col: str | Column) -> Column:
    """Most frequent non-null value, ties to the smallest, 'unknown' if all null (A5)."""
    return F.coalesce(F.mode(col, deterministic=True).cast("string"), F.lit("unknown"))


def mode_or_null(col: str | Column) -> Column:
    """Most frequent non-null value, ties to the smallest, else null."""
    return F.mode(col, deterministic=True)


def distinct_small(col: str | Column) -> Column:
    """Distinct non-null count whose per-group set is bounded (states, payment
    types, sellers of one order).

    ``size(collect_set)`` keeps the aggregate in one shuffle with map-side
    partial sets; a set never exceeds the value domain.
    """
    return F.size(F.collect_set(col)).cast("long")


def item_aggregate_exprs() -> list[Column]:
    return [
        F.count("order_item_id").alias("item_count"),
        sum_or_zero("price").alias("total_price"),
        sum_or_zero("freight_value").alias("total_freight_value"),
        # the set per order is bounded by the order's items and by the seller
        # dimension; a count_distinct here would add a second full shuffle of items
        distinct_small("seller_id").alias("unique_sellers"),
    ]


def product_aggregate_exprs() -> list[Column]:
    return [
        F.avg("product_weight_g").alias("avg_product_weight_g"),
        F.avg("product_volume_cm3").alias("avg_product_volume_cm3"),
        F.avg("product_photos_qty").alias("avg_product_photos_qty"),
        F.avg("product_name_lenght").alias("avg_product_name_length"),
        F.avg("product_description_lenght").alias("avg_product_description_length"),
        F.avg("missing_product_metadata").alias("missing_product_metadata_share"),
    ]


def seller_aggregate_exprs() -> list[Column]:
    return [
        distinct_small("seller_state").alias("seller_state_nunique"),
        mode_or_unknown("seller_state").alias("primary_seller_state"),
    ]


def enrich_items(order_items: DataFrame, products: DataFrame, sellers: DataFrame) -> DataFrame:
    """Items with numeric product measures, volume, metadata flag and seller state."""
    prod = products.select(
        "product_id", *[to_number(c).alias(c) for c in PRODUCT_MEASURES]
    )
    sell = sellers.select("seller_id", "seller_state")
    items = order_items.select("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value")
    return (
        items.join(prod, "product_id", "left")
        .join(sell, "seller_id", "left")
        .withColumn(
            "product_volume_cm3", product3("product_length_cm", "product_height_cm", "product_width_cm")
        )
        .withColumn("missing_product_metadata", all_null(PRODUCT_MEASURES))
    )


def item_aggregates(order_items: DataFrame) -> DataFrame:
    """A1 alone: item count, totals, distinct sellers per order."""
    return order_items.groupBy("order_id").agg(*item_aggregate_exprs())


def payment_aggregates(order_payments: DataFrame) -> DataFrame:
    """A2: payment totals, max installments, mode type, distinct types per order."""
    return order_payments.groupBy("order_id").agg(
        sum_or_zero("payment_value").alias("payment_value"),
        F.max("payment_installments").alias("payment_installments_max"),
        mode_or_unknown("payment_type").alias("payment_type_mode"),
        distinct_small("payment_type").alias("payment_type_count"),
    )


def product_aggregates(order_items: DataFrame, products: DataFrame) -> DataFrame:
    """A3 alone: product measure means and missing-metadata share per order."""
    prod = products.select("product_id", *[to_number(c).alias(c) for c in PRODUCT_MEASURES])
    enriched = (
        order_items.select("order_id", "product_id")
        .join(prod, "product_id", "left")
        .withColumn("product_volume_cm3", product3("product_length_cm", "product_height_cm", "product_width_cm"))
        .withColumn("missing_product_metadata", all_null(PRODUCT_MEASURES))
    )
    return enriched.groupBy("order_id").agg(*product_aggregate_exprs())


def seller_aggregates(order_items: DataFrame, sellers: DataFrame) -> DataFrame:
    """A4 alone: distinct seller states and primary seller state per order."""
    enriched = order_items.select("order_id", "seller_id").join(
        sellers.select("seller_id", "seller_state"), "seller_id", "left"
    )
    return enriched.groupBy("order_id").agg(*seller_aggregate_exprs())


def order_line_aggregates(order_items: DataFrame, products: DataFrame, sellers: DataFrame) -> DataFrame:
    """A1 + A3 + A4 in one aggregation over enriched items (one shuffle of items)."""
    return enrich_items(order_items, products, sellers).groupBy("order_id").agg(
        *item_aggregate_exprs(), *product_aggregate_exprs(), *seller_aggregate_exprs()
    )


def _left_join(left: DataFrame, right: DataFrame, key: str, null_safe: bool) -> DataFrame:
    if not null_safe:
        return left.join(right, key, "left")
    r = right.withColumnRenamed(key, "_rkey")
    return left.join(r, left[key].eqNullSafe(r["_rkey"]), "left").drop("_rkey")


def build_modeling_frame(tables: dict[str, DataFrame], null_safe: bool = False) -> DataFrame:
    """One row per order; unmatched orders keep null aggregates.

    Not sorted: consumers that need time order rank by (timestamp, order_id).
    ``null_safe=True`` lets a null ``order_id`` group match null-keyed orders,
    as the reference's merges do. It joins on ``<=>``, which cannot reuse the
    aggregates' ``order_id`` partitioning. Keys are a contract (see the grain
    report), so the default is plain equality.
    """
    require_tables(tables, ["customers", "orders", "order_items", "order_payments", "products", "sellers"])
    orders = tables["orders"]
    customers = tables["customers"].select("customer_id", "customer_city", "customer_state")
    lines = order_line_aggregates(tables["order_items"], tables["products"], tables["sellers"])
    payments = payment_aggregates(tables["order_payments"])
    # customers first, on the narrow order rows: if customers are too large to
    # broadcast, only these narrow rows are shuffled by customer_id; the wide
    # aggregate columns join afterwards on order_id, where the aggregates are
    # already hash-partitioned.
    frame = _left_join(
        _left_join(_left_join(orders, customers, "customer_id", null_safe), lines, "order_id", null_safe),
        payments,
        "order_id",
        null_safe,
    )
    ordered = list(orders.columns) + ["customer_city", "customer_state"] + ITEM_AGG_COLUMNS + PAYMENT_AGG_COLUMNS
    ordered += PRODUCT_AGG_COLUMNS + SELLER_AGG_COLUMNS
    return frame.select(*ordered)
