"""Registered queries: minimum slice, order frame, features (build steps 1-3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cohorts as C
from ..operators import order_frame as OF
from ..operators.features import DATASET_COLUMNS
from .context import Ctx
from .oracle import DATASET_COLUMNS_DOUBLE, mode_cte, statement
from .registry import query

# ---------------------------------------------------------------- step 1


@query(
    "late_rate_top_states",
    statement(
        """SELECT customer_state, COUNT(*) AS orders, AVG(is_late) AS late_rate FROM dataset
WHERE customer_state IN (
  SELECT customer_state FROM dataset WHERE customer_state IS NOT NULL
  GROUP BY customer_state ORDER BY COUNT(*) DESC, customer_state LIMIT 10)
GROUP BY customer_state""",
        ["late_rate"],
    ),
)
def late_rate_top_states(ctx: Ctx):
    return C.late_rate_top_values(ctx.dataset, "customer_state", 10)


# ---------------------------------------------------------------- step 2


@query(
    "item_aggregates",
    statement(
        """SELECT order_id, COUNT(order_item_id) AS item_count,
  COALESCE(SUM(price), CAST(0 AS DOUBLE)) AS total_price,
  COALESCE(SUM(freight_value), CAST(0 AS DOUBLE)) AS total_freight_value,
  COUNT(DISTINCT seller_id) AS unique_sellers
FROM v_items GROUP BY order_id""",
        ["total_price", "total_freight_value"],
        frame=False,
        dataset=False,
    ),
)
def item_aggregates(ctx: Ctx):
    return OF.item_aggregates(ctx.tables["order_items"])


@query(
    "payment_aggregates",
    statement(
        """SELECT p.order_id, p.payment_value, p.payment_installments_max,
  COALESCE(m.mode_value, 'unknown') AS payment_type_mode, p.payment_type_count
FROM v_pay p LEFT JOIN v_pay_mode m ON p.order_id = m.order_id""",
        ["payment_value"],
        dataset=False,
    ),
)
def payment_aggregates(ctx: Ctx):
    return OF.payment_aggregates(ctx.tables["order_payments"])


@query(
    "product_aggregates",
    statement(
        """SELECT order_id, avg_product_weight_g, avg_product_volume_cm3, avg_product_photos_qty,
  avg_product_name_length, avg_product_description_length, missing_product_metadata_share
FROM v_lines""",
        [
            "avg_product_weight_g", "avg_product_volume_cm3", "avg_product_photos_qty",
            "avg_product_name_length", "avg_product_description_length", "missing_product_metadata_share",
        ],
        dataset=False,
    ),
)
def product_aggregates(ctx: Ctx):
    return OF.product_aggregates(ctx.tables["order_items"], ctx.tables["products"])


@query(
    "seller_aggregates",
    statement(
        """SELECT l.order_id, l.seller_state_nunique, COALESCE(m.mode_value, 'unknown') AS primary_seller_state
FROM v_lines l LEFT JOIN v_seller_mode m ON l.order_id = m.order_id""",
        dataset=False,
    ),
)
def seller_aggregates(ctx: Ctx):
    return OF.seller_aggregates(ctx.tables["order_items"], ctx.tables["sellers"])


FRAME_DOUBLES = [
    "total_price", "total_freight_value", "payment_value", "avg_product_weight_g", "avg_product_volume_cm3",
    "avg_product_photos_qty", "avg_product_name_length", "avg_product_description_length",
    "missing_product_metadata_share",
]


@query("order_frame", statement("SELECT * FROM frame", FRAME_DOUBLES, dataset=False))
def order_frame(ctx: Ctx):
    return ctx.frame


@query(
    "mode_or_unknown",
    statement(
        """SELECT l.order_id, COALESCE(m.mode_value, 'unknown') AS primary_seller_state
FROM (SELECT DISTINCT order_id FROM v_items) l LEFT JOIN v_seller_mode m ON l.order_id = m.order_id""",
        dataset=False,
    ),
)
def mode_or_unknown(ctx: Ctx):
    items = ctx.tables["order_items"].select("order_id", "seller_id").join(
        ctx.tables["sellers"].select("seller_id", "seller_state"), "seller_id", "left"
    )
    return items.groupBy("order_id").agg(OF.mode_or_unknown("seller_state").alias("primary_seller_state"))


@query(
    "mode_or_null",
    statement(
        """SELECT l.order_id, m.mode_value AS primary_category
FROM (SELECT DISTINCT order_id FROM v_items) l LEFT JOIN v_cat_mode m ON l.order_id = m.order_id""",
        ctes=mode_cte(
            "v_cat_mode", "SELECT order_id, product_category_name FROM v_items_x", "order_id", "product_category_name"
        ),
        dataset=False,
    ),
)
def mode_or_null(ctx: Ctx):
    items = ctx.tables["order_items"].select("order_id", "product_id").join(
        ctx.tables["products"].select("product_id", "product_category_name"), "product_id", "left"
    )
    return C.primary_values(items, "product_category_name", "primary_category")


# ---------------------------------------------------------------- step 3


@query("model_dataset", statement("SELECT * FROM dataset", DATASET_COLUMNS_DOUBLE))
def model_dataset(ctx: Ctx):
    return ctx.dataset.select(*DATASET_COLUMNS)


@query(
    "calendar_features",
    statement(
        """SELECT order_id, order_purchase_timestamp, purchase_hour, purchase_day_of_week, purchase_month,
  purchase_day, is_weekend_purchase, estimated_delivery_days FROM dataset""",
        ["estimated_delivery_days"],
    ),
)
def calendar_features(ctx: Ctx):
    return ctx.dataset.select(
        "order_id", "order_purchase_timestamp", "purchase_hour", "purchase_day_of_week", "purchase_month",
        "purchase_day", "is_weekend_purchase", "estimated_delivery_days",
    )


@query(
    "ratio_features",
    statement(
        "SELECT order_id, item_count, total_price, price_per_item, freight_to_price_ratio FROM dataset",
        ["total_price", "price_per_item", "freight_to_price_ratio"],
    ),
)
def ratio_features(ctx: Ctx):
    return ctx.dataset.select("order_id", "item_count", "total_price", "price_per_item", "freight_to_price_ratio")


@query("target_balance", statement("SELECT is_late, COUNT(*) AS orders FROM dataset GROUP BY is_late"))
def target_balance(ctx: Ctx):
    return ctx.dataset.groupBy("is_late").agg(F.count(F.lit(1)).alias("orders"))


@query(
    "same_state_flag",
    statement(
        """SELECT seller_customer_same_state, COUNT(*) AS orders, AVG(is_late) AS late_rate
FROM dataset GROUP BY seller_customer_same_state""",
        ["late_rate"],
    ),
)
def same_state_flag(ctx: Ctx):
    return C.rate_by(ctx.dataset, "seller_customer_same_state")

