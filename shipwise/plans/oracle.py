"""Reference SQL (DuckDB dialect) for each registered query.

Each statement re-declares the order-shaped views over the base tables in one
``WITH`` prefix and computes the same result as the Spark query with plain
SQL (window functions, ``GROUP BY``), independent of the library code.
Double outputs are rounded half-even to ``DIGITS`` like the Spark side.
"""

from __future__ import annotations

from ..sources.star import STAR_VIEWS_SQL
from .context import DIGITS

MICROS_PER_DAY = 86400000000


def mode_cte(name: str, source_sql: str, key: str, value: str) -> str:
    """Most frequent non-null value per key, ties to the smallest value."""
    return f"""{name} AS (
  SELECT {key}, {value} AS mode_value FROM (
    SELECT {key}, {value},
      ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY COUNT(*) DESC, {value}) AS rn
    FROM ({source_sql}) src WHERE {value} IS NOT NULL GROUP BY {key}, {value}) t
  WHERE rn = 1)"""


ITEMS_ENRICHED = """SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, i.price, i.freight_value,
    p.product_weight_g, p.product_length_cm, p.product_height_cm, p.product_width_cm,
    p.product_photos_qty, p.product_name_lenght, p.product_description_lenght, p.product_category_name,
    s.seller_state
  FROM v_items i LEFT JOIN v_products p ON i.product_id = p.product_id
  LEFT JOIN v_sellers s ON i.seller_id = s.seller_id"""

FRAME_CTES = f"""
v_items_x AS ({ITEMS_ENRICHED}),
v_lines AS (
  SELECT order_id,
    COUNT(order_item_id) AS item_count,
    COALESCE(SUM(price), CAST(0 AS DOUBLE)) AS total_price,
    COALESCE(SUM(freight_value), CAST(0 AS DOUBLE)) AS total_freight_value,
    COUNT(DISTINCT seller_id) AS unique_sellers,
    AVG(product_weight_g) AS avg_product_weight_g,
    AVG(product_length_cm * product_height_cm * product_width_cm) AS avg_product_volume_cm3,
    AVG(product_photos_qty) AS avg_product_photos_qty,
    AVG(product_name_lenght) AS avg_product_name_length,
    AVG(product_description_lenght) AS avg_product_description_length,
    AVG(CASE WHEN product_weight_g IS NULL AND product_length_cm IS NULL AND product_height_cm IS NULL
              AND product_width_cm IS NULL AND product_photos_qty IS NULL AND product_name_lenght IS NULL
              AND product_description_lenght IS NULL THEN 1 ELSE 0 END) AS missing_product_metadata_share,
    COUNT(DISTINCT seller_state) AS seller_state_nunique
  FROM v_items_x GROUP BY order_id),
{mode_cte("v_seller_mode", "SELECT order_id, seller_state FROM v_items_x", "order_id", "seller_state")},
v_pay AS (
  SELECT order_id,
    COALESCE(SUM(payment_value), CAST(0 AS DOUBLE)) AS payment_value,
    MAX(payment_installments) AS payment_installments_max,
    COUNT(DISTINCT payment_type) AS payment_type_count
  FROM v_payments GROUP BY order_id),
{mode_cte("v_pay_mode", "SELECT order_id, payment_type FROM v_payments", "order_id", "payment_type")},
frame AS (
  SELECT o.order_id, o.customer_id, o.order_status, o.order_purchase_timestamp, o.order_approved_at,
    o.order_delivered_carrier_date, o.order_delivered_customer_date, o.order_estimated_delivery_date,
    c.customer_city, c.customer_state,
    l.item_count, l.total_price, l.total_freight_value, l.unique_sellers,
    py.payment_value, py.payment_installments_max,
    CASE WHEN py.order_id IS NULL THEN NULL ELSE COALESCE(pm.mode_value, 'unknown') END AS payment_type_mode,
    py.payment_type_count,
    l.avg_product_weight_g, l.avg_product_volume_cm3, l.avg_product_photos_qty, l.avg_product_name_length,
    l.avg_product_description_length, l.missing_product_metadata_share,
    l.seller_state_nunique,
    CASE WHEN l.order_id IS NULL THEN NULL ELSE COALESCE(sm.mode_value, 'unknown') END AS primary_seller_state
  FROM v_orders o
  LEFT JOIN v_lines l ON o.order_id = l.order_id
  LEFT JOIN v_pay py ON o.order_id = py.order_id
  LEFT JOIN v_pay_mode pm ON o.order_id = pm.order_id
  LEFT JOIN v_seller_mode sm ON o.order_id = sm.order_id
  LEFT JOIN v_customers c ON o.customer_id = c.customer_id)"""

DATASET_CTE = f"""
dataset AS (
  SELECT order_id, order_purchase_timestamp,
    item_count, total_price, total_freight_value, unique_sellers, payment_value, payment_installments_max,
    payment_type_count, avg_product_weight_g, avg_product_volume_cm3, avg_product_photos_qty,
    avg_product_name_length, avg_product_description_length, missing_product_metadata_share,
    seller_state_nunique,
    CAST(epoch_us(order_estimated_delivery_date) - epoch_us(order_purchase_timestamp) AS DOUBLE)
      / {MICROS_PER_DAY} AS estimated_delivery_days,
    CAST(hour(order_purchase_timestamp) AS INTEGER) AS purchase_hour,
    CAST(isodow(order_purchase_timestamp) - 1 AS INTEGER) AS purchase_day_of_week,
    CAST(month(order_purchase_timestamp) AS INTEGER) AS purchase_month,
    CAST(day(order_purchase_timestamp) AS INTEGER) AS purchase_day,
    CASE WHEN isodow(order_purchase_timestamp) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend_purchase,
    total_price / NULLIF(item_count, 0) AS price_per_item,
    total_freight_value / NULLIF(total_price, 0) AS freight_to_price_ratio,
    CASE WHEN COALESCE(primary_seller_state, 'unknown') = COALESCE(customer_state, 'unknown')
         THEN 1 ELSE 0 END AS seller_customer_same_state,
    customer_state, payment_type_mode, primary_seller_state,
    CASE WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 1 ELSE 0 END AS is_late
  FROM frame
  WHERE order_status = 'delivered' AND order_purchase_timestamp IS NOT NULL
    AND order_estimated_delivery_date IS NOT NULL AND order_delivered_customer_date IS NOT NULL)"""

DATASET_COLUMNS_DOUBLE = [
    "total_price", "total_freight_value", "payment_value", "avg_product_weight_g", "avg_product_volume_cm3",
    "avg_product_photos_qty", "avg_product_name_length", "avg_product_description_length",
    "missing_product_metadata_share", "estimated_delivery_days", "price_per_item", "freight_to_price_ratio",
]


def statement(body: str, doubles: list[str] = (), ctes: str = "", frame: bool = True, dataset: bool = True) -> str:
    """Assemble ``WITH views[, frame][, dataset][, ctes] SELECT ...`` with rounded doubles."""
    parts = [STAR_VIEWS_SQL.strip()]
    if frame or dataset:
        parts.append(FRAME_CTES.strip())
    if dataset:
        parts.append(DATASET_CTE.strip())
    if ctes:
        parts.append(ctes.strip().rstrip(","))
    if doubles:
        scale = 10**DIGITS
        repl = ", ".join(f"round_even({c} * {scale}, 0) / {scale} AS {c}" for c in doubles)
        body = f"SELECT * REPLACE ({repl}) FROM (\n{body}\n) q"
    return "WITH " + ",\n".join(parts) + "\n" + body
