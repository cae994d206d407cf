"""Registered queries: raw-table profiling (build step 4)."""

from __future__ import annotations

from ..operators import profiling as P
from ..sources.contracts import DECLARED_KEYS
from .context import Ctx
from .oracle import statement
from .registry import query


def r2(x: str) -> str:
    return f"round_even(({x}) * 100, 0) / 100"


VIEW_OF = {
    "customers": "v_customers",
    "orders": "v_orders",
    "order_items": "v_items",
    "order_payments": "v_payments",
    "products": "v_products",
    "sellers": "v_sellers",
}


def _grain_sql() -> str:
    parts = []
    for name, key in DECLARED_KEYS.items():
        k = ", ".join(key)
        parts.append(
            f"""SELECT '{name}' AS "table", CAST(SUM(n) AS BIGINT) AS rows, '{" + ".join(key)}' AS declared_key,
  SUM(n - 1) = 0 AS key_is_unique, CAST(SUM(n - 1) AS BIGINT) AS duplicate_rows_on_key
FROM (SELECT {k}, COUNT(*) AS n FROM {VIEW_OF[name]} GROUP BY {k}) g"""
        )
    return "\nUNION ALL\n".join(parts)


@query("grain_report", statement(_grain_sql(), frame=False, dataset=False))
def grain_report(ctx: Ctx):
    return P.grain_report(ctx.tables, DECLARED_KEYS)


def _dup_all_cols(view: str, label: str) -> str:
    return f"""SELECT '{label}' AS "check", CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS "count"
FROM (SELECT COLUMNS(*), COUNT(*) AS n FROM {view} GROUP BY ALL) g"""


@query(
    "exact_duplicates",
    statement(
        "\nUNION ALL\n".join(
            _dup_all_cols(VIEW_OF[n], f"exact duplicate rows in {n}") for n in ("orders", "order_items", "order_payments")
        ),
        frame=False,
        dataset=False,
    ),
)
def exact_duplicates(ctx: Ctx):
    from pyspark.sql import functions as F

    parts = [
        P.exact_duplicate_count(ctx.tables[n]).select(F.lit(f"exact duplicate rows in {n}").alias("check"), "count")
        for n in ("orders", "order_items", "order_payments")
    ]
    return P._union(parts)


@query(
    "key_consistency",
    statement(
        """SELECT 'orders with >1 customer_id' AS "check", CAST(COUNT(*) FILTER (WHERE d > 1) AS BIGINT) AS "count"
FROM (SELECT order_id, COUNT(DISTINCT customer_id) AS d FROM v_orders WHERE order_id IS NOT NULL GROUP BY order_id) a
UNION ALL
SELECT 'orders with >1 order_status', CAST(COUNT(*) FILTER (WHERE d > 1) AS BIGINT)
FROM (SELECT order_id, COUNT(DISTINCT order_status) AS d FROM v_orders WHERE order_id IS NOT NULL GROUP BY order_id) b
UNION ALL
"""
        + "\nUNION ALL\n".join(
            _dup_all_cols(VIEW_OF[n], f"exact duplicate rows in {n}") for n in ("orders", "order_items", "order_payments")
        ),
        frame=False,
        dataset=False,
    ),
)
def key_consistency(ctx: Ctx):
    return P.consistency_report(ctx.tables["orders"], ctx.tables)


def _join_sql(left: str, right: str, on: str, ln: str, rn: str) -> str:
    return f"""SELECT '{ln} -> {rn}' AS "join", '{on}' AS "on",
  (SELECT CAST(COUNT(*) AS BIGINT) FROM {left}) AS left_rows,
  (SELECT CAST(COUNT(*) AS BIGINT) FROM {left} l
    WHERE NOT EXISTS (SELECT 1 FROM {right} r WHERE r.{on} IS NOT DISTINCT FROM l.{on})) AS unmatched_left_rows,
  (SELECT CAST(COALESCE(MAX(n), 0) AS BIGINT) FROM (SELECT COUNT(*) AS n FROM {right} WHERE {on} IS NOT NULL GROUP BY {on}) g)
    AS max_right_per_key,
  (SELECT COALESCE({r2('AVG(n)')}, CAST(0 AS DOUBLE)) FROM (SELECT COUNT(*) AS n FROM {right} WHERE {on} IS NOT NULL GROUP BY {on}) g)
    AS mean_right_per_key"""


JOINS = [
    ("v_orders", "v_customers", "customer_id", "orders", "customers"),
    ("v_orders", "v_items", "order_id", "orders", "order_items"),
    ("v_orders", "v_payments", "order_id", "orders", "order_payments"),
    ("v_items", "v_products", "product_id", "order_items", "products"),
    ("v_items", "v_sellers", "seller_id", "order_items", "sellers"),
]


@query(
    "join_cardinality",
    statement("\nUNION ALL\n".join(_join_sql(*j) for j in JOINS), ["mean_right_per_key"], frame=False, dataset=False),
)
def join_cardinality(ctx: Ctx):
    return P.join_report(ctx.tables)


@query(
    "unmatched_orders",
    statement(
        """SELECT 'order_items' AS right_table, CAST(COUNT(*) AS BIGINT) AS unmatched FROM v_orders o
  WHERE NOT EXISTS (SELECT 1 FROM v_items i WHERE i.order_id = o.order_id)
UNION ALL
SELECT 'order_payments', CAST(COUNT(*) AS BIGINT) FROM v_orders o
  WHERE NOT EXISTS (SELECT 1 FROM v_payments p WHERE p.order_id = o.order_id)""",
        frame=False,
        dataset=False,
    ),
)
def unmatched_orders(ctx: Ctx):
    from pyspark.sql import functions as F

    t = ctx.tables
    return P.unmatched_count(t["orders"], t["order_items"], "order_id").select(
        F.lit("order_items").alias("right_table"), "unmatched"
    ).unionByName(
        P.unmatched_count(t["orders"], t["order_payments"], "order_id").select(
            F.lit("order_payments").alias("right_table"), "unmatched"
        )
    )


def _missing_sql() -> str:
    # column lists of the views, in view order
    cols = {
        "customers": ["customer_id", "customer_city", "customer_state"],
        "orders": [
            "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
            "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
        ],
        "order_items": ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price",
                        "freight_value"],
        "order_payments": ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
        "products": ["product_id", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
                     "product_photos_qty", "product_name_lenght", "product_description_lenght",
                     "product_category_name"],
        "sellers": ["seller_id", "seller_city", "seller_state"],
    }
    parts = []
    for name, cs in cols.items():
        for c in cs:
            parts.append(
                f"""SELECT '{name}' AS "table", '{c}' AS "column",
  CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS missing,
  {r2(f'CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / COUNT(*) * 100')} AS missing_pct
FROM {VIEW_OF[name]}"""
            )
    return "SELECT * FROM (\n" + "\nUNION ALL\n".join(parts) + "\n) m WHERE missing > 0"


@query("missingness_report", statement(_missing_sql(), ["missing_pct"], frame=False, dataset=False))
def missingness_report(ctx: Ctx):
    return P.missingness_report(ctx.tables)


@query(
    "status_share",
    statement(
        f"""SELECT order_status, COUNT(*) AS n_orders,
  {r2('CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM v_orders) * 100')} AS share_pct
FROM v_orders GROUP BY order_status""",
        ["share_pct"],
        frame=False,
        dataset=False,
    ),
)
def status_share(ctx: Ctx):
    return P.value_shares(ctx.tables["orders"], "order_status")


@query(
    "funnel",
    statement(
        f"""WITH s AS (
  SELECT COUNT(*) AS s0,
    COUNT(*) FILTER (WHERE order_status = 'delivered') AS s1,
    COUNT(*) FILTER (WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL) AS s2,
    COUNT(*) FILTER (WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL
                     AND order_estimated_delivery_date IS NOT NULL) AS s3,
    COUNT(*) FILTER (WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL
                     AND order_estimated_delivery_date IS NOT NULL AND order_purchase_timestamp IS NOT NULL) AS s4
  FROM v_orders)
SELECT stage, CAST(n AS BIGINT) AS n_orders, {r2('CAST(n AS DOUBLE) / s0 * 100')} AS share_of_raw_pct FROM (
  SELECT '{P.FUNNEL_STAGES[0]}' AS stage, s0 AS n, s0 FROM s UNION ALL
  SELECT '{P.FUNNEL_STAGES[1]}', s1, s0 FROM s UNION ALL
  SELECT '{P.FUNNEL_STAGES[2]}', s2, s0 FROM s UNION ALL
  SELECT '{P.FUNNEL_STAGES[3]}', s3, s0 FROM s UNION ALL
  SELECT '{P.FUNNEL_STAGES[4]}', s4, s0 FROM s) f""",
        ["share_of_raw_pct"],
        frame=False,
        dataset=False,
    ),
)
def funnel(ctx: Ctx):
    return P.funnel(ctx.tables["orders"])
