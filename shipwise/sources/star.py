"""Order-shaped views over the TPC-H-like test tables.

The test tables have no payments, delivery dates or nulls, so the six
marketplace tables are derived from them with fixed rules (nulls injected by
key modulus, one payment per line item). Everything is a lazy
projection or join; nothing is materialised.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

E = F.expr


def read_base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _measure(value_sql: str) -> F.Column:
    return E(f"CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE CAST({value_sql} AS DOUBLE) END")


def star_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    nation = read_base(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = read_base(spark, sf_dir, "customer")
    orders = read_base(spark, sf_dir, "orders")
    lineitem = read_base(spark, sf_dir, "lineitem")
    part = read_base(spark, sf_dir, "part")
    supplier = read_base(spark, sf_dir, "supplier")

    customers = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )

    # Latest part per order drives the synthetic delivery delay; orders
    # without line items get no delivery date.
    lag = lineitem.groupBy("l_orderkey").agg(F.max("l_partkey").alias("lag_key"))
    order_view = orders.join(lag, orders.o_orderkey == lag.l_orderkey, "left").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        E("CASE WHEN o_orderstatus = 'P' THEN 'shipped' ELSE 'delivered' END").alias("order_status"),
        E(
            "CASE WHEN o_orderkey % 997 = 1 THEN NULL "
            "ELSE o_orderdate + INTERVAL '1' SECOND * ((o_orderkey * 37) % 86400) END"
        ).alias("order_purchase_timestamp"),
        E("o_orderdate + INTERVAL '1' DAY").alias("order_approved_at"),
        E("o_orderdate + INTERVAL '2' DAY").alias("order_delivered_carrier_date"),
        E("o_orderdate + INTERVAL '1' HOUR * (24 * (lag_key % 29) + o_orderkey % 24)").alias(
            "order_delivered_customer_date"
        ),
        E(
            "CASE WHEN o_orderkey % 499 = 1 THEN NULL "
            "ELSE o_orderdate + INTERVAL '1' DAY * (8 + (o_custkey * 7 + o_orderkey) % 33) END"
        ).alias("order_estimated_delivery_date"),
    )

    order_items = lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        E("CASE WHEN l_orderkey % 101 = 0 THEN CAST(0 AS DOUBLE) ELSE l_extendedprice END").alias("price"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"),
    )

    order_payments = lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        E(
            "CASE WHEN l_orderkey % 53 = 0 THEN NULL WHEN l_returnflag = 'A' THEN 'credit_card' "
            "WHEN l_returnflag = 'N' THEN 'boleto' ELSE 'voucher' END"
        ).alias("payment_type"),
        E("1 + CAST(l_quantity AS INTEGER) % 10").alias("payment_installments"),
        F.col("l_extendedprice").alias("payment_value"),
    )

    products = part.select(
        F.col("p_partkey").alias("product_id"),
        _measure("p_size * 100").alias("product_weight_g"),
        E("CASE WHEN p_partkey % 10 <= 1 THEN NULL ELSE CAST(10 + p_size AS DOUBLE) END").alias("product_length_cm"),
        _measure("5 + p_partkey % 20").alias("product_height_cm"),
        _measure("8 + p_partkey % 15").alias("product_width_cm"),
        _measure("1 + p_partkey % 6").alias("product_photos_qty"),
        _measure("length(p_name)").alias("product_name_lenght"),
        _measure("length(p_name) * 10 + p_size").alias("product_description_lenght"),
        E("CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_brand END").alias("product_category_name"),
    )

    sellers = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("s_name").alias("seller_city"),
        E("CASE WHEN s_suppkey % 17 = 0 THEN NULL ELSE n_name END").alias("seller_state"),
    )

    return {
        "customers": customers,
        "orders": order_view,
        "order_items": order_items,
        "order_payments": order_payments,
        "products": products,
        "sellers": sellers,
    }


def geo_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Postcode prefixes of customers and sellers, and points of each prefix (a few lie out of bounds)."""
    customer, supplier = read_base(spark, sf_dir, "customer"), read_base(spark, sf_dir, "supplier")
    return {
        "customers": customer.select(F.col("c_custkey").alias("customer_id"), (F.col("c_custkey") % 400).alias("customer_zip_code_prefix")),
        "sellers": supplier.select(
            F.col("s_suppkey").alias("seller_id"), E("CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE s_suppkey % 420 END").alias("seller_zip_code_prefix")
        ),
        "geolocation": customer.select(
            (F.col("c_custkey") % 400).alias("geolocation_zip_code_prefix"),
            E("CASE WHEN c_custkey % 41 = 0 THEN CAST(80 AS DOUBLE) ELSE CAST(-32 + (c_custkey * 7 % 400) / CAST(11 AS DOUBLE) AS DOUBLE) END")
            .alias("geolocation_lat"),
            E("CAST(-73 + (c_custkey * 13 % 400) / CAST(11 AS DOUBLE) AS DOUBLE)").alias("geolocation_lng"),
        ),
    }


GEO_VIEWS_SQL = """v_customer_zip AS (SELECT c_custkey AS customer_id, c_custkey % 400 AS prefix FROM customer),
v_seller_zip AS (SELECT s_suppkey AS seller_id, CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE s_suppkey % 420 END AS prefix FROM supplier),
v_geolocation AS (
  SELECT c_custkey % 400 AS prefix,
    CASE WHEN c_custkey % 41 = 0 THEN CAST(80 AS DOUBLE) ELSE -32 + (c_custkey * 7 % 400) / CAST(11 AS DOUBLE) END AS lat,
    -73 + (c_custkey * 13 % 400) / CAST(11 AS DOUBLE) AS lng
  FROM customer)"""

# The same views as SQL text for DuckDB (oracle side). View names carry a
# ``v_`` prefix because ``orders`` collides with the base table there.
STAR_VIEWS_SQL = """
v_customers AS (
  SELECT c_custkey AS customer_id, c_mktsegment AS customer_city, n_name AS customer_state
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
v_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
    CASE WHEN o_orderstatus = 'P' THEN 'shipped' ELSE 'delivered' END AS order_status,
    CASE WHEN o_orderkey % 997 = 1 THEN NULL
         ELSE o_orderdate + INTERVAL '1' SECOND * ((o_orderkey * 37) % 86400) END AS order_purchase_timestamp,
    o_orderdate + INTERVAL '1' DAY AS order_approved_at,
    o_orderdate + INTERVAL '2' DAY AS order_delivered_carrier_date,
    o_orderdate + INTERVAL '1' HOUR * (24 * (lag_key % 29) + o_orderkey % 24) AS order_delivered_customer_date,
    CASE WHEN o_orderkey % 499 = 1 THEN NULL
         ELSE o_orderdate + INTERVAL '1' DAY * (8 + (o_custkey * 7 + o_orderkey) % 33) END
      AS order_estimated_delivery_date
  FROM orders LEFT JOIN (SELECT l_orderkey, MAX(l_partkey) AS lag_key FROM lineitem GROUP BY l_orderkey) k
    ON o_orderkey = k.l_orderkey),
v_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
    l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
    CASE WHEN l_orderkey % 101 = 0 THEN CAST(0 AS DOUBLE) ELSE l_extendedprice END AS price,
    l_extendedprice * l_tax AS freight_value
  FROM lineitem),
v_payments AS (
  SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential,
    CASE WHEN l_orderkey % 53 = 0 THEN NULL WHEN l_returnflag = 'A' THEN 'credit_card'
         WHEN l_returnflag = 'N' THEN 'boleto' ELSE 'voucher' END AS payment_type,
    1 + CAST(l_quantity AS INTEGER) % 10 AS payment_installments,
    l_extendedprice AS payment_value
  FROM lineitem),
v_products AS (
  SELECT p_partkey AS product_id,
    CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE CAST(p_size * 100 AS DOUBLE) END AS product_weight_g,
    CASE WHEN p_partkey % 10 <= 1 THEN NULL ELSE CAST(10 + p_size AS DOUBLE) END AS product_length_cm,
    CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE CAST(5 + p_partkey % 20 AS DOUBLE) END AS product_height_cm,
    CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE CAST(8 + p_partkey % 15 AS DOUBLE) END AS product_width_cm,
    CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE CAST(1 + p_partkey % 6 AS DOUBLE) END AS product_photos_qty,
    CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE CAST(length(p_name) AS DOUBLE) END AS product_name_lenght,
    CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE CAST(length(p_name) * 10 + p_size AS DOUBLE) END
      AS product_description_lenght,
    CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_brand END AS product_category_name
  FROM part),
v_sellers AS (
  SELECT s_suppkey AS seller_id, s_name AS seller_city,
    CASE WHEN s_suppkey % 17 = 0 THEN NULL ELSE n_name END AS seller_state
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)
"""
