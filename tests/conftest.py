from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

from shipwise.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(4, 4, app="shipwise-tests")


def ts(s: str) -> datetime:
    return datetime.fromisoformat(s)


@pytest.fixture
def tables(spark):
    """The reference's three-order fixture (FIXTURES.md section 1)."""
    customers = spark.createDataFrame(
        [("customer_1", "sao paulo", "SP"), ("customer_2", "rio de janeiro", "RJ"), ("customer_3", "curitiba", "PR")],
        "customer_id string, customer_city string, customer_state string",
    )
    orders = spark.createDataFrame(
        [
            ("order_1", "customer_1", "delivered", ts("2018-01-01 10:00:00"), ts("2018-01-01 11:00:00"),
             ts("2018-01-02 09:00:00"), ts("2018-01-07 12:00:00"), ts("2018-01-10 00:00:00")),
            ("order_2", "customer_2", "delivered", ts("2018-01-05 20:30:00"), ts("2018-01-05 21:00:00"),
             ts("2018-01-06 08:00:00"), ts("2018-01-15 12:00:00"), ts("2018-01-12 00:00:00")),
            ("order_3", "customer_3", "delivered", ts("2018-02-10 14:00:00"), ts("2018-02-10 15:00:00"),
             ts("2018-02-11 09:00:00"), ts("2018-02-17 18:00:00"), ts("2018-02-16 00:00:00")),
        ],
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
        "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
        "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz",
    )
    order_items = spark.createDataFrame(
        [
            ("order_1", 1, "product_1", "seller_1", ts("2018-01-03 00:00:00"), 100.0, 15.0),
            ("order_2", 1, "product_2", "seller_2", ts("2018-01-06 00:00:00"), 200.0, 35.0),
            ("order_3", 1, "product_3", "seller_3", ts("2018-02-12 00:00:00"), 80.0, 10.0),
        ],
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "shipping_limit_date timestamp_ntz, price double, freight_value double",
    )
    order_payments = spark.createDataFrame(
        [("order_1", 1, "credit_card", 2, 115.0), ("order_2", 1, "boleto", 1, 235.0),
         ("order_3", 1, "credit_card", 4, 90.0)],
        "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double",
    )
    products = spark.createDataFrame(
        [
            ("product_1", 500.0, 20.0, 10.0, 15.0, 3.0, 40.0, 200.0),
            ("product_2", 2500.0, 60.0, 20.0, 30.0, 5.0, 55.0, 450.0),
            ("product_3", None, None, None, None, None, None, None),
        ],
        "product_id string, product_weight_g double, product_length_cm double, product_height_cm double, "
        "product_width_cm double, product_photos_qty double, product_name_lenght double, "
        "product_description_lenght double",
    )
    sellers = spark.createDataFrame(
        [("seller_1", "SP", "sao paulo"), ("seller_2", "MG", "belo horizonte"), ("seller_3", "PR", "curitiba")],
        "seller_id string, seller_state string, seller_city string",
    )
    return {
        "customers": customers,
        "orders": orders,
        "order_items": order_items,
        "order_payments": order_payments,
        "products": products,
        "sellers": sellers,
    }
