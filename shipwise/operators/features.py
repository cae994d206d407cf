"""Model dataset: delivered orders, binary target and 26 purchase-time features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs as X
from ..sources.contracts import LEAKAGE_COLUMNS, require_columns, validate_no_leakage

IDENTIFIER_COLUMNS = ["order_id", "order_purchase_timestamp"]
TARGET = "is_late"

# The feature lists and their order.
NUMERIC_FEATURES = [
    "item_count",
    "total_price",
    "total_freight_value",
    "unique_sellers",
    "payment_value",
    "payment_installments_max",
    "payment_type_count",
    "avg_product_weight_g",
    "avg_product_volume_cm3",
    "avg_product_photos_qty",
    "avg_product_name_length",
    "avg_product_description_length",
    "missing_product_metadata_share",
    "seller_state_nunique",
    "estimated_delivery_days",
    "purchase_hour",
    "purchase_day_of_week",
    "purchase_month",
    "purchase_day",
    "is_weekend_purchase",
    "price_per_item",
    "freight_to_price_ratio",
    "seller_customer_same_state",
]
CATEGORICAL_FEATURES = ["customer_state", "payment_type_mode", "primary_seller_state"]
FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES
DATASET_COLUMNS = IDENTIFIER_COLUMNS + NUMERIC_FEATURES + CATEGORICAL_FEATURES + [TARGET]

REQUIRED_FRAME_COLUMNS = [
    "order_id",
    "order_status",
    "order_purchase_timestamp",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
    "customer_state",
    "payment_type_mode",
    "primary_seller_state",
]


def delivered_with_dates(frame: DataFrame) -> DataFrame:
    """P4 + P5: delivered orders with purchase, promise and delivery timestamps."""
    return frame.where(F.col("order_status") == "delivered").dropna(
        subset=["order_purchase_timestamp", "order_estimated_delivery_date", "order_delivered_customer_date"]
    )


def add_target(df: DataFrame) -> DataFrame:
    """P10: late when delivered strictly after the promised timestamp."""
    return df.withColumn(
        TARGET, (F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date")).cast("int")
    )


def add_calendar_features(df: DataFrame, ts: str = "order_purchase_timestamp") -> DataFrame:
    return df.withColumns(
        {
            "purchase_hour": F.hour(ts),
            "purchase_day_of_week": X.weekday_mon0(ts),
            "purchase_month": F.month(ts),
            "purchase_day": F.dayofmonth(ts),
            "is_weekend_purchase": X.is_weekend(ts),
        }
    )


def add_ratio_features(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "price_per_item": X.safe_ratio("total_price", "item_count"),
            "freight_to_price_ratio": X.safe_ratio("total_freight_value", "total_price"),
        }
    )


def build_model_dataset(frame: DataFrame) -> DataFrame:
    """29 columns: identifiers, 23 numeric, 3 categorical, ``is_late``."""
    require_columns(frame.columns, REQUIRED_FRAME_COLUMNS)
    df = add_target(delivered_with_dates(frame))
    df = df.withColumn(
        "estimated_delivery_days", X.day_diff("order_purchase_timestamp", "order_estimated_delivery_date")
    )
    df = add_ratio_features(add_calendar_features(df))
    df = df.withColumn(
        "seller_customer_same_state", X.null_safe_same("primary_seller_state", "customer_state")
    )
    out = df.select(*DATASET_COLUMNS)
    # +-inf / NaN guard on every double column (unreachable after safe ratios).
    doubles = {f.name for f in out.schema.fields if isinstance(f.dataType, T.DoubleType)}
    return out.select(*[X.finite_or_null(c).alias(c) if c in doubles else F.col(c) for c in out.columns])


def split_features_target(dataset: DataFrame) -> DataFrame:
    """Predictors with the target kept alongside (one DataFrame, not two)."""
    return dataset.drop(*IDENTIFIER_COLUMNS)


def feature_columns(dataset: DataFrame) -> list[str]:
    cols = [c for c in dataset.columns if c not in IDENTIFIER_COLUMNS and c != TARGET]
    validate_no_leakage(cols)
    return cols


__all__ = [
    "CATEGORICAL_FEATURES",
    "DATASET_COLUMNS",
    "FEATURES",
    "IDENTIFIER_COLUMNS",
    "LEAKAGE_COLUMNS",
    "NUMERIC_FEATURES",
    "TARGET",
    "build_model_dataset",
    "delivered_with_dates",
    "feature_columns",
    "split_features_target",
    "validate_no_leakage",
]
