"""Table specs and schema-level contracts (no data is read here)."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    name: str
    file_name: str
    schema: T.StructType
    key: tuple[str, ...]


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


S, D, I, TS = T.StringType(), T.DoubleType(), T.IntegerType(), T.TimestampNTZType()

# Logical table names, raw file names and declared keys of the
# marketplace dataset, in this order.
TABLE_SPECS: tuple[TableSpec, ...] = (
    TableSpec(
        "customers",
        "olist_customers_dataset.csv",
        _schema(
            ("customer_id", S),
            ("customer_unique_id", S),
            ("customer_zip_code_prefix", S),
            ("customer_city", S),
            ("customer_state", S),
        ),
        ("customer_id",),
    ),
    TableSpec(
        "orders",
        "olist_orders_dataset.csv",
        _schema(
            ("order_id", S),
            ("customer_id", S),
            ("order_status", S),
            ("order_purchase_timestamp", TS),
            ("order_approved_at", TS),
            ("order_delivered_carrier_date", TS),
            ("order_delivered_customer_date", TS),
            ("order_estimated_delivery_date", TS),
        ),
        ("order_id",),
    ),
    TableSpec(
        "order_items",
        "olist_order_items_dataset.csv",
        _schema(
            ("order_id", S),
            ("order_item_id", I),
            ("product_id", S),
            ("seller_id", S),
            ("shipping_limit_date", TS),
            ("price", D),
            ("freight_value", D),
        ),
        ("order_id", "order_item_id"),
    ),
    TableSpec(
        "order_payments",
        "olist_order_payments_dataset.csv",
        _schema(
            ("order_id", S),
            ("payment_sequential", I),
            ("payment_type", S),
            ("payment_installments", I),
            ("payment_value", D),
        ),
        ("order_id", "payment_sequential"),
    ),
    TableSpec(
        "products",
        "olist_products_dataset.csv",
        _schema(
            ("product_id", S),
            ("product_category_name", S),
            ("product_name_lenght", S),
            ("product_description_lenght", S),
            ("product_photos_qty", S),
            ("product_weight_g", S),
            ("product_length_cm", S),
            ("product_height_cm", S),
            ("product_width_cm", S),
        ),
        ("product_id",),
    ),
    TableSpec(
        "sellers",
        "olist_sellers_dataset.csv",
        _schema(
            ("seller_id", S),
            ("seller_zip_code_prefix", S),
            ("seller_city", S),
            ("seller_state", S),
        ),
        ("seller_id",),
    ),
)

SPECS_BY_NAME = {spec.name: spec for spec in TABLE_SPECS}
DECLARED_KEYS = {spec.name: list(spec.key) for spec in TABLE_SPECS}

# Columns only known after the outcome (post-purchase), never features.
LEAKAGE_COLUMNS = frozenset(
    {
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        "order_status",
        "review_score",
        "review_comment_title",
        "review_comment_message",
    }
)


def list_expected_files() -> list[str]:
    """Raw file names in a stable order."""
    return [spec.file_name for spec in TABLE_SPECS]


def require_files(spark: SparkSession, data_dir: str, file_names: Iterable[str] | None = None) -> None:
    """Raise once, naming every missing source file, sorted.

    Uses the Hadoop file system of the session, so it works for any scheme the
    cluster can read (hdfs, s3a, abfs, file).
    """
    names = list(file_names) if file_names is not None else list_expected_files()
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    base = jvm.org.apache.hadoop.fs.Path(data_dir)
    fs = base.getFileSystem(conf)
    missing = [n for n in names if not fs.exists(jvm.org.apache.hadoop.fs.Path(base, n))]
    if missing:
        raise FileNotFoundError(f"Missing required raw files in {data_dir}: {', '.join(sorted(missing))}")


def require_tables(tables: dict, required: Iterable[str]) -> None:
    """Raise ``KeyError`` naming every missing logical table, sorted."""
    missing = sorted(set(required) - set(tables))
    if missing:
        raise KeyError(f"Missing required tables: {', '.join(missing)}")


def require_columns(columns: Iterable[str], required: Iterable[str], what: str = "modeling") -> None:
    """Raise ``KeyError`` naming every missing column, sorted."""
    missing = sorted(set(required) - set(columns))
    if missing:
        raise KeyError(f"Missing required {what} columns: {', '.join(missing)}")


def validate_no_leakage(columns: Iterable[str]) -> None:
    """Raise ``ValueError`` when post-outcome columns are among the features."""
    leaked = sorted(set(columns) & LEAKAGE_COLUMNS)
    if leaked:
        raise ValueError(f"Feature set contains leakage columns: {', '.join(leaked)}")
