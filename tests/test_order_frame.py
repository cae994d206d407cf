from __future__ import annotations

import pytest

from shipwise.operators.features import build_model_dataset, split_features_target
from shipwise.operators.order_frame import build_modeling_frame
from shipwise.operators.ordering import chronological_split
from shipwise.sources.contracts import require_tables, validate_no_leakage


def by_id(df, key="order_id"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_modeling_frame_contains_expected_joined_columns(tables):
    frame = build_modeling_frame(tables)
    expected = {"customer_state", "item_count", "total_price", "payment_type_mode", "primary_seller_state",
                "avg_product_weight_g"}
    assert expected.issubset(frame.columns)


def test_frame_values_match_hand_computed(tables):
    rows = by_id(build_modeling_frame(tables))
    assert [rows[o]["item_count"] for o in ("order_1", "order_2", "order_3")] == [1, 1, 1]
    assert [rows[o]["total_price"] for o in ("order_1", "order_2", "order_3")] == [100.0, 200.0, 80.0]
    assert [rows[o]["payment_type_mode"] for o in ("order_1", "order_2", "order_3")] == [
        "credit_card", "boleto", "credit_card"]
    assert rows["order_1"]["avg_product_volume_cm3"] == 3000.0
    assert rows["order_2"]["avg_product_volume_cm3"] == 36000.0
    assert rows["order_3"]["avg_product_weight_g"] is None
    assert rows["order_3"]["missing_product_metadata_share"] == 1.0
    assert rows["order_1"]["missing_product_metadata_share"] == 0.0
    assert [rows[o]["primary_seller_state"] for o in ("order_1", "order_2", "order_3")] == ["SP", "MG", "PR"]


def test_build_model_dataset_creates_binary_target(tables):
    rows = by_id(build_model_dataset(build_modeling_frame(tables)))
    assert {r["is_late"] for r in rows.values()} <= {0, 1}
    assert rows["order_2"]["is_late"] == 1
    assert [rows[o]["is_late"] for o in ("order_1", "order_2", "order_3")] == [0, 1, 1]


def test_features_match_hand_computed(tables):
    rows = by_id(build_model_dataset(build_modeling_frame(tables)))
    est = [rows[o]["estimated_delivery_days"] for o in ("order_1", "order_2", "order_3")]
    assert est == pytest.approx([8.583333, 6.145833, 5.416667], abs=1e-6)
    assert [rows[o]["purchase_hour"] for o in ("order_1", "order_2", "order_3")] == [10, 20, 14]
    assert [rows[o]["purchase_day_of_week"] for o in ("order_1", "order_2", "order_3")] == [0, 4, 5]
    assert [rows[o]["is_weekend_purchase"] for o in ("order_1", "order_2", "order_3")] == [0, 0, 1]
    assert [rows[o]["freight_to_price_ratio"] for o in ("order_1", "order_2", "order_3")] == pytest.approx(
        [0.15, 0.175, 0.125])
    assert [rows[o]["seller_customer_same_state"] for o in ("order_1", "order_2", "order_3")] == [1, 0, 1]
    assert len(next(iter(rows.values()))) == 29


def test_missing_values_survive_to_imputation(tables):
    dataset = build_model_dataset(build_modeling_frame(tables))
    x = split_features_target(dataset)
    assert x.where("avg_product_weight_g IS NULL").count() == 1
    assert x.count() == 3
    assert "order_id" not in x.columns and "is_late" in x.columns


def test_validate_no_leakage_raises_for_post_outcome_columns():
    validate_no_leakage(["customer_state", "total_price", "payment_type_mode"])
    with pytest.raises(ValueError):
        validate_no_leakage(["customer_state", "order_delivered_customer_date"])


def test_require_tables_names_all_missing(tables):
    with pytest.raises(KeyError, match="order_items, products"):
        require_tables({"orders": 1}, ["orders", "products", "order_items"])


def test_chronological_split_keeps_time_order(tables):
    dataset = build_model_dataset(build_modeling_frame(tables))
    ranked = chronological_split(dataset, test_fraction=1 / 3).collect()
    train = sorted((r for r in ranked if not r["is_test"]), key=lambda r: r["rank"])
    test = [r for r in ranked if r["is_test"]]
    assert len(train) == 2 and len(test) == 1
    assert max(r["order_purchase_timestamp"] for r in train) <= min(r["order_purchase_timestamp"] for r in test)
    assert test[0]["order_id"] == "order_3"


def test_sql_route_over_registered_views(spark, tables):
    from shipwise.sources.readers import register_views

    dataset = build_model_dataset(build_modeling_frame(tables))
    register_views(tables, {"model_dataset": dataset})
    rows = spark.sql(
        "SELECT customer_state, COUNT(*) AS orders, AVG(is_late) AS late_rate FROM model_dataset "
        "WHERE customer_state IS NOT NULL GROUP BY customer_state"
    ).collect()
    assert {r["customer_state"]: r["late_rate"] for r in rows} == {"SP": 0.0, "RJ": 1.0, "PR": 1.0}
    assert spark.sql("SELECT COUNT(*) FROM order_items").first()[0] == 3


def test_missing_source_files_are_named_once_sorted(spark):
    import tempfile

    from shipwise.sources.contracts import list_expected_files, require_files

    d = tempfile.mkdtemp(prefix="shipwise-empty-")
    with pytest.raises(FileNotFoundError) as err:
        require_files(spark, d)
    assert ", ".join(sorted(list_expected_files())) in str(err.value)


def test_missing_modeling_columns_are_named(tables):
    frame = build_modeling_frame(tables).drop("customer_state", "order_status")
    with pytest.raises(KeyError, match="customer_state, order_status"):
        build_model_dataset(frame)
