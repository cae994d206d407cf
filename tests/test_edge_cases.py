"""Edge rows from FIXTURES.md section 4."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from shipwise.functions import exprs as X
from shipwise.operators import cohorts as C
from shipwise.operators.order_frame import build_modeling_frame, payment_aggregates


def test_mode_tie_goes_to_smallest_and_all_null_is_unknown(spark):
    pays = spark.createDataFrame(
        [("o1", 1, "b", 1, 1.0), ("o1", 2, "a", 1, 1.0), ("o1", 3, "b", 1, 1.0), ("o1", 4, "a", 1, 1.0),
         ("o2", 1, None, 1, None), ("o2", 2, None, 1, None)],
        "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double",
    )
    rows = {r["order_id"]: r for r in payment_aggregates(pays).collect()}
    assert rows["o1"]["payment_type_mode"] == "a"
    assert rows["o2"]["payment_type_mode"] == "unknown"
    assert rows["o2"]["payment_value"] == 0.0  # sum of all-null group is 0.0
    assert rows["o2"]["payment_type_count"] == 0


def test_order_without_items_and_unknown_product(spark, tables):
    t = dict(tables)
    t["orders"] = tables["orders"].unionByName(
        tables["orders"].where("order_id = 'order_1'").withColumn("order_id", F.lit("order_9"))
    )
    t["order_items"] = tables["order_items"].unionByName(
        tables["order_items"].where("order_id = 'order_1'").withColumn("order_id", F.lit("order_8"))
        .withColumn("product_id", F.lit("nope"))
    )
    t["orders"] = t["orders"].unionByName(
        tables["orders"].where("order_id = 'order_1'").withColumn("order_id", F.lit("order_8"))
    )
    rows = {r["order_id"]: r for r in build_modeling_frame(t).collect()}
    assert rows["order_9"]["item_count"] is None and rows["order_9"]["primary_seller_state"] is None
    assert rows["order_8"]["missing_product_metadata_share"] == 1.0
    meta = spark.createDataFrame([(None,), (0.0,), (0.5,), (1.0,)], "s double").select(
        X.completeness_label("s").alias("b")).collect()
    assert [r["b"] for r in meta] == ["no_items", "all_metadata_present", "partial", "all_metadata_missing"]


def test_partly_missing_product_and_zero_price(spark):
    df = spark.createDataFrame([(None, 2.0, 3.0, 0.0, 5.0)], "l double, h double, w double, price double, f double")
    r = df.select(X.product3("l", "h", "w").alias("v"), X.all_null(["l", "h"]).alias("flag"),
                  X.safe_ratio("f", "price").alias("ratio")).first()
    assert r["v"] is None and r["flag"] == 0 and r["ratio"] is None


def test_both_states_missing_compare_equal(spark):
    df = spark.createDataFrame([(None, None), ("SP", None), ("SP", "SP")], "a string, b string")
    assert [r[0] for r in df.select(X.null_safe_same("a", "b")).collect()] == [1, 0, 1]


def test_delivered_exactly_at_promise_is_not_late(spark):
    t = datetime(2018, 1, 10)
    df = spark.createDataFrame([(t, t)], "d timestamp_ntz, e timestamp_ntz")
    assert df.select((F.col("d") > F.col("e")).cast("int")).first()[0] == 0


def test_right_open_bucket_edges(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (10.0,), (20.0,), (30.0,), (None,)], "x double")
    got = [r[0] for r in df.select(
        X.bucket_right_open("x", C.DELIVERY_WINDOW_EDGES, C.DELIVERY_WINDOW_LABELS)).collect()]
    assert got == [None, "0-10d", "10-20d", "20-30d", "30d+", None]


def test_right_closed_bucket_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0, 10, 11, 50, 51, 1000, 1001)], "x long")
    got = [r[0] for r in df.select(
        X.bucket_right_closed("x", [*C.SELLER_VOLUME_EDGES, 2000], C.SELLER_VOLUME_LABELS)).collect()]
    assert got == ["1-10", "1-10", "11-50", "11-50", "51-200", "201-1000", "1000+"]
    items = spark.createDataFrame([(100,)], "x long").select(
        X.bucket_right_closed("x", C.ITEM_COUNT_EDGES, C.ITEM_COUNT_LABELS)).first()[0]
    assert items is None


def test_iso_week_label(spark):
    df = spark.createDataFrame([(datetime(2018, 12, 31, 12),)], "t timestamp_ntz")
    assert df.select(X.iso_year_week("t")).first()[0] == "2019-W01"


def test_round_half_even_like_numpy(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (2.5,)], "x double")
    assert [r[0] for r in df.select(X.round_half_even("x", 2)).collect()] == [0.12, 0.38, 2.5]


def test_null_safe_frame_matches_null_order_ids(spark, tables):
    t = dict(tables)
    t["orders"] = tables["orders"].withColumn(
        "order_id", F.when(F.col("order_id") == "order_3", F.lit(None)).otherwise(F.col("order_id")))
    t["order_items"] = tables["order_items"].withColumn(
        "order_id", F.when(F.col("order_id") == "order_3", F.lit(None)).otherwise(F.col("order_id")))
    plain = {r["order_id"]: r["item_count"] for r in build_modeling_frame(t).collect()}
    safe = {r["order_id"]: r["item_count"] for r in build_modeling_frame(t, null_safe=True).collect()}
    assert plain[None] is None and safe[None] == 1
    assert plain["order_1"] == safe["order_1"] == 1


def test_zero_denominators_give_null_not_errors(spark, tables):
    from shipwise.operators import profiling as P

    empty = tables["orders"].where(F.lit(False))
    assert [r["share_of_raw_pct"] for r in P.funnel(empty).collect()] == [None] * 5
    ds = spark.createDataFrame([("a", 0), ("b", 0)], "k string, is_late int")
    lifts = [r["lift_vs_base"] for r in C.with_lift(C.rate_by(ds, "k"), ds).collect()]
    assert lifts == [None, None]
