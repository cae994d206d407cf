"""Time-cut encodings, distances, sketches, cohorts in one pass, fingerprints, string ranges."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from shipwise.operators import cohorts as C
from shipwise.operators import ordering as O
from shipwise.operators.distance import haversine_km, seller_customer_distance
from shipwise.operators.encodings import log_volume, target_encoding
from shipwise.operators.profiling import exact_duplicate_count, row_fingerprint
from shipwise.operators.sketches import merge_sketches, relative_error, sketch_by

KINDS = {
    "two long prefixes": lambda k: ("customer-north-" if k % 2 else "warehouse-south-") + f"{k:09d}",
    "one prefix": lambda k: f"a-very-long-shared-prefix/{k:012d}",
    "no prefix": lambda k: format(k * 2654435761 % (1 << 32), "08x"),
    "short and empty": lambda k: "" if k % 50 == 0 else "é" * (k % 7) + chr(97 + k % 26),
}


@pytest.mark.parametrize("kind", KINDS)
def test_string_ranks_are_exact_and_cells_bounded(spark, kind):
    values = [KINDS[kind](k) for k in range(3000)]
    random.Random(1).shuffle(values)
    df = spark.createDataFrame(list(enumerate(values)), "id long, s string").repartition(4)
    proxy = df.select("id", "s", O.sort_proxy(df, "s").alias("p")).collect()
    proxies = {r["s"]: r["p"] for r in proxy}
    ordered = sorted(proxies, key=str.encode)
    assert all(proxies[a] <= proxies[b] for a, b in zip(ordered, ordered[1:], strict=False))
    ranked = O.prefix_sums(df, [F.col("s").asc(), F.col("id").asc()], lead=lambda: O.sort_proxy(df, "s"),
                           tie=lambda: O.sort_proxy(df, "id"), values={"one": F.lit(1)}, inclusive=False, buckets=30)
    got = {r["id"]: r["cum_one"] for r in ranked.collect()}
    want = sorted(range(3000), key=lambda i: (values[i].encode(), i))
    assert [got[i] for i in want] == list(range(3000))
    cells, single = O.with_cells(df, lambda: O.sort_proxy(df, "s"), lambda: O.sort_proxy(df, "id"), buckets=30)
    largest = max(r["count"] for r in cells.groupBy("_b1", "_b2").count().collect())
    assert not single and largest <= 2 * 3000 / 30


def test_null_and_single_strings_have_proxies(spark):
    df = spark.createDataFrame([(None,), ("x",), ("x",)], "s string")
    assert {r["p"] for r in df.select(O.sort_proxy(df, "s").alias("p")).collect()} == {None, 1.0}
    none = df.where("s IS NULL")
    assert [r["p"] for r in none.select(O.sort_proxy(none, "s").alias("p")).collect()] == [None]


def test_encodings_learn_from_earlier_blocks_only(spark):
    rng = random.Random(3)
    rows = [(k, rng.choice(["a", "a", "a", "b", "c", None]), rng.randrange(2)) for k in range(240)]
    rows += [(240 + k, "new" if k == 0 else "a", 1) for k in range(10)]  # the test side
    df = spark.createDataFrame(rows, "rank long, cat string, is_late int")
    got = {r["rank"]: r for r in target_encoding(df, "cat", 240, blocks=6, smoothing=5.0, out="rate").collect()}
    volume = {r["rank"]: r["v"] for r in log_volume(df, "cat", 240, blocks=6, out="v").collect()}
    assert len(got) == len(volume) == 250
    for rank, cat, _ in rows:
        past = [r for r in rows if r[0] < 240 and r[0] // 40 < min(rank // 40, 6)]
        own = [r for r in past if r[1] == cat and cat is not None]
        if past:
            rate = sum(r[2] for r in past) / len(past)
            assert got[rank]["rate"] == pytest.approx((sum(r[2] for r in own) + 5 * rate) / (len(own) + 5))
        else:
            assert got[rank]["rate"] is None
        assert volume[rank] == (None if cat is None else pytest.approx(math.log1p(len(own))))
    changed = spark.createDataFrame([(r, c, 1 - y if r >= 120 else y) for r, c, y in rows], df.schema)
    later = {r["rank"]: r["rate"] for r in target_encoding(changed, "cat", 240, blocks=6, smoothing=5.0, out="rate").collect()}
    assert all(later[r] == got[r]["rate"] for r in range(160))  # up to the block of the change, nothing moves
    assert target_encoding(df.limit(0), "cat", 0).count() == 0


def test_distance_clips_places_and_averages_sellers(spark):
    geo = spark.createDataFrame([(1, -23.5, -46.6), (1, -23.7, -46.8), (1, 45.0, 9.0), (2, -22.9, -43.2), (3, 60.0, 0.0)],
                                "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double")
    customers = spark.createDataFrame([("c1", 1), ("c2", None)], "customer_id string, customer_zip_code_prefix int")
    sellers = spark.createDataFrame([("s1", 2), ("s2", 1), ("s3", 3)], "seller_id string, seller_zip_code_prefix int")
    orders = spark.createDataFrame([("o1", "c1"), ("o2", "c2"), ("o3", "c1"), ("o4", "c1")], "order_id string, customer_id string")
    items = spark.createDataFrame([("o1", "s1"), ("o1", "s1"), ("o1", "s2"), ("o2", "s1"), ("o3", "s3")], "order_id string, seller_id string")
    got = {r[0]: r[1] for r in seller_customer_distance(orders, items, customers, sellers, geo).collect()}
    one = spark.range(1).select(haversine_km(F.lit(-23.6), F.lit(-46.7), F.lit(-22.9), F.lit(-43.2))).first()[0]
    assert 360 < one < 370
    assert got == {"o1": pytest.approx(one / 2), "o2": None, "o3": None, "o4": None}


def test_sketches_merge_by_day(spark):
    rows = [(d, (d * 700 + k) % 9000) for d in range(10) for k in range(2000)]
    df = spark.createDataFrame(rows, "day int, v int").repartition(5)
    merged = merge_sketches(sketch_by(df, ["day"], "v"), [F.lit(1).alias("all")]).first()["distinct"]
    exact = len({v for _, v in rows})
    assert abs(merged - exact) <= 4 * relative_error() * exact
    assert merged == merge_sketches(sketch_by(df, [F.lit(1).alias("k")], "v"), ["k"]).first()["distinct"]


def test_fingerprints_tell_nulls_apart_and_collisions_do_not_count(spark, monkeypatch):
    rows = [(None, "a"), ("a", None), ("a", "b"), ("a", "b"), ("b", "a"), (None, None), (None, None), ("ab", "")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(row_fingerprint(df.columns).alias("f")).distinct().count() == 6
    assert exact_duplicate_count(df).first()["count"] == 2
    monkeypatch.setattr("shipwise.operators.profiling.row_fingerprint", lambda cols: F.struct(F.lit(1).alias("a")))
    assert exact_duplicate_count(df).first()["count"] == 2  # all rows collide
    assert exact_duplicate_count(df.limit(0)).first()["count"] == 0


def test_duplicates_shuffle_fingerprints_not_rows(spark):
    df = spark.createDataFrame([(k, "wide" * 50) for k in range(100)], "k long, wide string")
    plan = exact_duplicate_count(df)._jdf.queryExecution().optimizedPlan().toString()
    first = plan[plan.index("Aggregate [_fp") :]
    assert "Project [named_struct(" in first or "Project [struct(" in first


def test_cohorts_share_one_scan(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.createDataFrame([(k, k % 2, "s" if k % 3 else None) for k in range(60)], "k int, is_late int, state string").write.parquet(path)
    df = spark.read.parquet(path)
    got = C.cohort_tables(df, {"state": F.col("state"), "parity": F.col("k") % 2})
    rows = {(r["cohort"], r["bucket"]): (r["orders"], r["late_rate"], r["lift_vs_base"]) for r in got.collect()}
    state = C.rate_and_lift(df, "state").first()
    assert rows == {("state", "s"): (40, state["late_rate"], state["lift_vs_base"]), ("parity", "0"): (30, 0.0, 0.0), ("parity", "1"): (30, 1.0, 2.0)}
