"""The many-cell and distributed paths give the small paths' answers, nulls included."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from shipwise.operators import ordering as O
from shipwise.operators.metrics import precision_at_k
from shipwise.operators.quantiles import exact_percentiles
from shipwise.sources.contracts import SPECS_BY_NAME
from shipwise.sources.readers import malformed_cells, read_csv_table


@pytest.fixture(scope="module")
def rows(spark):
    data = [(None if i % 4 == 0 else i % 23, f"customer-order-{(i * 7919) % 500:05d}", None if i % 6 == 0 else "ab"[i % 2]) for i in range(500)]
    return spark.createDataFrame(data, "k int, id string, g string")


@pytest.mark.parametrize("buckets", [4, 64])
def test_rank_over_cells_equals_one_cell(rows, buckets):
    for part in ([], ["g"]):
        got = {r["id"]: r["rank"] for r in O.exact_rank(rows, "k", "id", partition=part, buckets=buckets).collect()}
        want = {r["id"]: r["rank"] for r in O.exact_rank(rows, "k", "id", partition=part, buckets=1).collect()}
        assert got == want and None not in got.values()


def test_null_keys_are_cut_like_a_hot_value(rows):
    nulls = rows.withColumn("k", F.lit(None).cast("int"))
    cells, _ = O.with_cells(nulls, lambda: O.sort_proxy(nulls, "k"), lambda: O.sort_proxy(nulls, "id"), buckets=10)
    assert max(r["count"] for r in cells.groupBy("_b1", "_b2").count().collect()) < 150


def test_prefixed_ids_are_cut(rows):
    cells, _ = O.with_cells(rows, lambda: O.sort_proxy(rows, "id"), buckets=10)
    assert max(r["count"] for r in cells.groupBy("_b1").count().collect()) < 100


def test_many_cut_points_are_quick():
    start = time.time()
    splits, hot = O._splits([float(i // 2) for i in range(65_536)])
    assert time.time() - start < 1 and len(hot) == 32_768 and len(splits) == 65_538


def test_percentiles_keep_the_null_group(rows):
    key = lambda r: (str(r["g"]), r["q"])
    small = exact_percentiles(rows, "k", [0.1, 0.5], ["g"], n_rows=500)
    large = exact_percentiles(rows, "k", [0.1, 0.5], ["g"], buckets=6)
    got = sorted(map(tuple, large.collect()), key=str)
    assert got == sorted(map(tuple, small.collect()), key=str) and len({key for key in got}) == 6


def test_stratified_holdout_without_a_shuffle_by_label(rows):
    split = O.stratified_holdout(rows, label="g", key="id", buckets=5)
    tested = {r["g"]: (r["n"], r["t"]) for r in split.groupBy("g").agg(F.count("*").alias("n"), F.sum(F.col("is_test").cast("int")).alias("t")).collect()}
    for n, t in tested.values():
        assert t == n - int(n * 0.8)
    assert None in tested


def test_precision_at_k_is_a_limit(spark):
    scored = spark.createDataFrame([(i, float(i % 50), i % 3 == 0) for i in range(300)], "id int, p double, y boolean").withColumn("y", F.col("y").cast("int"))
    top = sorted(((-(i % 50), i) for i in range(300)))[:20]
    assert precision_at_k(scored, 20).first()[0] == sum(i % 3 == 0 for _, i in top) / 20
    plan = precision_at_k(scored, 20)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Window" not in plan


def test_csv_is_bound_by_name(spark, tmp_path):
    (tmp_path / "items.csv").write_text(
        "freight_value,price,order_item_id,extra,order_id,product_id,seller_id,shipping_limit_date\n"
        "5.0,100.0,1,z,o1,p,s,2018-01-03 00:00:00\nNaN,NA,x,z,o2,p,s,\n"
    )
    schema = SPECS_BY_NAME["order_items"].schema
    got = {r["order_id"]: r for r in read_csv_table(spark, str(tmp_path / "items.csv"), schema).collect()}
    assert (got["o1"]["price"], got["o1"]["freight_value"], got["o1"]["order_item_id"]) == (100.0, 5.0, 1)
    assert got["o2"]["price"] is None and got["o2"]["freight_value"] is None and got["o2"]["order_item_id"] is None
    bad = {r["column"]: r["malformed"] for r in malformed_cells(spark, str(tmp_path / "items.csv"), schema).collect()}
    assert bad["order_item_id"] == 1 and sum(bad.values()) == 1
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_csv_table(spark, str(tmp_path / "items.csv"), schema, on_malformed="fail").collect()
    (tmp_path / "short.csv").write_text("order_id,price\no1,1\n")
    with pytest.raises(ValueError, match="lacks the columns"):
        read_csv_table(spark, str(tmp_path / "short.csv"), schema)


def test_json_text_keeps_separators_inside_values(spark):
    from shipwise.ml.tuning import json_text

    frame = spark.createDataFrame([({"b": 'x":y,"z', "a": "1"}, {"n": 2, "k": None})], "s map<string,string>, n map<string,int>")
    got = frame.select(json_text("s").alias("s"), json_text("n").alias("n")).first()
    assert got["s"] == '{"a": "1", "b": "x\\":y,\\"z"}' and got["n"].startswith('{"k": ') and got["n"].endswith('"n": 2}')


def test_any_leaf_count_is_a_limit_and_less_than_two_raises():
    """Leaf counts are limits of their own (they were mapped to depths before, and unknown ones raised)."""
    import numpy as np

    from shipwise.ml.trees import grow_booster

    rng = np.random.default_rng(0)
    bins, y = rng.integers(0, 50, (500, 3)).astype(np.uint16), rng.integers(0, 2, 500)
    for leaves in (2, 7, 31, 100):
        assert grow_booster(bins, y, np.ones(500), 3, 0.1, leaves, 1).trees.leaves().max() == leaves
    with pytest.raises(ValueError, match="2 leaves"):
        grow_booster(bins, y, np.ones(500), 3, 0.1, 1, 1)


def test_checkpoint_folder_is_required_on_a_cluster():
    from types import SimpleNamespace

    from shipwise.session import checkpoint_dir

    session = SimpleNamespace(
        sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"),
        conf=SimpleNamespace(get=lambda *_: None),
    )
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(session)
