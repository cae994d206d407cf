"""Calibrated scoring, permutation shifts and lifts on small frames."""

from __future__ import annotations

import math
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from shipwise.ml import importance as IM
from shipwise.ml import models as MD
from shipwise.ml.calibration import CalibratedEnsemble, SigmoidMap
from shipwise.ml.importance import permutation_importance, shift
from shipwise.operators.cohorts import rate_and_lift
from shipwise.operators.ordering import chronological_split


class Margin:
    """A member that overwrites its input column, as an imputer does."""

    def __init__(self, step: float):
        self.step = step

    def score(self, df):
        filled = df.withColumn("x", F.coalesce("x", F.lit(self.step)))
        return filled.withColumn("p", F.lit(0.5)).withColumn("margin", F.col("x"))


def test_calibrated_scores_keep_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(1, 0.0), (1, 2.0), (None, None), (None, 1.0)], "order_id long, x double")
    ensemble = CalibratedEnsemble([(Margin(1.0), SigmoidMap(1.0, 0.0)), (Margin(3.0), SigmoidMap(1.0, 0.0))])
    out = ensemble.score(df)
    assert out.columns == ["order_id", "x", "p"]
    sig = lambda v: 1 / (1 + math.exp(-v))
    got = sorted(((r["order_id"] is None, r["x"] is None, r["x"] or 0.0), r["p"]) for r in out.collect())
    assert [k for k, _ in got] == [(False, False, 0.0), (False, False, 2.0), (True, False, 1.0), (True, True, 0.0)]
    # each member sees the untouched null, not the value another one filled in
    want = [sig(0.0), sig(2.0), sig(1.0), (sig(1.0) + sig(3.0)) / 2]
    assert [p for _, p in got] == pytest.approx(want)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_shifts_never_give_a_row_its_own_value():
    assert shift(42, "x", 0, 0) == shift(42, "x", 0, 1) == 0
    for n in (2, 3, 10, 1000):
        assert all(1 <= shift(42, "x", r, n) < n for r in range(50))


class Copied:
    """Scores a row by the feature itself."""

    def score(self, df):
        return df.withColumn("p", F.coalesce("x", F.lit(0.0)))


def test_permuting_an_unused_feature_changes_nothing(spark):
    rows = [(i, int(i % 4 == 0), float(i % 4 == 0), "s" if i % 3 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "order_id long, is_late int, x double, state string")
    got = {r["feature"]: r for r in permutation_importance(Copied(), df, ["x", "state"], repeats=3).collect()}
    assert got["state"]["importance_mean"] == 0.0 and got["state"]["importance_std"] == 0.0
    assert got["x"]["importance_mean"] > 0.3


def test_base_rate_of_the_lift_counts_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), (None, 0), (None, 0)], "k string, is_late int")
    rows = rate_and_lift(df, "k").collect()
    assert [(r["k"], r["orders"], r["late_rate"], r["lift_vs_base"]) for r in rows] == [("a", 2, 0.5, 2.0)]


@pytest.mark.parametrize("name", ["random_forest", "hist_gradient_boosting"])
def test_copies_of_a_block_equal_joined_copies(spark, monkeypatch, name):
    columns = [f"CAST(CASE WHEN id % 11 <> {k} THEN id * {k + 3} % {5 + 3 * k} END AS DOUBLE) AS {c}" for k, c in enumerate(MD.FEATURES[:-3])]
    columns += [f"CASE WHEN id % 13 <> {k} THEN CAST(id * 5 % {4 + k} AS STRING) END AS {c}" for k, c in enumerate(MD.FEATURES[-3:])]
    rows = spark.range(330).selectExpr("CASE WHEN id % 50 <> 7 THEN id % 300 END AS order_id", "CAST(id * 7 % 10 < 3 AS INT) AS is_late", *columns)
    small = {"random_forest": {"model__n_estimators": 6}, "hist_gradient_boosting": {"model__max_iter": 6}}[name]
    fitted = MD.fit_model(name, rows, small)
    features = ["estimated_delivery_days", "customer_state", "item_count"]
    rows = rows.where("order_id IS NOT NULL").dropDuplicates(["order_id"])  # one order of positions for both
    monkeypatch.setattr(IM, "BLOCK_ROWS", 64)
    kinds = []
    for kind in ("_tree_copies", "_joined_copies"):
        monkeypatch.setattr(IM, kind, lambda *a, plain=getattr(IM, kind), kind=kind: kinds.append(kind) or plain(*a))
    blocks = {r["feature"]: r for r in permutation_importance(fitted, rows, features, repeats=3).collect()}
    any_score = SimpleNamespace(score=fitted.score)
    joined = {r["feature"]: r for r in permutation_importance(any_score, rows, features, repeats=3).collect()}
    assert kinds == ["_tree_copies", "_joined_copies"]
    assert set(blocks) == set(features)
    for f in features:
        assert blocks[f]["importance_mean"] == pytest.approx(joined[f]["importance_mean"], abs=1e-12)
        assert blocks[f]["importance_std"] == pytest.approx(joined[f]["importance_std"], abs=1e-12)


def test_every_time_window_is_dealt_over_all_parts(spark):
    """One task would score a whole fold otherwise."""
    df = spark.range(400).select(F.col("id").alias("order_id"), F.expr("timestamp_seconds(id div 3)").alias("order_purchase_timestamp"))
    plain = {r["order_id"]: (r["rank"], r["is_test"]) for r in chronological_split(df).collect()}
    dealt = chronological_split(df, part_rows=40)
    rows = dealt.withColumn("part", F.spark_partition_id()).collect()
    assert {r["order_id"]: (r["rank"], r["is_test"]) for r in rows} == plain and len(rows) == 400
    assert {r["part"] for r in rows} == set(range(10))
    assert len({r["part"] for r in rows if r["is_test"]}) >= 8
    assert len({r["part"] for r in rows if r["rank"] < 80}) >= 8
