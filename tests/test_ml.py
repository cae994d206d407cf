"""Model layer on the real sf0.01 tables (about 1,900 test orders) with tiny settings."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shipwise.ml import models as MD
from shipwise.ml.calibration import calibration_summary, fit_calibrated
from shipwise.ml.importance import permutation_importance
from shipwise.ml.tuning import tune_model
from shipwise.operators import ordering as O
from shipwise.operators.features import FEATURES
from shipwise.plans.context import Ctx
from shipwise.session import materialize

SMALL_FOREST = {"model__n_estimators": 10, "model__max_depth": 6, "model__min_samples_leaf": 2,
                "model__max_features": "sqrt"}


@pytest.fixture(scope="module")
def split(spark):
    ranked = materialize(O.chronological_split(Ctx(spark, "/root/testdata/sf0.01").dataset, 0.2))
    return ranked.where(~F.col("is_test")), ranked.where(F.col("is_test"))


def test_forest_scores_every_test_row(split):
    train, test = split
    scored = MD.fit_model("random_forest", train, SMALL_FOREST).score(test)
    stats = scored.agg(F.count(F.lit(1)).alias("n"), F.min("p").alias("lo"), F.max("p").alias("hi")).first()
    assert stats["n"] == test.count() and 0.0 <= stats["lo"] <= stats["hi"] <= 1.0


def test_prior_baseline_is_train_rate(split):
    train, test = split
    rate = train.agg(F.avg("is_late")).first()[0]
    ps = [r[0] for r in MD.fit_model("dummy_baseline", train).score(test).select("p").distinct().collect()]
    assert ps == [pytest.approx(rate)]


def test_walk_forward_tuning_ranks_and_flags(spark, split):
    train, _ = split
    best, summary = tune_model(spark, "random_forest", train, train.count(), MD.FOREST_SPACE, n_iter=2, n_splits=2,
                               fixed={"model__n_estimators": 10, "model__max_depth": 6})
    rows = summary.collect()
    assert len(rows) == 2 and rows[0]["cv_rank"] == 1 and rows[0]["selected"]
    assert rows[0]["cv_mean_average_precision"] >= rows[1]["cv_mean_average_precision"]
    assert best["model__n_estimators"] == 10 and rows[0]["params"].startswith("{")


def test_permutation_importance_finds_the_promise_window(split):
    train, test = split
    fitted = MD.fit_model("random_forest", train, SMALL_FOREST)
    imp = permutation_importance(fitted, test, FEATURES, repeats=2).orderBy(F.desc("importance_mean")).collect()
    assert len(imp) == len(FEATURES)
    assert imp[0]["feature"] == "estimated_delivery_days" and imp[0]["importance_mean"] > 0.05


def test_calibration_summary_has_both_variants(split):
    train, test = split
    params = {"model__max_iter": 5, "model__learning_rate": 0.1, "model__max_leaf_nodes": 15}
    fitted = MD.fit_model("hist_gradient_boosting", train, params)
    ens = fit_calibrated("hist_gradient_boosting", params, train, train.count(), n_splits=2)
    rows = {r["variant"]: r for r in calibration_summary("hist_gradient_boosting", fitted, ens, test).collect()}
    assert set(rows) == {"uncalibrated", "calibrated_sigmoid"}
    assert all(0.0 <= r["brier_score"] <= 1.0 for r in rows.values())
