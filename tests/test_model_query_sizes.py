"""The registered model queries ask for the whole job (nothing is fitted here)."""

from types import SimpleNamespace

import pytest

from shipwise.ml.job import JobConfig
from shipwise.ml.models import DEFAULTS, FOREST_SPACE
from shipwise.plans import ml_queries as Q


@pytest.fixture
def calls(monkeypatch):
    seen = []

    def fit(name, train, params=None, seed=42):
        seen.append(("fit", name, dict(DEFAULTS.get(name, {}), **(params or {}))))
        return SimpleNamespace(params=seen[-1][2], score=lambda df: SimpleNamespace(select=lambda *c: df))

    def note(kind, result=None):
        return lambda *a, **k: seen.append((kind, a, k)) or result

    side = SimpleNamespace(count=lambda: 100)
    monkeypatch.setattr(Q, "_split", lambda ctx, for_fitting=False: (side, side))
    monkeypatch.setattr(Q.MD, "fit_model", fit)
    for name, kind, result in [("tune_model", "tune", (None, None)), ("fit_calibrated", "calibrate", None), ("calib_op", "summary", None),
                               ("perm_op", "permute", None), ("run_training", "job", [None] * 5)]:
        monkeypatch.setattr(Q, name, note(kind, result))
    return seen


CTX = SimpleNamespace(spark=None, tables={})


def arguments(call, *names):
    """Positional and named arguments by name, after those of ``names``."""
    return {**dict(zip(names, call[1], strict=False)), **call[2]}


def test_tuning_searches_twelve_settings_on_four_folds(calls):
    Q.tuning_summary(CTX)
    got = arguments(calls[0], "spark", "name", "train", "n", "space", "n_iter", "n_splits")
    assert (got["n_iter"], got["n_splits"], got["space"]) == (12, 4, FOREST_SPACE) and not got.get("fixed")


def test_calibration_has_four_members_of_full_boosters(calls):
    Q.calibration_summary(CTX)
    got = arguments(next(c for c in calls if c[0] == "calibrate"), "name", "params", "train", "n", "n_splits")
    assert got["n_splits"] == 4 and got["params"] == DEFAULTS["hist_gradient_boosting"]


def test_permutations_are_repeated_ten_times(calls):
    Q.permutation_importance(CTX)
    assert calls[0] == ("fit", "random_forest", DEFAULTS["random_forest"])
    assert arguments(calls[1], "fitted", "test", "features", "repeats")["repeats"] == 10


@pytest.mark.parametrize(("query", "name"), [(Q.random_forest_scores, "random_forest"), (Q.gbt_scores, "hist_gradient_boosting")])
def test_scores_are_of_full_models(calls, query, name):
    query(CTX)
    assert calls == [("fit", name, DEFAULTS[name])]


def test_comparison_fits_full_models(calls, monkeypatch):
    rows = SimpleNamespace(select=lambda *c: rows, unionByName=lambda other: rows)
    monkeypatch.setattr(Q, "materialize", lambda df: df)
    monkeypatch.setattr(Q, "scored_for_metrics", lambda fitted, test: None)
    monkeypatch.setattr(Q, "metric_bundle", lambda df: rows)
    monkeypatch.setattr(Q.F, "lit", lambda x: SimpleNamespace(alias=lambda n: x))
    Q.model_comparison(CTX)
    assert [c[1:] for c in calls] == [(n, DEFAULTS.get(n, {})) for n in JobConfig().models]


def test_training_job_is_the_whole_job(calls):
    Q.training_job(CTX)
    assert arguments(calls[0], "spark", "tables", "cfg")["cfg"] == JobConfig()
