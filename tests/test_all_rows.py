"""Models are fitted on all training rows, by whichever way these are held."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from shipwise.ml import growing as G
from shipwise.ml import importance as IM
from shipwise.ml import models as MD
from shipwise.ml import preprocess as P
from shipwise.ml import stored as S
from shipwise.ml.importance import permutation_importance
from shipwise.ml.tuning import tune_model
from shipwise.session import materialize

SMALL_FOREST = {"model__n_estimators": 5, "model__min_samples_leaf": 3}
SMALL_BOOSTER = {"model__max_iter": 12, "model__learning_rate": 0.3, "model__max_leaf_nodes": 7, "model__min_samples_leaf": 10}


def rows(spark, n):
    """Ranked rows with nulls, wide and narrow features, and a noisy label."""
    columns = [f"CASE WHEN id % 17 <> {k} THEN CAST(xxhash64(id, {k}) % {5 + 40 * k} AS DOUBLE) END AS {c}" for k, c in enumerate(MD.FEATURES[:-3])]
    columns += [f"CASE WHEN id % 13 <> {k} THEN CAST(xxhash64(id, {k}) % {3 + k} AS STRING) END AS {c}" for k, c in enumerate(MD.FEATURES[-3:])]
    late = f"CAST(xxhash64(id, 3) % 125 + xxhash64(id, 10) % 405 / 4 + xxhash64(id, 99) % 90 > 60 AS INT) AS {MD.LABEL}"
    return spark.range(n).selectExpr("id AS order_id", "id AS rank", late, *columns)


@pytest.fixture(scope="module")
def train(spark):
    return materialize(rows(spark, 3000))


def small_blocks(monkeypatch, block=700):
    monkeypatch.setattr(MD, "BLOCK_ROWS", block)


def test_every_training_row_is_prepared(spark):
    """More rows than any bound there was, each once and in order."""
    frame = rows(spark, 12_345)
    ready = MD.prepared(frame)
    assert ready.shape.rows == 12_345
    x, y = ready.local()
    want = [r[0] for r in frame.orderBy("rank").select(MD.LABEL).collect()]
    assert list(y) == want and ready.shape.late == sum(want)
    pdf = frame.orderBy("rank").toPandas()
    binned = ready.bins("random_forest").apply(ready.encoder.encode([pdf[c] for c in MD.FEATURES]))
    assert (ready.shape.unpacked(x) == binned).all()


def test_a_fit_weighs_the_rows_beyond_the_former_bounds(spark):
    """The label hangs on a feature that tells the classes apart only in rows which a sample of 10,000 would mostly leave out."""
    frame = rows(spark, 30_000).withColumn("item_count", F.when(F.col("rank") % 100 == 7, 50.0).otherwise(1.0)).withColumn(
        MD.LABEL, (F.col("rank") % 100 == 7).cast("int"))
    for name, params in (("random_forest", dict(SMALL_FOREST, model__min_samples_leaf=120, model__max_features=None)),
                         ("hist_gradient_boosting", dict(SMALL_BOOSTER, model__min_samples_leaf=120))):
        # 300 late rows in all, 100 in a third of them: a leaf of 120 late rows needs them all
        p = {r[MD.LABEL]: r["p"] for r in MD.fit_model(name, frame, params).score(frame).groupBy(MD.LABEL).agg(F.avg("p").alias("p")).collect()}
        assert p[1] > 0.9 and p[0] < 0.1


def fitted(spark, ready, name, params):
    return MD.fit_all(spark, [MD.Fit(name, 0, MD.settings(name, params), 3)], [ready])[0].model.trees


@pytest.mark.parametrize("features", ["sqrt", 0.5, None])
def test_a_forest_by_passes_is_the_one_of_a_task(spark, train, monkeypatch, features):
    small_blocks(monkeypatch)
    ready = MD.prepared(train)
    params = dict(SMALL_FOREST, model__max_features=features)
    whole = fitted(spark, ready, "random_forest", params)
    monkeypatch.setattr(G, "TASK_ROWS", 100)
    monkeypatch.setattr(G, "UNIT_ROWS", 300)
    monkeypatch.setattr(G, "WAVE_TREES", 3)
    monkeypatch.setattr(G, "PASS_CELLS", 20_000)
    passes = fitted(spark, ready, "random_forest", params)
    assert len(passes.left) == len(whole.left) and (passes.leaves() == whole.leaves()).all()
    x = np.ascontiguousarray(ready.shape.unpacked(ready.local()[0]), np.uint16)
    assert (passes.total(x) == whole.total(x)).all()


@pytest.mark.parametrize("stop", [10_000, 1_000])
def test_boosters_by_passes_are_those_of_a_task(spark, train, monkeypatch, stop):
    """With and without the latest tenth held out."""
    monkeypatch.setattr(G, "EARLY_STOPPING_ROWS", stop)
    small_blocks(monkeypatch)
    ready = [MD.prepared(train), MD.prepared(train.where("rank < 1800"))]
    fits = [MD.Fit("hist_gradient_boosting", d, MD.settings("hist_gradient_boosting", dict(SMALL_BOOSTER, model__max_leaf_nodes=n))) for d, n in ((0, 7), (1, 15), (0, 2))]
    whole = [m.model.trees for m in MD.fit_all(spark, fits, ready)]
    monkeypatch.setattr(G, "BOOSTER_ROWS", 100)
    monkeypatch.setattr(G, "STATE_TREES", 3)
    monkeypatch.setattr(G, "PASS_LEAVES", 2)
    for a, b in zip(whole, [m.model.trees for m in MD.fit_all(spark, fits, ready)], strict=True):
        assert a.start == pytest.approx(b.start, abs=1e-12)
        for c in ("roots", "feature", "cut", "left"):
            assert (getattr(a.trees, c) == getattr(b.trees, c)).all()
        assert np.allclose(a.trees.value, b.trees.value, rtol=1e-9, atol=1e-12)


def test_a_stored_forest_scores_as_one_that_is_sent(spark, train, monkeypatch):
    fit = lambda: MD.fit_model("random_forest", train, SMALL_FOREST)
    sent = fit()
    monkeypatch.setattr(MD, "MODEL_NODES", 0)
    monkeypatch.setattr(S, "CHUNK_NODES", 500)
    kept = fit()
    assert isinstance(kept.model, S.StoredForest)
    odd = train.withColumn("order_id", F.when(F.col("order_id") % 5 > 0, F.col("order_id") % 50))  # null and repeated ids
    got, want = (sorted((r["rank"], r["order_id"], r["p"], r["margin"]) for r in m.score(odd.where("order_id IS NOT NULL")).collect()) for m in (kept, sent))
    assert len(got) == 2400 and np.allclose(np.array(got), np.array(want), rtol=1e-12)
    assert kept.score(odd).columns == sent.score(odd).columns and kept.score(odd).count() == 3000
    monkeypatch.setattr(IM, "BLOCK_ROWS", 256)
    monkeypatch.setattr(S, "HELD_BLOCKS", 3)
    monkeypatch.setattr(S, "DEALT_BYTES", 1)
    features = ["estimated_delivery_days", "customer_state"]
    a, b = ({r["feature"]: r["importance_mean"] for r in permutation_importance(m, train, features, repeats=2).collect()} for m in (kept, sent))
    assert a == {f: pytest.approx(v, abs=1e-12) for f, v in b.items()}


def test_a_search_fits_and_scores_all_rows_of_its_windows(spark, train, monkeypatch):
    from shipwise.ml import tuning as TU

    seen = []
    plain = TU.average_precision_roc
    monkeypatch.setattr(TU, "average_precision_roc", lambda df, by: seen.append(
        {(r["config"], r["fold"], r["side"]): r["count"] for r in df.groupBy("config", "fold", "side").count().collect()}) or plain(df, by))
    for name, fixed in (("random_forest", {"model__n_estimators": 3}), ("hist_gradient_boosting", {"model__max_iter": 3})):
        folds = TU.walk_forward_data(train, 3000, 2)
        assert [f.ready.shape.rows for f in folds] == [1000, 2000]
        tune_model(spark, name, train, 3000, MD.SEARCH_SPACES[name], n_iter=2, n_splits=2, fixed=fixed, folds=folds)
        assert seen.pop() == {(c, f, s): n for c in range(2) for f in range(2) for s, n in (("test", 1000), ("train", 1000 * (f + 1)))}


def test_cuts_come_from_all_rows_on_both_paths(spark, train, monkeypatch):
    encoder = P.Encoder.fit(train)
    near = P.feature_cuts(train, encoder, 64)
    monkeypatch.setattr(P, "DRIVER_VALUES", 10)
    far = P.feature_cuts(train, encoder, 64)
    pdf = train.toPandas()
    x = encoder.encode([pdf[c] for c in MD.FEATURES])
    want = MD.Bins.fit(x, 0, 64).cuts
    for a, b, c in zip(near, far, want, strict=True):
        assert a.tolist() == b.tolist() == c.tolist()
