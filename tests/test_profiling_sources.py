from __future__ import annotations

import math
import tempfile
from pathlib import Path

import numpy as np
import pandas as pd
import pytest

from shipwise.ml.calibration import fit_sigmoid
from shipwise.operators import cohorts as C
from shipwise.operators import metrics as M
from shipwise.operators import profiling as P
from shipwise.sources.contracts import DECLARED_KEYS, SPECS_BY_NAME
from shipwise.sources.readers import read_csv_table


def test_csv_reader_normalises_null_tokens(spark):
    d = Path(tempfile.mkdtemp(prefix="shipwise-csv-"))
    (d / "p.csv").write_text(
        "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
        'o1,1,NA,2,10.5\no2,1,"credit, card",,\no3,1,null,1,3\n'
    )
    rows = read_csv_table(spark, str(d / "p.csv"), SPECS_BY_NAME["order_payments"].schema).orderBy("order_id").collect()
    assert rows[0]["payment_type"] is None and rows[0]["payment_value"] == 10.5
    assert rows[1]["payment_type"] == "credit, card" and rows[1]["payment_installments"] is None
    assert rows[2]["payment_type"] is None


def test_profiling_reports_on_fixture(tables):
    grain = {r["table"]: r for r in P.grain_report(tables, DECLARED_KEYS).collect()}
    assert grain["order_items"]["declared_key"] == "order_id + order_item_id"
    assert all(r["key_is_unique"] and r["rows"] == 3 for r in grain.values())
    joins = {r["join"]: r for r in P.join_report(tables).collect()}
    assert joins["orders -> order_items"]["unmatched_left_rows"] == 0
    assert joins["orders -> order_items"]["max_right_per_key"] == 1
    assert joins["order_items -> products"]["mean_right_per_key"] == 1.0
    miss = P.missingness_report(tables).collect()
    assert {r["column"] for r in miss} == {
        "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm", "product_photos_qty",
        "product_name_lenght", "product_description_lenght"}
    assert {r["missing_pct"] for r in miss} == {33.33}
    funnel = [r["n_orders"] for r in P.funnel(tables["orders"]).orderBy("stage").collect()]
    assert funnel == [3, 3, 3, 3, 3]


def test_window_quantiles_match_numpy_linear(spark):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"k": rng.integers(0, 4, 500).astype(str), "estimated_delivery_days": rng.integers(0, 40, 500) / 3})
    got = {r["k"]: r for r in C.window_quantiles(spark.createDataFrame(pdf), "k").collect()}
    for k, g in pdf.groupby("k"):
        v = g["estimated_delivery_days"].to_numpy()
        assert got[k]["median_window"] == pytest.approx(np.percentile(v, 50))
        assert got[k]["p25"] == pytest.approx(np.percentile(v, 25))
        assert got[k]["orders"] == len(v)


def test_quantile_bucket_matches_pandas_qcut(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"w": rng.integers(1, 50, 400).astype(float)})
    out = C.quantile_bucket(spark.createDataFrame(pdf), "w", C.WEIGHT_QUANTILES, C.WEIGHT_LABELS, "b").toPandas()
    ref = pd.qcut(pdf["w"], q=C.WEIGHT_QUANTILES, labels=C.WEIGHT_LABELS)
    got = out.sort_values("w", kind="stable")["b"].value_counts().sort_index()
    exp = ref.astype(str).value_counts().sort_index()
    assert got.to_dict() == exp.to_dict()


def test_average_precision_and_roc_match_brute_force(spark):
    rng = np.random.default_rng(11)
    y = rng.integers(0, 2, 300)
    p = np.round(rng.random(300), 1)  # many ties
    df = spark.createDataFrame(pd.DataFrame({"id": range(300), "y": y, "p": p}))
    got = M.average_precision_roc(df, buckets=4).first()
    # brute force: thresholds at distinct scores, descending
    ap = 0.0
    for s in sorted(set(p), reverse=True):
        sel = p >= s
        tp_s = ((p == s) & (y == 1)).sum()
        ap += tp_s / y.sum() * (y[sel].sum() / sel.sum())
    pos, neg = p[y == 1], p[y == 0]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert got["average_precision"] == pytest.approx(ap)
    assert got["roc_auc"] == pytest.approx(auc)


def test_sigmoid_calibration_recovers_coefficients(spark):
    rng = np.random.default_rng(5)
    m = rng.normal(size=20000)
    y = (rng.random(20000) < 1 / (1 + np.exp(-(2.0 * m - 1.0)))).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"margin": m, "is_late": y}))
    sig = fit_sigmoid(df)
    assert sig.a == pytest.approx(2.0, abs=0.15) and sig.b == pytest.approx(-1.0, abs=0.1)
    assert not math.isnan(sig.a)


def test_weighted_dispersion_population_form(spark):
    df = spark.createDataFrame([(0.1, 10), (0.3, 30)], "late_rate double, orders long")
    r = C.weighted_dispersion(df).first()
    m = (0.1 * 10 + 0.3 * 30) / 40
    sd = math.sqrt(((0.1 - m) ** 2 * 10 + (0.3 - m) ** 2 * 30) / 40)
    assert r["weighted_mean"] == pytest.approx(m) and r["weighted_std"] == pytest.approx(sd)
    assert r["min_rate"] == 0.1 and r["max_rate"] == 0.3
