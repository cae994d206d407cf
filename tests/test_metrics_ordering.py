from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shipwise.ml.tuning import summarize_tuning_results
from shipwise.operators import metrics as M
from shipwise.operators import ordering as O
from shipwise.operators.slices import slice_audit


def scored(spark, ps, ys):
    return spark.createDataFrame([(i, y, p) for i, (p, y) in enumerate(zip(ps, ys))], "id long, y int, p double")


def test_average_precision_and_roc_with_ties(spark):
    df = scored(spark, [0.9, 0.8, 0.7, 0.7, 0.2, 0.1], [1, 0, 1, 0, 1, 0])
    r = M.average_precision_roc(df, buckets=3).first()
    assert r["average_precision"] == pytest.approx(0.70)
    assert r["roc_auc"] == pytest.approx(0.6111, abs=1e-4)


def test_f2_is_zero_without_positive_predictions(spark):
    df = scored(spark, [0.1, 0.2, 0.3], [1, 0, 1])
    r = M.confusion_metrics(df).first()
    assert r["f2_score"] == 0.0
    assert r["balanced_accuracy"] == pytest.approx(0.5)


def test_precision_at_k_breaks_ties_by_id(spark):
    df = scored(spark, [0.5, 0.5, 0.5, 0.1], [0, 1, 1, 1])
    assert M.precision_at_k(df, 2, buckets=2).first()[0] == pytest.approx(0.5)
    assert M.precision_at_k(df, 10).first()[0] == pytest.approx(0.75)


def test_slice_with_one_class_kept_and_small_slice_dropped(spark):
    rows = [(i, 0, 0.3, 5.0, "SP", "boleto") for i in range(30)]
    rows += [(100 + i, i % 2, 0.6, 25.0, "RJ", None) for i in range(29)]
    df = spark.createDataFrame(rows, "id long, y int, p double, estimated_delivery_days double, "
                                     "customer_state string, payment_type_mode string")
    out = {r["slice"]: r for r in slice_audit(df).collect()}
    assert out["payment_type=boleto"]["average_precision"] is None
    assert out["payment_type=boleto"]["n"] == 30
    assert "delivery_window=20-30d" not in out


def test_exact_rank_under_skew_matches_single_window(spark):
    n = 5000
    df = spark.range(n).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, F.lit("2018-01-01 00:00:00").cast("timestamp_ntz"))
        .otherwise(F.timestamp_seconds(F.lit(1514764800) + (F.col("id") * 7919) % 3000).cast("timestamp_ntz"))
        .alias("ts"),
    )
    r = O.exact_rank(df, "ts", "order_id", buckets=16)
    ref = df.withColumn("ref", F.row_number().over(Window.orderBy("ts", "order_id")) - 1)
    assert r.join(ref, "order_id").where(F.col("rank") != F.col("ref")).count() == 0
    cells, single = O.with_cells(df, O.ts_micros("ts"), F.col("order_id"), buckets=16)
    assert not single
    biggest = cells.groupBy("_b1", "_b2").count().agg(F.max("count")).first()[0]
    assert biggest < n / 3  # the hot timestamp (a third of the rows) is split


def test_walk_forward_fold_sizes_match_published_run():
    bounds = O.fold_bounds(77_176, 4)
    assert [b[0] for b in bounds] == [15_436, 30_871, 46_306, 61_741]
    assert all(b[2] - b[1] == 15_435 for b in bounds)
    assert O.split_cut(96_470, 0.2) == 77_176


def test_tuning_summary_ranks_flags_and_serialises(spark):
    cv = spark.createDataFrame(
        [(2, 0.10, 0.01, 0.11, 0.02, {"model__max_depth": 8}), (1, 0.20, 0.02, 0.22, 0.03, {"model__max_depth": 12})],
        "rank_test_score int, mean_test_score double, std_test_score double, mean_train_score double, "
        "std_train_score double, params map<string,int>",
    )
    first = summarize_tuning_results("random_forest", cv).first()
    assert first["cv_rank"] == 1 and first["selected"] is True
    assert first["params"] == '{"model__max_depth": 12}'


def test_exact_percentiles_match_builtin_under_skew(spark):
    from shipwise.operators.quantiles import exact_percentiles

    df = spark.range(3000).select(
        (F.col("id") % 3).alias("g"),
        F.when(F.col("id") % 4 == 0, F.lit(7.0)).otherwise((F.col("id") * 37 % 1001) / 10.0).alias("x"),
    )
    qs = [0.0, 0.2, 0.25, 0.5, 0.75, 1.0]
    got = {(r["g"], r["q"]): r["val"] for r in exact_percentiles(df, "x", qs, ["g"], buckets=8).collect()}
    ref = df.groupBy("g").agg(F.percentile("x", F.array(*[F.lit(q) for q in qs])).alias("v")).collect()
    for r in ref:
        for q, v in zip(qs, r["v"]):
            assert got[(r["g"], q)] == v


def test_exact_percentile_paths_agree(spark):
    from shipwise.operators.quantiles import exact_percentiles

    df = spark.range(2000).select((F.col("id") % 2).alias("g"), ((F.col("id") * 13) % 97 / 7.0).alias("x"))
    qs = [0.1, 0.5, 0.9]
    a = sorted((r["g"], r["q"], r["val"]) for r in exact_percentiles(df, "x", qs, ["g"]).collect())
    b = sorted((r["g"], r["q"], r["val"]) for r in exact_percentiles(df, "x", qs, ["g"], buckets=4).collect())
    assert a == b and len(a) == 6


def test_exact_rank_and_precision_at_k_with_string_ids(spark):
    df = spark.range(3000).select(
        F.sha1(F.col("id").cast("string")).alias("order_id"),
        F.when(F.col("id") % 2 == 0, F.lit("2018-01-01 00:00:00").cast("timestamp_ntz"))
        .otherwise(F.timestamp_seconds(F.lit(1514764800) + F.col("id") % 700).cast("timestamp_ntz")).alias("ts"),
        (F.col("id") % 3 == 0).cast("int").alias("y"),
        (F.col("id") % 10 / 10.0).alias("p"),
    )
    r = O.exact_rank(df, "ts", "order_id", buckets=8)
    ref = df.withColumn("ref", F.row_number().over(Window.orderBy("ts", "order_id")) - 1)
    assert r.join(ref, "order_id").where(F.col("rank") != F.col("ref")).count() == 0
    s = df.withColumnRenamed("order_id", "id")
    got = M.precision_at_k(s, 700, buckets=8).first()[0]
    top = s.orderBy(F.desc("p"), F.asc("id")).limit(700).agg(F.avg("y")).first()[0]
    assert got == pytest.approx(top)


def test_search_spaces_cover_both_tunable_models():
    from shipwise.ml.models import build_search_spaces, sample_configs

    spaces = build_search_spaces()
    assert set(spaces) == {"random_forest", "hist_gradient_boosting"}
    assert "model__n_estimators" in spaces["random_forest"]
    assert "model__learning_rate" in spaces["hist_gradient_boosting"]
    draws = sample_configs(spaces["random_forest"], 12, seed=42)
    assert len(draws) == 12 and len({tuple(sorted(d.items(), key=str)) for d in draws}) == 12


def test_too_many_folds_raise():
    with pytest.raises(ValueError):
        O.fold_bounds(4, 4)


@pytest.mark.parametrize("groups", [["g"], []])
def test_ranges_of_scores_give_the_single_cell_metrics(spark, monkeypatch, groups):
    """Groups of other sizes and scores, a null group, a score shared by many rows: one shuffle of the rows."""
    rows = [(None if i % 10 == 9 else "ab"[i % 10 < 3], int(i * 7 % 10 < 3), 0.5 if i % 3 == 0 else (i * 37 % 101) / (101 if i % 10 < 3 else 400)) for i in range(1200)]
    df = spark.createDataFrame(rows, "g string, y int, p double")
    single = {r[0]: r for r in M.average_precision_roc(df, groups).collect()}
    monkeypatch.setattr(M, "DEFAULT_ROWS_PER_CELL", 50)
    many = M.average_precision_roc(df, groups)
    got = {r[0]: r for r in many.collect()}
    if not groups:
        assert [tuple(r) for r in got.values()] == [pytest.approx(tuple(r)) for r in single.values()]
        return
    assert set(got) == set(single) == {"a", "b", None}
    for g in got:
        assert tuple(got[g])[1:] == pytest.approx(tuple(single[g])[1:])
    cells = M.threshold_table(df, groups)
    assert cells.count() == df.select("g", "p").distinct().count()
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan and "SortMergeJoin" not in plan
