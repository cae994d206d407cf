"""Invariants on the real test tables (sf0.001), as planned in SURVEY section 5."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from shipwise.ml.preprocess import ModeImputer, OrdinalMapper, one_hot_stages
from shipwise.operators import cohorts as C
from shipwise.operators import ordering as O
from shipwise.operators import profiling as P
from shipwise.operators.slices import slice_labels
from shipwise.plans.context import Ctx

SF = "/root/testdata/sf0.001"


def test_funnel_never_grows(spark):
    ctx = Ctx(spark, SF)
    n = [r["n_orders"] for r in P.funnel(ctx.tables["orders"]).orderBy("stage").collect()]
    assert all(a >= b for a, b in zip(n, n[1:]))
    assert n[-1] == ctx.dataset.count()


def test_split_and_folds_partition_the_rows(spark):
    ds = Ctx(spark, SF).dataset
    ranked = O.chronological_split(ds, 0.2, buckets=4)
    train, test = O.split_frames(ranked)
    n, n_train, n_test = ds.count(), train.count(), test.count()
    assert n_train + n_test == n and n_train == O.split_cut(n, 0.2)
    last_train = train.agg(F.max(F.struct(O.TS, O.KEY))).first()[0]
    first_test = test.agg(F.min(F.struct(O.TS, O.KEY))).first()[0]
    assert tuple(last_train) < tuple(first_test)
    folds = O.walk_forward_folds(train, n_train, 4)
    stats = {(r["fold"], r["role"]): r for r in folds.groupBy("fold", "role").agg(
        F.count(F.lit(1)).alias("n"), F.min("rank").alias("lo"), F.max("rank").alias("hi")).collect()}
    for i in range(4):
        tr, te = stats[(i, "train")], stats[(i, "test")]
        assert tr["hi"] < te["lo"]  # time-ordered, disjoint
        assert te["n"] == n_train // 5


def test_slices_of_one_dimension_sum_to_labelled_rows(spark):
    ds = Ctx(spark, SF).dataset
    scored = ds.select(F.col("order_id").alias("id"), F.col("is_late").alias("y"), F.lit(0.5).alias("p"),
                       "estimated_delivery_days", "customer_state", "payment_type_mode")
    sliced = slice_labels(scored)
    per_dim = {r["d"]: r["n"] for r in sliced.groupBy(F.split("slice", "=")[0].alias("d")).agg(
        F.count(F.lit(1)).alias("n")).collect()}
    assert per_dim["payment_type"] == scored.where("payment_type_mode IS NOT NULL").count()
    assert per_dim["delivery_window"] == scored.where("estimated_delivery_days >= 0").count()


def test_bucket_counts_sum_to_non_null_rows(spark):
    ds = Ctx(spark, SF).dataset
    b = C.quantile_bucket(ds.dropna(subset=["avg_product_weight_g"]), "avg_product_weight_g",
                          C.WEIGHT_QUANTILES, C.WEIGHT_LABELS, "wb")
    total = C.rate_by(b, "wb").agg(F.sum("orders")).first()[0]
    assert total == ds.where("avg_product_weight_g IS NOT NULL").count()


def test_unseen_category_is_zero_vector_and_minus_one(spark):
    train = spark.createDataFrame([("a",), ("b",), ("a",)], "customer_state string")
    test = spark.createDataFrame([("z",), ("b",)], "customer_state string")
    cols = ["customer_state"]
    imp = ModeImputer(cols).fit(train)
    ordm = OrdinalMapper(cols).fit(imp.transform(train))
    codes = [r[0] for r in ordm.transform(imp.transform(test)).select("customer_state_ord").collect()]
    assert codes == [-1.0, 1.0]
    from pyspark.ml import Pipeline

    pipe = Pipeline(stages=[ModeImputer(cols), *one_hot_stages(cols)]).fit(train)
    vecs = [r[0] for r in pipe.transform(test).select(vector_to_array("customer_state_ohe")).collect()]
    assert vecs == [[0.0, 0.0], [0.0, 1.0]]
