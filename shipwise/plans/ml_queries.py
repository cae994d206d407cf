"""Registered queries: preprocessing, models, tuning, calibration, importance (build steps 8-10).

Model queries run at the reference's sizes: ``JobConfig()`` for the search,
folds and repeats, ``models.DEFAULTS`` for single fits. Learned scores have no
SQL counterpart: they get a rows-only check.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..ml import models as MD
from ..ml.calibration import calibration_summary as calib_op
from ..ml.calibration import fit_calibrated, platt_rows
from ..ml.importance import permutation_importance as perm_op
from ..ml.job import JobConfig, run_training, scored_for_metrics
from ..session import materialize
from ..ml.preprocess import ModeImputer, OrdinalMapper, median_table, mode_table, one_hot_stages
from ..ml.tuning import cv_results, json_text, min_rank, summarize_tuning_results, tune_model
from ..operators import ordering as O
from ..operators.features import CATEGORICAL_FEATURES, FEATURES, NUMERIC_FEATURES
from ..operators.metrics import metric_bundle
from .cohort_queries import CATEGORY_CTE, _category_stats, pct_ctes
from .context import Ctx
from .oracle import mode_cte, statement
from .ordering_queries import RANKED_CTE, TEST_FRACTION
from .registry import query

JOB = JobConfig()


def _split(ctx: Ctx, for_fitting: bool = False):
    """Train / test sides of the chronological split. For model fits, which
    scan them many times, the ranked rows are checkpointed once into the shared
    checkpoint folder, in parts of equal rows; one-pass queries keep the plan lazy."""
    ranked = O.chronological_split(
        ctx.dataset, TEST_FRACTION, materialize_input=for_fitting, part_rows=MD.SCORE_PART_ROWS if for_fitting else None
    )
    if for_fitting:
        ranked = materialize(ranked)
    return ranked.where(~F.col("is_test")), ranked.where(F.col("is_test"))


TRAIN_CTE = RANKED_CTE + ",\ntrain AS (SELECT * FROM split WHERE NOT is_test),\ntest AS (SELECT * FROM split WHERE is_test)"

NUM_UNPIVOT = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC_FEATURES)
MEDIAN_CTE = (
    TRAIN_CTE
    + f""",
num_long AS (UNPIVOT (SELECT {NUM_UNPIVOT} FROM train) ON {", ".join(NUMERIC_FEATURES)} INTO NAME "column" VALUE x),
"""
    + pct_ctes("med", "num_long", "x", ['"column"'], [0.5])
)


@query("median_impute", statement('SELECT "column", val AS median FROM med', ["median"], ctes=MEDIAN_CTE))
def median_impute(ctx: Ctx):
    train, _ = _split(ctx, for_fitting=True)
    return median_table(train, NUMERIC_FEATURES)


CAT_LONG = f"""cat_long AS (UNPIVOT (SELECT {", ".join(CATEGORICAL_FEATURES)} FROM train)
  ON {", ".join(CATEGORICAL_FEATURES)} INTO NAME "column" VALUE x)"""
MODE_CTE = TRAIN_CTE + ",\n" + CAT_LONG + ",\n" + mode_cte("cat_mode", 'SELECT "column", x FROM cat_long', '"column"', "x")


@query("mode_impute", statement('SELECT "column", mode_value AS mode FROM cat_mode', ctes=MODE_CTE))
def mode_impute(ctx: Ctx):
    train, _ = _split(ctx)
    return mode_table(train, CATEGORICAL_FEATURES)


def _code_sql(col: str) -> str:
    """Ordinal code of the mode-imputed test value among the train labels, -1 if unseen."""
    filled = f"COALESCE(t.{col}, (SELECT mode_value FROM cat_mode WHERE \"column\" = '{col}'))"
    labels = f"(SELECT DISTINCT x FROM cat_long WHERE \"column\" = '{col}')"
    return f"""CASE WHEN {filled} IN {labels}
    THEN CAST((SELECT COUNT(*) FROM {labels} l WHERE l.x < {filled}) AS DOUBLE) ELSE -1.0 END"""


@query(
    "ordinal_encode",
    statement(
        "SELECT t.order_id, "
        + ", ".join(f"{_code_sql(c)} AS {c}_ord" for c in CATEGORICAL_FEATURES)
        + " FROM test t",
        [f"{c}_ord" for c in CATEGORICAL_FEATURES],
        ctes=MODE_CTE,
    ),
)
def ordinal_encode(ctx: Ctx):
    train, test = _split(ctx, for_fitting=True)
    imputer = ModeImputer(CATEGORICAL_FEATURES).fit(train)
    mapper = OrdinalMapper(CATEGORICAL_FEATURES).fit(imputer.transform(train))
    return mapper.transform(imputer.transform(test)).select("order_id", *[f"{c}_ord" for c in CATEGORICAL_FEATURES])


@query(
    "one_hot_encode",
    statement(
        "SELECT t.order_id, "
        + ", ".join(
            f"CAST({_code_sql(c)} AS INTEGER) AS {c}_slot, "
            f"(SELECT COUNT(DISTINCT x) FROM cat_long WHERE \"column\" = '{c}') AS {c}_size"
            for c in CATEGORICAL_FEATURES
        )
        + " FROM test t",
        ctes=MODE_CTE,
    ),
)
def one_hot_encode(ctx: Ctx):
    from pyspark.ml import Pipeline

    train, test = _split(ctx, for_fitting=True)
    pipe = Pipeline(stages=[ModeImputer(CATEGORICAL_FEATURES), *one_hot_stages()]).fit(train)
    out = pipe.transform(test)
    cols = []
    for c in CATEGORICAL_FEATURES:
        arr = vector_to_array(f"{c}_ohe")
        cols.append((F.array_position(arr, 1.0).cast("int") - 1).alias(f"{c}_slot"))
        cols.append(F.size(arr).cast("long").alias(f"{c}_size"))
    return out.select("order_id", *cols)


@query(
    "class_weights",
    statement(
        """SELECT is_late, COUNT(*) AS rows,
  (SELECT COUNT(*) FROM train) / (2.0 * COUNT(*)) AS class_weight FROM train GROUP BY is_late""",
        ["class_weight"],
        ctes=TRAIN_CTE,
    ),
)
def class_weights(ctx: Ctx):
    train, _ = _split(ctx)
    return MD.with_class_weights(train).groupBy("is_late").agg(
        F.count(F.lit(1)).alias("rows"), F.first("class_weight").alias("class_weight")
    )


@query(
    "prior_baseline",
    statement(
        "SELECT order_id, is_late, (SELECT AVG(is_late) FROM train) AS p FROM test",
        ["p"],
        ctes=TRAIN_CTE,
    ),
)
def prior_baseline(ctx: Ctx):
    train, test = _split(ctx)
    return MD.fit_model("dummy_baseline", train).score(test).select("order_id", "is_late", "p")


@query("random_forest_scores")
def random_forest_scores(ctx: Ctx):
    train, test = _split(ctx, for_fitting=True)
    return MD.fit_model("random_forest", train).score(test).select("order_id", "is_late", "p")


@query("gbt_scores")
def gbt_scores(ctx: Ctx):
    train, test = _split(ctx, for_fitting=True)
    return MD.fit_model("hist_gradient_boosting", train).score(test).select("order_id", "is_late", "p")


@query("tuning_summary")
def tuning_summary(ctx: Ctx):
    train, _ = _split(ctx, for_fitting=True)
    n_train = train.count()
    _, summary = tune_model(
        ctx.spark, "random_forest", train, n_train, MD.FOREST_SPACE, JOB.n_iter, JOB.n_splits, JOB.seed, JOB.parallelism
    )
    return summary


@query("calibration_summary")
def calibration_summary(ctx: Ctx):
    train, test = _split(ctx, for_fitting=True)
    n_train = train.count()
    fitted = MD.fit_model("hist_gradient_boosting", train)
    ens = fit_calibrated("hist_gradient_boosting", fitted.params, train, n_train, JOB.n_splits, JOB.seed)
    return calib_op("hist_gradient_boosting", fitted, ens, test)


@query("permutation_importance")
def permutation_importance(ctx: Ctx):
    train, test = _split(ctx, for_fitting=True)
    fitted = MD.fit_model("random_forest", train)
    return perm_op(fitted, test, FEATURES, JOB.repeats, JOB.seed)


@query("model_comparison")
def model_comparison(ctx: Ctx):
    train, test = _split(ctx, for_fitting=True)
    rows = None
    for name in JOB.models:
        fitted = MD.fit_model(name, train)
        m = metric_bundle(materialize(scored_for_metrics(fitted, test))).select(F.lit(name).alias("model"), "*")
        rows = m if rows is None else rows.unionByName(m)
    return rows


@query("training_job")
def training_job(ctx: Ctx):
    results, _, _, _, _ = run_training(ctx.spark, ctx.tables, JOB)
    return results


@query(
    "min_rank_selection",
    statement(
        """SELECT primary_category, orders, late_rate, CAST(RANK() OVER (ORDER BY late_rate DESC) AS INTEGER) AS rank,
  RANK() OVER (ORDER BY late_rate DESC) = 1 AS selected FROM cat_stats""",
        ["late_rate"],
        ctes=CATEGORY_CTE,
    ),
)
def min_rank_selection(ctx: Ctx):
    ranked = min_rank(_category_stats(ctx).select("primary_category", "orders", "late_rate"), "late_rate")
    return ranked.withColumn("selected", F.col("rank") == 1)



# A tuning report from given fold scores: twelve settings, four folds, with
# scores taken from the orders instead of fitted models.
@query(
    "tuning_report",
    statement(
        """SELECT 'random_forest' AS model, CAST(rank() OVER (ORDER BY m DESC) AS INTEGER) AS cv_rank,
  m AS cv_mean_average_precision, s AS cv_std_average_precision, tm AS cv_mean_train_average_precision,
  ts AS cv_std_train_average_precision, params, rank() OVER (ORDER BY m DESC) = 1 AS selected
FROM (
  SELECT params, avg(test_ap) AS m, stddev_pop(test_ap) AS s, avg(train_ap) AS tm, stddev_pop(train_ap) AS ts
  FROM (
    SELECT '{"max_depth": ' || (order_id % 12) // 4 || ', "min_samples": ' || order_id % 4 || '}' AS params,
      round(avg(CAST(customer_id % 1000 AS DOUBLE)), 1) / 1000 AS test_ap, round(avg(CAST(customer_id % 500 AS DOUBLE)), 1) / 500 AS train_ap
    FROM v_orders GROUP BY params, (order_id // 12) % 4) f
  GROUP BY params) c""",
        ["cv_mean_average_precision", "cv_std_average_precision", "cv_mean_train_average_precision",
         "cv_std_train_average_precision"],
        dataset=False,
    ),
)
def tuning_report(ctx: Ctx):
    """Folds to ranked settings with their JSON text."""
    config, fold = F.col("order_id") % 12, F.floor(F.col("order_id") / 12) % 4
    scores = (
        ctx.tables["orders"]
        .groupBy(config.alias("config"), fold.alias("fold"))
        .agg(
            (F.round(F.avg((F.col("customer_id") % 1000).cast("double")), 1) / 1000).alias("test_ap"),
            (F.round(F.avg((F.col("customer_id") % 500).cast("double")), 1) / 500).alias("train_ap"),
        )
        .withColumn("params", json_text(F.create_map(
            F.lit("min_samples"), (F.col("config") % 4).cast("int"), F.lit("max_depth"), F.floor(F.col("config") / 4).cast("int"),
        )))
    )
    return summarize_tuning_results("random_forest", cv_results(scores))


LATEST_TENTH = 0.1


@query(
    "validation_flag",
    statement(
        f"""SELECT order_id, rank >= (SELECT MIN(rank) + (MAX(rank) - MIN(rank) + 1) * (1 - CAST({LATEST_TENTH} AS DOUBLE)) FROM train)
  AS is_validation FROM train""",
        ctes=TRAIN_CTE,
    ),
)
def validation_flag(ctx: Ctx):
    """M8: the latest tenth of the training rows, on which early stopping looks."""
    train, _ = _split(ctx)
    return MD.validation_flag(train, LATEST_TENTH).select("order_id", "is_validation")


# Scores that need no model, so that SQL can check what is made of them.
PLATT_CTE = TRAIN_CTE + """,
held AS (SELECT is_late, 1 - estimated_delivery_days / 40 AS margin FROM test),
held_t AS (
  SELECT margin, CASE WHEN is_late = 1 THEN ((SELECT SUM(is_late) FROM held) + 1) / CAST((SELECT SUM(is_late) FROM held) + 2 AS DOUBLE)
    ELSE 1 / CAST((SELECT COUNT(*) - SUM(is_late) FROM held) + 2 AS DOUBLE) END AS t FROM held)"""


@query(
    "platt_targets",
    statement(
        """SELECT margin, CAST(1 AS DOUBLE) AS target, t AS weight FROM held_t
UNION ALL SELECT margin, CAST(0 AS DOUBLE) AS target, 1 - t AS weight FROM held_t""",
        ["margin", "weight"],
        ctes=PLATT_CTE,
    ),
)
def platt_targets(ctx: Ctx):
    """The weighted rows of the sigmoid fit, with smoothed targets."""
    _, test = _split(ctx, for_fitting=True)
    held = test.withColumn("margin", 1 - F.col("estimated_delivery_days") / 40)
    return platt_rows(held).select("margin", F.col("_y").alias("target"), F.col("_w").alias("weight"))


SCORED_FEATURES = ["estimated_delivery_days", "total_freight_value", "customer_state"]
REPEATS, SHUFFLE_SEED = 10, 42


class WindowScore:
    """A fixed score in the place of a fitted model."""

    def score(self, df):
        late = F.greatest(F.lit(0.0), 1 - F.col("estimated_delivery_days") / 40)
        near = F.when(F.col("customer_state") == F.col("primary_seller_state"), 0.0).otherwise(0.25)
        return df.withColumn("p", late + F.coalesce("total_freight_value", F.lit(0.0)) / 1000 + near)


def _score_sql(est: str, freight: str, state: str) -> str:
    return f"""GREATEST(CAST(0 AS DOUBLE), 1 - {est} / 40) + COALESCE({freight}, CAST(0 AS DOUBLE)) / 1000
    + CASE WHEN {state} = t.primary_seller_state THEN CAST(0 AS DOUBLE) ELSE CAST(0.25 AS DOUBLE) END"""


def _given(col: str) -> str:
    return f"CASE WHEN s.f = '{col}' THEN d.{col} ELSE t.{col} END"


PERMUTED_CTE = TRAIN_CTE + f""",
placed AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY md5('{SHUFFLE_SEED}|' || order_id), order_id) - 1 AS pos, COUNT(*) OVER () AS n FROM test),
shifts AS (
  SELECT f, r, 1 + CAST('0x' || substr(md5('{SHUFFLE_SEED}|' || f || '|' || r), 1, 13) AS BIGINT) % ((SELECT COUNT(*) FROM test) - 1) AS s
  FROM unnest({SCORED_FEATURES}) a(f), range({REPEATS}) b(r)),
scores AS (
  SELECT s.f, s.r, t.is_late AS y, {_score_sql(*[_given(c) for c in SCORED_FEATURES])} AS p
  FROM placed t CROSS JOIN shifts s JOIN placed d ON d.pos = (t.pos + s.s) % t.n
  UNION ALL
  SELECT 'none' AS f, 0 AS r, t.is_late AS y, {_score_sql(*["t." + c for c in SCORED_FEATURES])} AS p FROM test t),
thr AS (SELECT f, r, p, SUM(y) AS tp, COUNT(*) AS c FROM scores GROUP BY f, r, p),
cum AS (
  SELECT f, r, tp, SUM(tp) OVER w AS ctp, SUM(c) OVER w AS cn FROM thr
  WINDOW w AS (PARTITION BY f, r ORDER BY p DESC ROWS UNBOUNDED PRECEDING)),
aps AS (SELECT f, r, SUM(tp * ctp / cn) / SUM(tp) AS ap FROM cum GROUP BY f, r)"""


@query(
    "permutation_fixed_score",
    statement(
        """SELECT f AS feature, AVG(base - ap) AS importance_mean, STDDEV_POP(base - ap) AS importance_std
FROM aps, (SELECT ap AS base FROM aps WHERE f = 'none') b WHERE f <> 'none' GROUP BY f""",
        ["importance_mean", "importance_std"],
        ctes=PERMUTED_CTE,
    ),
)
def permutation_fixed_score(ctx: Ctx):
    """M21 at the reference's ten repeats, on a score that needs no model."""
    _, test = _split(ctx, for_fitting=True)
    return perm_op(WindowScore(), test, SCORED_FEATURES, repeats=REPEATS, seed=SHUFFLE_SEED)
