"""Registered queries: metrics on a deterministic score (build step 7).

The score ``greatest(0, 1 - estimated_delivery_days / 40)`` needs no model, so
every metric is checkable against plain SQL. It is computed on the test side
of the chronological split, as the reference evaluates its models.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators import ordering as O
from ..operators.slices import slice_audit as slice_audit_op
from ..session import materialize
from .context import MIN_SLICE_ROWS, Ctx
from .oracle import statement
from .ordering_queries import RANKED_CTE, TEST_FRACTION
from .registry import query

K = 500

SCORED_CTE = (
    RANKED_CTE
    + """,
scored AS (
  SELECT order_id AS id, is_late AS y, GREATEST(CAST(0 AS DOUBLE), 1 - estimated_delivery_days / 40) AS p,
    estimated_delivery_days, customer_state, payment_type_mode
  FROM split WHERE is_test),
thr AS (
  SELECT p, SUM(y) AS tp, COUNT(*) - SUM(y) AS fp FROM scored GROUP BY p),
cum AS (
  SELECT p, tp, fp, SUM(tp) OVER (ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS ctp,
    SUM(tp + fp) OVER (ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS cn FROM thr),
conf AS (
  SELECT COUNT(*) AS n, SUM(y) AS positives,
    SUM(CASE WHEN p > 0.5 AND y = 1 THEN 1 ELSE 0 END) AS tp,
    SUM(CASE WHEN p > 0.5 AND y = 0 THEN 1 ELSE 0 END) AS fp,
    SUM(CASE WHEN p <= 0.5 AND y = 1 THEN 1 ELSE 0 END) AS fn,
    SUM(CASE WHEN p <= 0.5 AND y = 0 THEN 1 ELSE 0 END) AS tn,
    AVG((p - y) * (p - y)) AS brier_score FROM scored)"""
)

AP_SQL = "SELECT CASE WHEN SUM(tp) > 0 THEN SUM(tp * ctp / cn) / SUM(tp) END AS average_precision FROM cum"
ROC_SQL = """SELECT CASE WHEN SUM(tp) > 0 AND SUM(fp) > 0
  THEN SUM(fp * ((ctp - tp) + tp / 2)) / (SUM(tp) * SUM(fp)) END AS roc_auc FROM cum"""
BA_SQL = """SELECT (COALESCE(tp / NULLIF(tp + fn, 0), 0) + COALESCE(tn / NULLIF(tn + fp, 0), 0))
  / ((tp + fn > 0)::INTEGER + (tn + fp > 0)::INTEGER) AS balanced_accuracy FROM conf"""
F2_SQL = "SELECT CASE WHEN 5 * tp + 4 * fn + fp > 0 THEN 5 * tp / (5 * tp + 4 * fn + fp) ELSE 0.0 END AS f2_score FROM conf"
PK_SQL = f"""SELECT AVG(y) AS precision_at_{K} FROM (
  SELECT y, ROW_NUMBER() OVER (ORDER BY p DESC, id) - 1 AS r FROM scored) t WHERE r < {K}"""


def scored(ctx: Ctx):
    """Scored test rows, written once: every metric family reads them again."""
    ranked = O.chronological_split(ctx.dataset, TEST_FRACTION)
    return materialize(ranked.where("is_test").select(
        F.col("order_id").alias("id"),
        F.col("is_late").alias("y"),
        F.greatest(F.lit(0.0), 1 - F.col("estimated_delivery_days") / 40).alias("p"),
        "estimated_delivery_days",
        "customer_state",
        "payment_type_mode",
    ))


@query("average_precision", statement(AP_SQL, ["average_precision"], ctes=SCORED_CTE))
def average_precision(ctx: Ctx):
    return M.average_precision_roc(scored(ctx)).select("average_precision")


@query("roc_auc", statement(ROC_SQL, ["roc_auc"], ctes=SCORED_CTE))
def roc_auc(ctx: Ctx):
    return M.average_precision_roc(scored(ctx)).select("roc_auc")


@query("balanced_accuracy", statement(BA_SQL, ["balanced_accuracy"], ctes=SCORED_CTE))
def balanced_accuracy(ctx: Ctx):
    return M.confusion_metrics(scored(ctx)).select("balanced_accuracy")


@query("f2_score", statement(F2_SQL, ["f2_score"], ctes=SCORED_CTE))
def f2_score(ctx: Ctx):
    return M.confusion_metrics(scored(ctx)).select("f2_score")


@query("precision_at_k", statement(PK_SQL, [f"precision_at_{K}"], ctes=SCORED_CTE))
def precision_at_k(ctx: Ctx):
    return M.precision_at_k(scored(ctx), K)


@query("brier_score", statement("SELECT brier_score FROM conf", ["brier_score"], ctes=SCORED_CTE))
def brier_score(ctx: Ctx):
    return M.confusion_metrics(scored(ctx)).select("brier_score")


@query(
    "metric_bundle",
    statement(
        f"""SELECT c.n, CAST(c.positives AS BIGINT) AS positives, a.average_precision, r.roc_auc, b.balanced_accuracy,
  f.f2_score, k.precision_at_{K}, c.brier_score
FROM conf c, ({AP_SQL}) a, ({ROC_SQL}) r, ({BA_SQL}) b, ({F2_SQL}) f, ({PK_SQL}) k""",
        ["average_precision", "roc_auc", "balanced_accuracy", "f2_score", f"precision_at_{K}", "brier_score"],
        ctes=SCORED_CTE,
    ),
)
def metric_bundle(ctx: Ctx):
    return M.metric_bundle(scored(ctx), k=K)


def r4(x: str) -> str:
    return f"round_even(({x}) * 10000, 0) / 10000"


SLICE_CTE = f""",
top_states AS (
  SELECT customer_state FROM scored WHERE customer_state IS NOT NULL
  GROUP BY customer_state ORDER BY COUNT(*) DESC, customer_state LIMIT 5),
sliced AS (
  SELECT 'delivery_window=' || CASE WHEN estimated_delivery_days >= 0 AND estimated_delivery_days < 10 THEN '0-10d'
      WHEN estimated_delivery_days >= 10 AND estimated_delivery_days < 20 THEN '10-20d'
      WHEN estimated_delivery_days >= 20 AND estimated_delivery_days < 30 THEN '20-30d'
      WHEN estimated_delivery_days >= 30 THEN '30d+' END AS slice, id, y, p
  FROM scored WHERE estimated_delivery_days >= 0
  UNION ALL
  SELECT 'customer_state=' || customer_state, id, y, p FROM scored WHERE customer_state IN (SELECT * FROM top_states)
  UNION ALL
  SELECT 'payment_type=' || payment_type_mode, id, y, p FROM scored WHERE payment_type_mode IS NOT NULL),
s_thr AS (SELECT slice, p, SUM(y) AS tp, COUNT(*) - SUM(y) AS fp FROM sliced GROUP BY slice, p),
s_cum AS (
  SELECT slice, tp, SUM(tp) OVER (PARTITION BY slice ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS ctp,
    SUM(tp + fp) OVER (PARTITION BY slice ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS cn FROM s_thr),
s_ap AS (SELECT slice, SUM(tp * ctp / cn) / SUM(tp) AS ap FROM s_cum GROUP BY slice HAVING SUM(tp) > 0)"""


@query(
    "slice_audit",
    statement(
        f"""SELECT s.slice, COUNT(*) AS n, {r4('AVG(s.y)')} AS late_rate,
  CASE WHEN SUM(s.y) = 0 OR SUM(s.y) = COUNT(*) THEN NULL ELSE {r4('ANY_VALUE(a.ap)')} END AS average_precision
FROM sliced s LEFT JOIN s_ap a ON s.slice = a.slice
GROUP BY s.slice HAVING COUNT(*) >= {MIN_SLICE_ROWS}""",
        ["late_rate", "average_precision"],
        ctes=SCORED_CTE + SLICE_CTE,
    ),
)
def slice_audit(ctx: Ctx):
    return slice_audit_op(scored(ctx), MIN_SLICE_ROWS)
