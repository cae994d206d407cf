"""Registered queries: chronological split, drift, folds, stratified holdout (build step 6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import cohorts as C
from ..operators import ordering as O
from ..operators.quantiles import percentile_columns
from ..session import materialize
from .context import MIN_MONTH_ORDERS, Ctx
from .oracle import statement
from .registry import query

TEST_FRACTION = 0.2
N_SPLITS = 4

RANKED_CTE = f"""ranked AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY order_purchase_timestamp, order_id) - 1 AS rank,
    FLOOR(CAST(COUNT(*) OVER () AS DOUBLE) * (1 - CAST({TEST_FRACTION} AS DOUBLE))) AS cut
  FROM dataset),
split AS (SELECT *, rank >= cut AS is_test FROM ranked)"""


@query(
    "chronological_split",
    statement("SELECT order_id, CAST(rank AS BIGINT) AS rank, is_test FROM split", ctes=RANKED_CTE),
)
def chronological_split(ctx: Ctx):
    return O.chronological_split(ctx.dataset, TEST_FRACTION).select("order_id", "rank", "is_test")


@query(
    "split_drift",
    statement(
        """SELECT s.is_test, COUNT(*) AS orders, AVG(is_late) AS late_rate,
  MIN(order_purchase_timestamp) AS start_ts, MAX(order_purchase_timestamp) AS end_ts,
  ANY_VALUE(h.holdout_month) AS holdout_month
FROM split s CROSS JOIN (SELECT strftime(MIN(order_purchase_timestamp), '%Y-%m') AS holdout_month
                         FROM split WHERE is_test) h
GROUP BY s.is_test""",
        ["late_rate"],
        ctes=RANKED_CTE,
    ),
)
def split_drift(ctx: Ctx):
    ranked = O.chronological_split(ctx.dataset, TEST_FRACTION)
    holdout = ranked.where("is_test").agg(X.year_month(F.min(O.TS)).alias("holdout_month"))
    sides = ranked.groupBy("is_test").agg(
        F.count(F.lit(1)).alias("orders"),
        F.avg("is_late").alias("late_rate"),
        F.min(O.TS).alias("start_ts"),
        F.max(O.TS).alias("end_ts"),
    )
    return C.with_scalar(sides, holdout)


@query(
    "holdout_month_flag",
    statement(
        f"""SELECT strftime(order_purchase_timestamp, '%Y-%m') AS year_month, COUNT(*) AS orders,
  AVG(is_late) AS late_rate,
  strftime(order_purchase_timestamp, '%Y-%m') = ANY_VALUE(h.holdout_month) AS is_holdout_month
FROM split CROSS JOIN (SELECT strftime(MIN(order_purchase_timestamp), '%Y-%m') AS holdout_month
                       FROM split WHERE is_test) h
GROUP BY 1 HAVING COUNT(*) >= {MIN_MONTH_ORDERS}""",
        ["late_rate"],
        ctes=RANKED_CTE,
    ),
)
def holdout_month_flag(ctx: Ctx):
    ranked = O.chronological_split(ctx.dataset, TEST_FRACTION)
    holdout = ranked.where("is_test").agg(X.year_month(F.min(O.TS)).alias("holdout_month"))
    monthly = C.min_volume(C.rate_by(C.with_time_labels(ctx.dataset), "year_month"), MIN_MONTH_ORDERS)
    return C.with_scalar(monthly, holdout).select(
        "year_month", "orders", "late_rate", (F.col("year_month") == F.col("holdout_month")).alias("is_holdout_month")
    )


def _fold_sql() -> str:
    parts = []
    # positions are computed from n_train in SQL the same way as on the driver
    for i in range(N_SPLITS):
        k = N_SPLITS - i
        start = f"(nt - {k} * (nt // {N_SPLITS + 1}))"
        end = f"(nt - {k - 1} * (nt // {N_SPLITS + 1}))"
        parts.append(
            f"""SELECT {i} AS fold, 'train' AS role, * FROM tr WHERE rank < {start}
UNION ALL SELECT {i}, 'test', * FROM tr WHERE rank >= {start} AND rank < {end}"""
        )
    union = "\nUNION ALL\n".join(parts)
    return f"""SELECT CAST(fold AS INTEGER) AS fold, role, COUNT(*) AS rows, AVG(is_late) AS late_rate,
  MIN(order_purchase_timestamp) AS start_ts, MAX(order_purchase_timestamp) AS end_ts
FROM (
{union}
) f GROUP BY fold, role"""


@query(
    "walk_forward_folds",
    statement(
        _fold_sql(),
        ["late_rate"],
        ctes=RANKED_CTE + ",\ntr AS (SELECT *, COUNT(*) OVER () AS nt FROM split WHERE NOT is_test)",
    ),
)
def walk_forward_folds(ctx: Ctx):
    ranked = O.chronological_split(ctx.dataset, TEST_FRACTION)
    train, _ = O.split_frames(ranked)
    n_train = train.count()
    folds = O.walk_forward_folds(train, n_train, N_SPLITS)
    return folds.groupBy("fold", "role").agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg("is_late").alias("late_rate"),
        F.min(O.TS).alias("start_ts"),
        F.max(O.TS).alias("end_ts"),
    )


@query(
    "stratified_holdout",
    statement(
        f"""SELECT order_id, is_late, r >= FLOOR(CAST(n AS DOUBLE) * (1 - CAST({TEST_FRACTION} AS DOUBLE))) AS is_test
FROM (SELECT order_id, is_late,
  ROW_NUMBER() OVER (PARTITION BY is_late ORDER BY md5(concat('42', CAST(order_id AS VARCHAR))), order_id) - 1 AS r,
  COUNT(*) OVER (PARTITION BY is_late) AS n FROM dataset) t""",
    ),
)
def stratified_holdout(ctx: Ctx):
    return O.stratified_holdout(ctx.dataset, test_fraction=TEST_FRACTION, seed=42).select(
        "order_id", "is_late", "is_test"
    )


@query(
    "rank_null_keys",
    statement(
        """SELECT order_id, order_status, row_number() OVER (
    PARTITION BY CASE WHEN order_id % 5 = 0 THEN NULL ELSE order_status END
    ORDER BY CASE WHEN order_id % 3 = 0 THEN NULL ELSE order_purchase_timestamp END NULLS FIRST, order_id) - 1 AS rank
FROM v_orders""",
        dataset=False,
    ),
)
def rank_null_keys(ctx: Ctx):
    """R1 over many cells with a third of the sort keys and a fifth of the partition keys null."""
    orders = ctx.tables["orders"].select(
        "order_id", "order_status",
        F.when(F.col("order_id") % 3 != 0, F.col("order_purchase_timestamp")).alias("ts"),
        F.when(F.col("order_id") % 5 != 0, F.col("order_status")).alias("status"),
    )
    ranked = O.exact_rank(materialize(orders), "ts", "order_id", partition=["status"], buckets=16)
    return ranked.select("order_id", "order_status", "rank")


@query(
    "percentiles_null_groups",
    statement(
        """SELECT seller_state, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS median,
  quantile_cont(price, 0.9) AS q90 FROM v_items JOIN v_sellers USING (seller_id) GROUP BY seller_state""",
        ["q1", "median", "q90"],
        dataset=False,
    ),
)
def percentiles_null_groups(ctx: Ctx):
    """Distributed exact percentiles of groups, one of which is the null group."""
    items = ctx.tables["order_items"].join(ctx.tables["sellers"], "seller_id").select("seller_state", "price")
    return percentile_columns(items, "price", {"q1": 0.25, "median": 0.5, "q90": 0.9}, ["seller_state"], buckets=12)
