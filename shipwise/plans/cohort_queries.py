"""Registered queries: exploratory rate tables and cohorts (build step 5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exprs as X
from ..operators import cohorts as C
from ..operators.quantiles import percentile_columns
from ..session import materialize
from .context import MIN_COHORT_ORDERS, MIN_CORRIDOR_ORDERS, MIN_MONTH_ORDERS, MIN_WEEK_ORDERS, Ctx
from .oracle import mode_cte, statement
from .registry import query


def r2(x: str) -> str:
    return f"round_even(({x}) * 100, 0) / 100"


def pct_ctes(name: str, src: str, value: str, groups: list[str], qs: list[float]) -> str:
    """Exact interpolated percentiles per group, with Spark's formula
    ``(hi - pos) * v_lo + (pos - lo) * v_hi`` at ``pos = (n - 1) * q``."""
    g = ", ".join(groups)
    on_a = " AND ".join([f"a.{c} IS NOT DISTINCT FROM p.{c}" for c in groups] + ["a.i = p.lo"])
    on_b = " AND ".join([f"b.{c} IS NOT DISTINCT FROM p.{c}" for c in groups] + ["b.i = p.hi"])
    qvals = ", ".join(f"(CAST({q} AS DOUBLE))" for q in qs)
    pg = ", ".join(f"p.{c}" for c in groups)
    return f"""{name}_r AS (
  SELECT {g}, {value} AS v,
    ROW_NUMBER() OVER (PARTITION BY {g} ORDER BY {value}) - 1 AS i,
    COUNT(*) OVER (PARTITION BY {g}) AS n
  FROM {src} WHERE {value} IS NOT NULL),
{name}_p AS (
  SELECT {g}, q, (n - 1) * q AS pos, FLOOR((n - 1) * q) AS lo, CEIL((n - 1) * q) AS hi
  FROM (SELECT DISTINCT {g}, n FROM {name}_r) d CROSS JOIN (VALUES {qvals}) t(q)),
{name} AS (
  SELECT {pg}, p.q,
    CASE WHEN p.lo = p.hi OR a.v = b.v THEN a.v ELSE (p.hi - p.pos) * a.v + (p.pos - p.lo) * b.v END AS val
  FROM {name}_p p JOIN {name}_r a ON {on_a} JOIN {name}_r b ON {on_b})"""


TIME_CTE = """timed AS (
  SELECT *, strftime(order_purchase_timestamp, '%Y-%m') AS year_month,
    strftime(order_purchase_timestamp, '%G-W%V') AS iso_year_week,
    dayname(order_purchase_timestamp) AS weekday,
    CAST(isodow(order_purchase_timestamp) - 1 AS INTEGER) AS weekday_index,
    CAST(hour(order_purchase_timestamp) AS INTEGER) AS hour
  FROM dataset WHERE order_purchase_timestamp IS NOT NULL)"""

BASE = "(SELECT AVG(is_late) FROM dataset)"


def rate_sql(src: str, key: str, having: str = "") -> str:
    keys = key
    nn = " AND ".join(f"{k.strip()} IS NOT NULL" for k in key.split(","))
    h = f" HAVING {having}" if having else ""
    return f"SELECT {keys}, COUNT(*) AS orders, AVG(is_late) AS late_rate FROM {src} WHERE {nn} GROUP BY {keys}{h}"


# ---------------------------------------------------------------- simple rate tables


@query("late_rate_payment", statement(rate_sql("dataset", "payment_type_mode"), ["late_rate"]))
def late_rate_payment(ctx: Ctx):
    return C.rate_by(ctx.dataset, "payment_type_mode")


@query(
    "late_rate_month",
    statement(rate_sql("timed", "year_month", f"COUNT(*) >= {MIN_MONTH_ORDERS}"), ["late_rate"], ctes=TIME_CTE),
)
def late_rate_month(ctx: Ctx):
    return C.min_volume(C.rate_by(C.with_time_labels(ctx.dataset), "year_month"), MIN_MONTH_ORDERS)


@query(
    "late_rate_iso_week",
    statement(rate_sql("timed", "iso_year_week", f"COUNT(*) >= {MIN_WEEK_ORDERS}"), ["late_rate"], ctes=TIME_CTE),
)
def late_rate_iso_week(ctx: Ctx):
    return C.min_volume(C.rate_by(C.with_time_labels(ctx.dataset), "iso_year_week"), MIN_WEEK_ORDERS)


@query(
    "late_rate_weekday",
    statement(
        """SELECT d.weekday_index, d.weekday, r.orders, r.late_rate
FROM (VALUES (0, 'Monday'), (1, 'Tuesday'), (2, 'Wednesday'), (3, 'Thursday'), (4, 'Friday'),
             (5, 'Saturday'), (6, 'Sunday')) d(weekday_index, weekday)
LEFT JOIN (SELECT weekday, COUNT(*) AS orders, AVG(is_late) AS late_rate FROM timed GROUP BY weekday) r
  ON d.weekday = r.weekday""",
        ["late_rate"],
        ctes=TIME_CTE,
    ),
)
def late_rate_weekday(ctx: Ctx):
    return C.weekday_rates(ctx.spark, ctx.dataset)


@query("late_rate_hour", statement(rate_sql("timed", "hour"), ["late_rate"], ctes=TIME_CTE))
def late_rate_hour(ctx: Ctx):
    return C.rate_by(C.with_time_labels(ctx.dataset), "hour")


@query(
    "window_quantiles_month",
    statement(
        f"""SELECT c.year_month, c.orders,
  MAX(CASE WHEN w.q = 0.5 THEN w.val END) AS median_window,
  MAX(CASE WHEN w.q = 0.25 THEN w.val END) AS p25,
  MAX(CASE WHEN w.q = 0.75 THEN w.val END) AS p75
FROM (SELECT year_month, COUNT(*) AS orders FROM timed GROUP BY year_month HAVING COUNT(*) >= {MIN_MONTH_ORDERS}) c
JOIN wq w ON w.year_month = c.year_month
GROUP BY c.year_month, c.orders""",
        ["median_window", "p25", "p75"],
        ctes=TIME_CTE + ",\n" + pct_ctes("wq", "timed", "estimated_delivery_days", ["year_month"], [0.25, 0.5, 0.75]),
    ),
)
def window_quantiles_month(ctx: Ctx):
    # narrow input read by the count, the quantile and the volume jobs: write it once
    src = materialize(C.with_time_labels(ctx.dataset).select("year_month", "estimated_delivery_days"))
    wq = C.window_quantiles(src, "year_month")
    return C.min_volume(wq, MIN_MONTH_ORDERS)


def _box_sql(value: str, name: str) -> str:
    return statement(
        f"""SELECT k.is_late, k.n, k.q1, k.median, k.q3,
  MIN(CASE WHEN d.{value} BETWEEN k.lo AND k.hi THEN d.{value} END) AS whisker_low,
  MAX(CASE WHEN d.{value} BETWEEN k.lo AND k.hi THEN d.{value} END) AS whisker_high,
  CAST(SUM(CASE WHEN d.{value} BETWEEN k.lo AND k.hi THEN 0 ELSE 1 END) AS BIGINT) AS outliers
FROM (
  SELECT b.is_late, n.n,
    MAX(CASE WHEN b.q = 0.25 THEN b.val END) AS q1, MAX(CASE WHEN b.q = 0.5 THEN b.val END) AS median,
    MAX(CASE WHEN b.q = 0.75 THEN b.val END) AS q3,
    MAX(CASE WHEN b.q = 0.25 THEN b.val END)
      - 1.5 * (MAX(CASE WHEN b.q = 0.75 THEN b.val END) - MAX(CASE WHEN b.q = 0.25 THEN b.val END)) AS lo,
    MAX(CASE WHEN b.q = 0.75 THEN b.val END)
      + 1.5 * (MAX(CASE WHEN b.q = 0.75 THEN b.val END) - MAX(CASE WHEN b.q = 0.25 THEN b.val END)) AS hi
  FROM {name} b JOIN (SELECT is_late, COUNT(*) AS n FROM dataset WHERE {value} IS NOT NULL GROUP BY is_late) n
    ON b.is_late = n.is_late
  GROUP BY b.is_late, n.n) k
JOIN dataset d ON d.is_late = k.is_late AND d.{value} IS NOT NULL
GROUP BY k.is_late, k.n, k.q1, k.median, k.q3""",
        ["q1", "median", "q3", "whisker_low", "whisker_high"],
        ctes=pct_ctes(name, "dataset", value, ["is_late"], [0.25, 0.5, 0.75]),
    )


def _box(ctx: Ctx, value: str):
    src = materialize(ctx.dataset.select("is_late", value))
    return C.box_stats(src, value)


@query("box_stats", _box_sql("estimated_delivery_days", "bq"))
def box_stats(ctx: Ctx):
    """Promised window by class (box-plot numbers)."""
    return _box(ctx, "estimated_delivery_days")


@query("box_stats_price", _box_sql("total_price", "bqp"))
def box_stats_price(ctx: Ctx):
    """Order value by class (box-plot numbers)."""
    return _box(ctx, "total_price")


# ---------------------------------------------------------------- corridors

CORRIDOR_CTE = """corr AS (
  SELECT primary_seller_state, customer_state, COUNT(*) AS orders, AVG(is_late) AS late_rate,
    primary_seller_state = customer_state AS is_same_state
  FROM dataset WHERE primary_seller_state IS NOT NULL AND customer_state IS NOT NULL
  GROUP BY primary_seller_state, customer_state),
top_rows AS (
  SELECT primary_seller_state FROM corr GROUP BY primary_seller_state
  ORDER BY SUM(orders) DESC, primary_seller_state LIMIT 12),
top_cols AS (
  SELECT customer_state FROM corr GROUP BY customer_state ORDER BY SUM(orders) DESC, customer_state LIMIT 15)"""


@query("corridor_stats", statement("SELECT * FROM corr", ["late_rate"], ctes=CORRIDOR_CTE))
def corridor_stats(ctx: Ctx):
    return C.corridor_stats(ctx.dataset)


# The states of the test tables; the pivots list them all, so their columns
# never depend on the data.
STATES = [f"NATION_{i}" for i in range(25)]


def _pivot_sql(cell: str) -> str:
    cells = ",\n  ".join(f"{cell.format(state=s)} AS {s}" for s in STATES)
    return f"""SELECT primary_seller_state,
  {cells}
FROM corr WHERE primary_seller_state IN (SELECT * FROM top_rows) GROUP BY primary_seller_state"""


def _pivot_inputs(ctx: Ctx):
    # the corridor table (one row per state pair) feeds two jobs: write it once
    corr = materialize(C.corridor_stats(ctx.dataset))
    return corr, C.corridor_axis_top(corr, "primary_seller_state", 12), STATES


@query(
    "corridor_pivot_rate",
    statement(
        _pivot_sql("MAX(CASE WHEN customer_state = '{state}' AND orders >= " + str(MIN_CORRIDOR_ORDERS) + " THEN late_rate END)"),
        STATES,
        ctes=CORRIDOR_CTE,
    ),
)
def corridor_pivot_rate(ctx: Ctx):
    corr, rows, cols = _pivot_inputs(ctx)
    return C.corridor_pivot(corr, "late_rate", rows, cols, min_orders=MIN_CORRIDOR_ORDERS)


@query(
    "corridor_pivot_orders",
    statement(
        _pivot_sql("COALESCE(MAX(CASE WHEN customer_state = '{state}' THEN orders END), 0)"),
        ctes=CORRIDOR_CTE,
    ),
)
def corridor_pivot_orders(ctx: Ctx):
    corr, rows, cols = _pivot_inputs(ctx)
    return C.corridor_pivot(corr, "orders", rows, cols, fill=0)


VIABLE = f"""viable AS (
  SELECT *, late_rate / {BASE} AS lift_vs_base FROM corr WHERE orders >= {MIN_CORRIDOR_ORDERS})"""


def _viable(ctx: Ctx):
    return C.min_volume(C.corridor_lift(ctx.dataset), MIN_CORRIDOR_ORDERS)


@query(
    "riskiest_corridors",
    statement(
        "SELECT * FROM viable ORDER BY late_rate DESC, primary_seller_state, customer_state LIMIT 15",
        ["late_rate", "lift_vs_base"],
        ctes=CORRIDOR_CTE + ",\n" + VIABLE,
    ),
)
def riskiest_corridors(ctx: Ctx):
    return C.top_by(_viable(ctx), "late_rate", 15, False, C.CORRIDOR_KEYS)


@query(
    "safest_corridors",
    statement(
        "SELECT * FROM viable ORDER BY late_rate, primary_seller_state, customer_state LIMIT 15",
        ["late_rate", "lift_vs_base"],
        ctes=CORRIDOR_CTE + ",\n" + VIABLE,
    ),
)
def safest_corridors(ctx: Ctx):
    return C.top_by(_viable(ctx), "late_rate", 15, True, C.CORRIDOR_KEYS)


@query(
    "largest_corridors",
    statement(
        "SELECT * FROM corr ORDER BY orders DESC, primary_seller_state, customer_state LIMIT 10",
        ["late_rate"],
        ctes=CORRIDOR_CTE,
    ),
)
def largest_corridors(ctx: Ctx):
    return C.top_by(C.corridor_stats(ctx.dataset), "orders", 10, False, C.CORRIDOR_KEYS)


@query(
    "same_state_summary",
    statement(rate_sql("dataset", "seller_customer_same_state"), ["late_rate"]),
)
def same_state_summary(ctx: Ctx):
    return C.rate_by(ctx.dataset, "seller_customer_same_state")


@query(
    "interstate_dispersion",
    statement(
        """SELECT MIN(late_rate) AS min_rate, MAX(late_rate) AS max_rate, ANY_VALUE(m) AS weighted_mean,
  SQRT(SUM((late_rate - m) * (late_rate - m) * orders) / ANY_VALUE(w)) AS weighted_std
FROM (SELECT *, SUM(late_rate * orders) OVER () / SUM(orders) OVER () AS m, SUM(orders) OVER () AS w
      FROM viable WHERE NOT is_same_state) v""",
        ["min_rate", "max_rate", "weighted_mean", "weighted_std"],
        ctes=CORRIDOR_CTE + ",\n" + VIABLE,
    ),
)
def interstate_dispersion(ctx: Ctx):
    viable = C.min_volume(C.corridor_stats(ctx.dataset), MIN_CORRIDOR_ORDERS)
    return C.weighted_dispersion(viable.where(~F.col("is_same_state")))


# ---------------------------------------------------------------- cohorts

SELLER_COHORT_CTE = f"""{mode_cte("v_primary_seller", "SELECT order_id, seller_id FROM v_items", "order_id", "seller_id")},
v_seller_vol AS (SELECT seller_id, COUNT(DISTINCT order_id) AS seller_orders FROM v_items GROUP BY seller_id),
seller_cohort AS (
  SELECT d.*, ps.mode_value AS primary_seller_id, sv.seller_orders,
    GREATEST(1001, MAX(sv.seller_orders) OVER () + 1) AS top_edge
  FROM dataset d LEFT JOIN v_primary_seller ps ON d.order_id = ps.order_id
  LEFT JOIN v_seller_vol sv ON ps.mode_value = sv.seller_id),
seller_bucketed AS (
  SELECT *, CASE WHEN seller_orders >= 0 AND seller_orders <= 10 THEN '1-10'
    WHEN seller_orders > 10 AND seller_orders <= 50 THEN '11-50'
    WHEN seller_orders > 50 AND seller_orders <= 200 THEN '51-200'
    WHEN seller_orders > 200 AND seller_orders <= 1000 THEN '201-1000'
    WHEN seller_orders > 1000 AND seller_orders <= top_edge THEN '1000+' END AS seller_volume_bucket
  FROM seller_cohort)"""


def bucket_rate_sql(src: str, bucket: str, labels: list[str], extra: str = "") -> str:
    arr = ", ".join(f"'{x}'" for x in labels)
    return f"""SELECT {bucket}, COUNT(*) AS orders, AVG(is_late) AS late_rate{extra},
  CAST(list_position([{arr}], {bucket}) - 1 AS INTEGER) AS bucket_index,
  {r2(f'AVG(is_late) / {BASE}')} AS lift_vs_base
FROM {src} WHERE {bucket} IS NOT NULL GROUP BY {bucket}"""


@query(
    "seller_volume_cohort",
    statement(
        bucket_rate_sql("seller_bucketed", "seller_volume_bucket", C.SELLER_VOLUME_LABELS),
        ["late_rate", "lift_vs_base"],
        ctes=SELLER_COHORT_CTE,
    ),
)
def seller_volume_cohort(ctx: Ctx):
    # one row per dataset order: written once, then read by the edge, bucket and base-rate jobs
    narrow = materialize(C.seller_volume_frame(ctx.dataset, ctx.tables["order_items"]).select("is_late", "seller_orders"))
    cohort = C.with_seller_volume_bucket(narrow)
    return C.bucket_lift(cohort, "seller_volume_bucket", C.SELLER_VOLUME_LABELS)


ITEM_BUCKET_CTE = """item_bucketed AS (
  SELECT *, CASE WHEN item_count >= 0 AND item_count <= 1 THEN '1'
    WHEN item_count > 1 AND item_count <= 2 THEN '2'
    WHEN item_count > 2 AND item_count <= 4 THEN '3-4'
    WHEN item_count > 4 AND item_count <= 99 THEN '5+' END AS item_count_bucket
  FROM dataset)"""


@query(
    "item_count_cohort",
    statement(
        bucket_rate_sql("item_bucketed", "item_count_bucket", C.ITEM_COUNT_LABELS),
        ["late_rate", "lift_vs_base"],
        ctes=ITEM_BUCKET_CTE,
    ),
)
def item_count_cohort(ctx: Ctx):
    cohort = ctx.dataset.withColumn(
        "item_count_bucket", X.bucket_right_closed("item_count", C.ITEM_COUNT_EDGES, C.ITEM_COUNT_LABELS)
    )
    return C.bucket_lift(cohort, "item_count_bucket", C.ITEM_COUNT_LABELS)


WEIGHT_CTE = (
    "w_src AS (SELECT 1 AS g0, * FROM dataset WHERE avg_product_weight_g IS NOT NULL),\n"
    + pct_ctes("wq", "w_src", "avg_product_weight_g", ["g0"], C.WEIGHT_QUANTILES)
    + """,
w_edges AS (SELECT
    MAX(CASE WHEN q = 0.0 THEN val END) AS e0, MAX(CASE WHEN q = 0.2 THEN val END) AS e1,
    MAX(CASE WHEN q = 0.4 THEN val END) AS e2, MAX(CASE WHEN q = 0.6 THEN val END) AS e3,
    MAX(CASE WHEN q = 0.8 THEN val END) AS e4, MAX(CASE WHEN q = 1.0 THEN val END) AS e5 FROM wq),
weight_bucketed AS (
  SELECT s.*, CASE WHEN v >= e0 AND v <= e1 THEN 'q1 (lightest)' WHEN v > e1 AND v <= e2 THEN 'q2'
    WHEN v > e2 AND v <= e3 THEN 'q3' WHEN v > e3 AND v <= e4 THEN 'q4'
    WHEN v > e4 AND v <= e5 THEN 'q5 (heaviest)' END AS weight_bucket
  FROM (SELECT *, avg_product_weight_g AS v FROM w_src) s CROSS JOIN w_edges)"""
)
WEIGHT_CTE += ",\n" + pct_ctes("wm", "weight_bucketed", "avg_product_weight_g", ["weight_bucket"], [0.5])
WEIGHT_CTE += ",\nweight_medians AS (SELECT weight_bucket, val AS median_weight_g FROM wm)"


@query(
    "weight_quintile_cohort",
    statement(
        f"""SELECT b.*, m.median_weight_g FROM (
{bucket_rate_sql("weight_bucketed", "weight_bucket", C.WEIGHT_LABELS)}) b
JOIN weight_medians m ON b.weight_bucket = m.weight_bucket""",
        ["late_rate", "lift_vs_base", "median_weight_g"],
        ctes=WEIGHT_CTE,
    ),
)
def weight_quintile_cohort(ctx: Ctx):
    weight = materialize(ctx.dataset.dropna(subset=["avg_product_weight_g"]).select("is_late", "avg_product_weight_g"))
    cohort = C.quantile_bucket(weight, "avg_product_weight_g", C.WEIGHT_QUANTILES, C.WEIGHT_LABELS, "weight_bucket")
    stats = C.bucket_cohort(cohort, "weight_bucket", C.WEIGHT_LABELS)
    medians = percentile_columns(cohort, "avg_product_weight_g", {"median_weight_g": 0.5}, ["weight_bucket"])
    return C.with_lift(stats.join(medians, "weight_bucket", "left"), ctx.dataset)


CATEGORY_CTE = f"""{mode_cte("v_primary_cat", "SELECT order_id, product_category_name FROM v_items_x", "order_id",
                             "product_category_name")},
cat_cohort AS (
  SELECT d.*, c.mode_value AS primary_category FROM dataset d LEFT JOIN v_primary_cat c ON d.order_id = c.order_id),
cat_stats AS (
  SELECT primary_category, COUNT(*) AS orders, AVG(is_late) AS late_rate,
    {r2(f'AVG(is_late) / {BASE}')} AS lift_vs_base
  FROM cat_cohort WHERE primary_category IS NOT NULL GROUP BY primary_category)"""


def _category_stats(ctx: Ctx):
    items = ctx.tables["order_items"].select("order_id", "product_id").join(
        ctx.tables["products"].select("product_id", "product_category_name"), "product_id", "left"
    )
    primary = C.primary_values(items, "product_category_name", "primary_category")
    cohort = ctx.dataset.join(primary, "order_id", "left")
    return C.rate_and_lift(cohort, "primary_category")


@query("category_cohort", statement("SELECT * FROM cat_stats", ["late_rate", "lift_vs_base"], ctes=CATEGORY_CTE))
def category_cohort(ctx: Ctx):
    return _category_stats(ctx)


@query(
    "riskiest_categories",
    statement(
        f"SELECT * FROM cat_stats WHERE orders >= {MIN_COHORT_ORDERS} ORDER BY late_rate DESC, primary_category LIMIT 12",
        ["late_rate", "lift_vs_base"],
        ctes=CATEGORY_CTE,
    ),
)
def riskiest_categories(ctx: Ctx):
    viable = C.min_volume(_category_stats(ctx), MIN_COHORT_ORDERS)
    return C.top_by(viable, "late_rate", 12, False, ["primary_category"])


@query(
    "safest_categories",
    statement(
        f"SELECT * FROM cat_stats WHERE orders >= {MIN_COHORT_ORDERS} ORDER BY late_rate, primary_category LIMIT 12",
        ["late_rate", "lift_vs_base"],
        ctes=CATEGORY_CTE,
    ),
)
def safest_categories(ctx: Ctx):
    viable = C.min_volume(_category_stats(ctx), MIN_COHORT_ORDERS)
    return C.top_by(viable, "late_rate", 12, True, ["primary_category"])


METADATA_CTE = """meta AS (
  SELECT *, CASE WHEN missing_product_metadata_share IS NULL THEN 'no_items'
    WHEN missing_product_metadata_share = 0 THEN 'all_metadata_present'
    WHEN missing_product_metadata_share < 1 THEN 'partial' ELSE 'all_metadata_missing' END AS metadata_bucket
  FROM dataset)"""


@query(
    "metadata_cohort",
    statement(
        bucket_rate_sql("meta", "metadata_bucket", X.METADATA_BUCKETS),
        ["late_rate", "lift_vs_base"],
        ctes=METADATA_CTE,
    ),
)
def metadata_cohort(ctx: Ctx):
    cohort = ctx.dataset.withColumn("metadata_bucket", X.completeness_label("missing_product_metadata_share"))
    return C.bucket_lift(cohort, "metadata_bucket", X.METADATA_BUCKETS)
