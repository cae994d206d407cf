"""Registered queries: the reference's planned features (X1, X2), sketches, all cohorts, and checks of the fits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import exprs as X
from ..functions.exprs import json_sorted
from ..ml import models as MD
from ..ml.calibration import fit_sigmoids
from ..ml.histograms import split_gains
from ..ml.tuning import cv_results, summarize_tuning_results
from ..operators import cohorts as C
from ..operators import ordering as O
from ..operators.distance import BRAZIL, EARTH_RADIUS_KM, seller_customer_distance
from ..operators.encodings import BLOCKS, SMOOTHING, log_volume, target_encoding
from ..operators.sketches import merge_sketches, relative_error, sketch_by
from ..session import materialize
from ..sources.star import GEO_VIEWS_SQL, geo_tables
from .cohort_queries import CATEGORY_CTE, SELLER_COHORT_CTE
from .context import Ctx
from .ml_queries import TRAIN_CTE
from .oracle import statement
from .ordering_queries import TEST_FRACTION
from .registry import query

# ---------------------------------------------------------------- X1: distance


def _half(a: str, b: str) -> str:
    return f"power(sin(radians({b} - {a}) / 2), 2)"


@query(
    "seller_customer_distance",
    statement(
        f"""SELECT order_id, round_even(avg({2 * EARTH_RADIUS_KM} * asin(CASE WHEN chord > 1 THEN 1 ELSE sqrt(chord) END)) * 1000, 0) / 1000
  AS seller_customer_km
FROM (
  SELECT o.order_id, {_half("c.lat", "s.lat")} + cos(radians(c.lat)) * cos(radians(s.lat)) * {_half("c.lng", "s.lng")} AS chord
  FROM v_orders o
  LEFT JOIN (SELECT customer_id, lat, lng FROM v_customer_zip LEFT JOIN places USING (prefix)) c ON o.customer_id = c.customer_id
  LEFT JOIN (SELECT DISTINCT order_id, seller_id FROM v_items) i ON o.order_id = i.order_id
  LEFT JOIN (SELECT seller_id, lat, lng FROM v_seller_zip LEFT JOIN places USING (prefix)) s ON i.seller_id = s.seller_id) pairs
GROUP BY order_id""",
        ctes=GEO_VIEWS_SQL + f""",
places AS (
  SELECT prefix, avg(lat) AS lat, avg(lng) AS lng FROM v_geolocation
  WHERE lat BETWEEN {BRAZIL[0]} AND {BRAZIL[1]} AND lng BETWEEN {BRAZIL[2]} AND {BRAZIL[3]} GROUP BY prefix)""",
        dataset=False,
        frame=False,
    ),
)
def distance_query(ctx: Ctx):
    """Mean great-circle distance between an order's customer and its sellers, in km to the metre."""
    geo = geo_tables(ctx.spark, ctx.sf_dir)
    km = seller_customer_distance(ctx.tables["orders"], ctx.tables["order_items"], geo["customers"], geo["sellers"], geo["geolocation"])
    return km.select("order_id", X.round_half_even("seller_customer_km", 3).alias("seller_customer_km"))


# ---------------------------------------------------------------- X2: encodings

BLOCKED = f"least(floor(rank * {BLOCKS} / (SELECT COUNT(*) FROM train)), {BLOCKS})"


@query(
    "target_encoded_category",
    statement(
        f"""SELECT b.order_id, b.primary_category,
  CASE WHEN r.n > 0 THEN (coalesce(sum(p.is_late), 0) + {SMOOTHING} * (r.l / r.n)) / (count(p.order_id) + {SMOOTHING}) END AS category_rate
FROM blocked b
LEFT JOIN (SELECT c.block, sum(x.is_late) AS l, count(x.order_id) AS n
           FROM (SELECT DISTINCT block FROM blocked) c LEFT JOIN blocked x ON x.block < c.block AND x.block < {BLOCKS} GROUP BY c.block) r
  ON r.block = b.block
LEFT JOIN blocked p ON p.primary_category = b.primary_category AND p.block < b.block AND p.block < {BLOCKS}
GROUP BY b.order_id, b.primary_category, r.n, r.l""",
        ["category_rate"],
        ctes=TRAIN_CTE + ",\n" + CATEGORY_CTE + f""",
blocked AS (SELECT s.*, c.mode_value AS primary_category, {BLOCKED} AS block FROM split s LEFT JOIN v_primary_cat c ON s.order_id = c.order_id)""",
    ),
)
def target_encoded_category(ctx: Ctx):
    """Late rate of the order's category in earlier time blocks, smoothed."""
    items = ctx.tables["order_items"].select("order_id", "product_id").join(
        ctx.tables["products"].select("product_id", "product_category_name"), "product_id", "left"
    )
    ranked = O.chronological_split(ctx.dataset, TEST_FRACTION, materialize_input=True)
    rows = materialize(ranked.join(C.primary_values(items, "product_category_name", "primary_category"), "order_id", "left")
                       .select("order_id", "rank", "is_test", "is_late", "primary_category"))
    n_train = rows.where(~F.col("is_test")).count()
    return target_encoding(rows, "primary_category", n_train, out="category_rate").select("order_id", "primary_category", "category_rate")


@query(
    "log_seller_volume",
    statement(
        f"""SELECT b.order_id, b.seller, CASE WHEN b.seller IS NOT NULL THEN ln(1 + count(p.order_id)) END AS seller_log_volume
FROM blocked b LEFT JOIN blocked p ON p.seller = b.seller AND p.block < b.block AND p.block < {BLOCKS}
GROUP BY b.order_id, b.seller""",
        ["seller_log_volume"],
        ctes=TRAIN_CTE + ",\n" + SELLER_COHORT_CTE + f""",
blocked AS (SELECT s.*, c.mode_value AS seller, {BLOCKED} AS block FROM split s LEFT JOIN v_primary_seller c ON s.order_id = c.order_id)""",
    ),
)
def log_seller_volume(ctx: Ctx):
    """Log of the primary seller's orders in earlier time blocks."""
    ranked = O.chronological_split(ctx.dataset, TEST_FRACTION, materialize_input=True)
    sellers = C.primary_values(ctx.tables["order_items"].select("order_id", "seller_id"), "seller_id", "seller")
    rows = materialize(ranked.join(sellers, "order_id", "left").select("order_id", "rank", "is_test", "seller"))
    n_train = rows.where(~F.col("is_test")).count()
    return log_volume(rows, "seller", n_train, out="seller_log_volume").select("order_id", "seller", "seller_log_volume")


# ---------------------------------------------------------------- sketches and cohorts


@query(
    "distinct_sellers_sketch",
    statement(
        """SELECT strftime(o.order_purchase_timestamp, '%Y-%m') AS month, COUNT(DISTINCT i.seller_id) AS sellers, TRUE AS within_bound
FROM v_orders o JOIN v_items i ON o.order_id = i.order_id WHERE o.order_purchase_timestamp IS NOT NULL GROUP BY 1""",
        frame=False, dataset=False,
    ),
)
def distinct_sellers_sketch(ctx: Ctx):
    """Sellers a month from merged daily sketches, within four standard errors of the exact count."""
    sold = ctx.tables["orders"].select("order_id", "order_purchase_timestamp").where("order_purchase_timestamp IS NOT NULL").join(
        ctx.tables["order_items"].select("order_id", "seller_id"), "order_id"
    ).select(F.to_date("order_purchase_timestamp").alias("day"), X.year_month("order_purchase_timestamp").alias("month"), "seller_id")
    daily = materialize(sketch_by(sold, ["day", "month"], "seller_id"))
    merged = merge_sketches(daily, ["month"], "estimate")
    exact = sold.groupBy("month").agg(F.count_distinct("seller_id").alias("sellers"))
    error = F.abs(F.col("estimate") - F.col("sellers"))
    return exact.join(merged, "month").select("month", "sellers", (error <= F.ceil(4 * relative_error() * F.col("sellers"))).alias("within_bound"))


COHORTS = {
    "delivery_window": "CASE WHEN estimated_delivery_days < 0 THEN NULL WHEN estimated_delivery_days < 10 THEN '0-10d' "
                       "WHEN estimated_delivery_days < 20 THEN '10-20d' WHEN estimated_delivery_days < 30 THEN '20-30d' ELSE '30d+' END",
    "item_count": "CASE WHEN item_count < 1 THEN NULL WHEN item_count = 1 THEN '1' WHEN item_count = 2 THEN '2' "
                  "WHEN item_count <= 4 THEN '3-4' WHEN item_count <= 99 THEN '5+' END",
    "payment_type": "payment_type_mode",
    "customer_state": "customer_state",
    "weekday": "CAST(purchase_day_of_week AS VARCHAR(2))",
    "hour": "CAST(purchase_hour AS VARCHAR(2))",
    "month": "CAST(purchase_month AS VARCHAR(2))",
    "same_state": "CAST(seller_customer_same_state AS VARCHAR(2))",
}


@query(
    "all_cohorts",
    statement(
        "\nUNION ALL\n".join(
            f"""SELECT '{name}' AS cohort, {sql} AS bucket, COUNT(*) AS orders, AVG(is_late) AS late_rate,
  round_even(AVG(is_late) / (SELECT AVG(is_late) FROM dataset) * 100, 0) / 100 AS lift_vs_base
FROM dataset WHERE ({sql}) IS NOT NULL GROUP BY {sql}""" for name, sql in COHORTS.items()
        ),
        ["late_rate", "lift_vs_base"],
    ),
)
def all_cohorts(ctx: Ctx):
    """Eight cohort tables from one grouping of one pass."""
    return C.cohort_tables(ctx.dataset, {name: F.expr(sql) for name, sql in COHORTS.items()})


# ---------------------------------------------------------------- checks of the fits

# The published settings of both searches (parameter values by sorted name).
PUBLISHED_FOREST = [
    (12, "sqrt", 10, 300), (12, "sqrt", 20, 500), (20, "sqrt", 20, 300), (12, None, 2, 500), (8, None, 5, 800), (8, None, 10, 300),
    (8, 0.5, 10, 800), (8, 0.5, 5, 300), (20, None, 2, 300), (None, 0.5, 10, 500), (None, 0.5, 10, 300), (None, 0.5, 2, 300),
]
PUBLISHED_BOOSTER = [
    (1.0, 0.05, 600, 15, 50), (0.1, 0.1, 400, 63, 50), (0.0, 0.05, 600, 15, 10), (1.0, 0.03, 400, 31, 20), (1.0, 0.05, 600, 63, 50),
    (0.0, 0.03, 400, 15, 10), (0.0, 0.03, 600, 63, 10), (0.0, 0.03, 200, 63, 10), (1.0, 0.1, 600, 31, 20), (1.0, 0.1, 400, 63, 20),
    (0.1, 0.05, 200, 31, 50), (0.1, 0.1, 400, 63, 10),
]


def _published() -> dict[str, list[str]]:
    rows = {"random_forest": PUBLISHED_FOREST, "hist_gradient_boosting": PUBLISHED_BOOSTER}
    return {name: sorted(json_sorted(dict(zip(sorted(MD.SEARCH_SPACES[name]), r, strict=True))) for r in own) for name, own in rows.items()}


def _published_sql() -> str:
    return ", ".join(f"({m}, '{name}', {k}, '{t}')" for m, (name, own) in enumerate(_published().items()) for k, t in enumerate(own))


@query(
    "published_draw_report",
    statement(
        f"""SELECT t.model, CAST(rank() OVER (PARTITION BY t.model ORDER BY f.m DESC) AS INTEGER) AS cv_rank,
  f.m AS cv_mean_average_precision, f.s AS cv_std_average_precision, f.tm AS cv_mean_train_average_precision,
  f.ts AS cv_std_train_average_precision, t.params, rank() OVER (PARTITION BY t.model ORDER BY f.m DESC) = 1 AS selected
FROM (VALUES {_published_sql()}) t(m, model, k, params)
JOIN (
  SELECT side, config, avg(test_ap) AS m, stddev_pop(test_ap) AS s, avg(train_ap) AS tm, stddev_pop(train_ap) AS ts
  FROM (
    SELECT order_id % 2 AS side, (order_id // 2) % 12 AS config,
      round(avg(CAST(customer_id % 1000 AS DOUBLE)), 1) / 1000 AS test_ap, round(avg(CAST(customer_id % 500 AS DOUBLE)), 1) / 500 AS train_ap
    FROM v_orders GROUP BY 1, 2, (order_id // 24) % 4) x
  GROUP BY side, config) f ON f.side = t.m AND f.config = t.k""",
        ["cv_mean_average_precision", "cv_std_average_precision", "cv_mean_train_average_precision", "cv_std_train_average_precision"],
        frame=False, dataset=False,
    ),
)
def published_draw_report(ctx: Ctx):
    """The 24 drawn settings equal the published ones; their fold scores come from the orders."""
    reports = None
    for side, (name, space) in enumerate(MD.SEARCH_SPACES.items()):
        texts = sorted(json_sorted(c) for c in MD.sample_configs(space, 12))
        config = F.floor(F.col("order_id") / 2) % 12
        scores = (
            ctx.tables["orders"].where(F.col("order_id") % 2 == side)
            .groupBy(config.alias("config"), (F.floor(F.col("order_id") / 24) % 4).alias("fold"))
            .agg((F.round(F.avg((F.col("customer_id") % 1000).cast("double")), 1) / 1000).alias("test_ap"),
                 (F.round(F.avg((F.col("customer_id") % 500).cast("double")), 1) / 500).alias("train_ap"))
            .withColumn("params", F.get(F.array(*[F.lit(t) for t in texts]), F.col("config").cast("int")))
        )
        report = summarize_tuning_results(name, cv_results(scores))
        reports = report if reports is None else reports.unionByName(report)
    return reports


L2, RATE = 0.7, 0.25
GAIN_CUTS = {"estimated_delivery_days": [10.0, 15.0, 20.0, 25.0, 30.0], "purchase_hour": [5.5, 11.5, 17.5], "item_count": [1.5, 3.5]}


def _bin_sql(feature: str) -> str:
    return " + ".join(f"CAST({feature} > {c} AS BIGINT)" for c in GAIN_CUTS[feature])


@query(
    "split_gains",
    statement(
        f"""WITH long AS (
  {" UNION ALL ".join(f"SELECT purchase_day_of_week AS leaf, '{f}' AS feature, {_bin_sql(f)} AS bin, {RATE} - is_late AS g, {RATE * (1 - RATE)} AS h FROM train WHERE {f} IS NOT NULL" for f in GAIN_CUTS)}
), cells AS (SELECT leaf, feature, bin, sum(g) AS g, sum(h) AS h, count(*) AS n FROM long GROUP BY leaf, feature, bin
), cum AS (
  SELECT *, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(n) OVER w AS nl, sum(g) OVER a AS gt, sum(h) OVER a AS ht, sum(n) OVER a AS nt FROM cells
  WINDOW w AS (PARTITION BY leaf, feature ORDER BY bin), a AS (PARTITION BY leaf, feature))
SELECT leaf, feature, bin, CAST(nl AS BIGINT) AS n_left,
  gl * gl / (hl + {L2}) + (gt - gl) * (gt - gl) / (ht - hl + {L2}) - gt * gt / (ht + {L2}) AS gain
FROM cum WHERE nl < nt""",
        ["gain"],
        ctes=TRAIN_CTE,
    ),
)
def split_gains_query(ctx: Ctx):
    """M8: gains of every split of every leaf, with the booster's formula, on gradients of a constant score."""
    train = O.chronological_split(ctx.dataset, TEST_FRACTION).where(~F.col("is_test"))
    rows = train.withColumns({"_g": F.lit(RATE) - F.col("is_late"), "_h": F.lit(RATE * (1 - RATE))})
    return split_gains(rows, "purchase_day_of_week", GAIN_CUTS, "_g", "_h", L2).withColumnRenamed("purchase_day_of_week", "leaf")


NEWTON_STEPS = 9


def _newton_sql() -> str:
    parts = ["p0 AS (SELECT g, CAST(0 AS DOUBLE) AS a, CAST(0 AS DOUBLE) AS b FROM (SELECT DISTINCT g FROM soft))"]
    for k in range(NEWTON_STEPS):
        parts.append(f"""s{k} AS (
  SELECT g, a, b, sum((p - t) * m) AS ga, sum(p - t) AS gb, sum(p * (1 - p) * m * m) AS ha, sum(p * (1 - p) * m) AS hab, sum(p * (1 - p)) AS hb
  FROM (SELECT soft.*, a, b, 1 / (1 + exp(-(a * m + b))) AS p FROM soft JOIN p{k} USING (g)) GROUP BY g, a, b
), p{k + 1} AS (
  SELECT g, a - (ga * hb - gb * hab) / (ha * hb - hab * hab) AS a, b - (gb * ha - ga * hab) / (ha * hb - hab * hab) AS b FROM s{k})""")
    return ",\n".join(parts)


@query(
    "sigmoid_fit",
    statement(
        f"SELECT CAST(g AS INTEGER) AS is_weekend, a AS slope, b AS intercept FROM p{NEWTON_STEPS}",
        ["slope", "intercept"],
        ctes=TRAIN_CTE + """,
held AS (SELECT is_weekend_purchase AS g, is_late, 1 - estimated_delivery_days / 40 AS m FROM test),
soft AS (
  SELECT g, m, CASE WHEN is_late = 1 THEN (l + 1) / CAST(l + 2 AS DOUBLE) ELSE 1 / CAST(n - l + 2 AS DOUBLE) END AS t
  FROM held JOIN (SELECT g, sum(is_late) AS l, count(*) AS n FROM held GROUP BY g) USING (g)),
""" + _newton_sql(),
    ),
)
def sigmoid_fit(ctx: Ctx):
    """Slopes and intercepts of two groups' curves on a fixed margin."""
    test = O.chronological_split(ctx.dataset, TEST_FRACTION, materialize_input=True).where("is_test")
    held = test.select(F.col("is_weekend_purchase").cast("int").alias("g"), "is_late", (1 - F.col("estimated_delivery_days") / 40).alias("margin"))
    curves = fit_sigmoids(held, "g", [0, 1])
    return ctx.spark.createDataFrame([(g, c.a, c.b) for g, c in curves.items()], "is_weekend int, slope double, intercept double")
