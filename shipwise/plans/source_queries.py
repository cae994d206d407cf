"""Registered queries: CSV source / sink round trip (S1-S3, S7) and small
profile tables (A22, A24, A26, T3)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.exprs import attach_one_row
from ..operators import cohorts as C
from ..operators.order_frame import build_modeling_frame
from ..session import checkpoint_dir
from ..sources.contracts import SPECS_BY_NAME, TABLE_SPECS
from ..sources.readers import load_tables, read_csv_table
from .cohort_queries import CORRIDOR_CTE
from .context import Ctx
from .frame_queries import FRAME_DOUBLES
from .oracle import statement
from .registry import query


def write_raw_csv(ctx: Ctx, out_dir: str) -> None:
    """The six tables as header CSV under the raw file names, columns in spec order."""
    for spec in TABLE_SPECS:
        src = ctx.tables[spec.name]
        cols = [
            (F.col(f.name) if f.name in src.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in spec.schema.fields
        ]
        (
            src.select(*cols)
            .write.mode("overwrite")
            .option("header", True)
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
            .option("compression", "gzip")  # text of repeated digits: a fraction of its size on disk
            .csv(f"{out_dir}/{spec.file_name}")
        )


@query(
    "csv_round_trip",
    statement(
        "SELECT * REPLACE (CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id) "
        "FROM frame",
        FRAME_DOUBLES,
        dataset=False,
    ),
)
def csv_round_trip(ctx: Ctx):
    out_dir = f"{checkpoint_dir(ctx.spark).rstrip('/')}/csv_round_trip/{uuid.uuid4().hex}"
    write_raw_csv(ctx, out_dir)
    return build_modeling_frame(load_tables(ctx.spark, out_dir, fmt="csv"))


@query(
    "csv_by_name",
    statement(
        """SELECT CAST(order_id AS VARCHAR) AS order_id, order_item_id,
  CASE WHEN order_id % 7 = 0 THEN NULL ELSE price END AS price,
  CASE WHEN order_id % 11 = 0 THEN NULL ELSE freight_value END AS freight_value FROM v_items""",
        ["price", "freight_value"],
        dataset=False,
    ),
)
def csv_by_name(ctx: Ctx):
    """Items from a CSV whose columns stand in reverse order, with null tokens and malformed cells (S3)."""
    schema = SPECS_BY_NAME["order_items"].schema
    items = ctx.tables["order_items"]
    text = {f.name: F.col(f.name).cast("string") for f in schema.fields}
    text["price"] = F.when(F.col("order_id") % 7 == 0, F.lit("NaN")).otherwise(text["price"])
    text["freight_value"] = F.when(F.col("order_id") % 11 == 0, F.lit("not a number")).otherwise(text["freight_value"])
    path = f"{checkpoint_dir(ctx.spark).rstrip('/')}/csv_by_name/{uuid.uuid4().hex}"
    items.select(*[text[f.name].alias(f.name) for f in reversed(schema.fields)]).write.option("header", True).csv(path)
    return read_csv_table(ctx.spark, path, schema).select("order_id", "order_item_id", "price", "freight_value")


@query(
    "time_span",
    statement(
        """SELECT COUNT(*) AS rows, COUNT(order_purchase_timestamp) AS with_purchase_ts,
  MIN(order_purchase_timestamp) AS first_purchase, MAX(order_purchase_timestamp) AS last_purchase FROM dataset"""
    ),
)
def time_span(ctx: Ctx):
    ts = "order_purchase_timestamp"
    return ctx.dataset.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(ts).alias("with_purchase_ts"),
        F.min(ts).alias("first_purchase"),
        F.max(ts).alias("last_purchase"),
    )


@query(
    "corridor_axis_totals",
    statement(
        """SELECT 'primary_seller_state' AS axis, primary_seller_state AS state, CAST(SUM(orders) AS BIGINT) AS axis_orders
FROM corr WHERE primary_seller_state IN (SELECT * FROM top_rows) GROUP BY primary_seller_state
UNION ALL
SELECT 'customer_state', customer_state, CAST(SUM(orders) AS BIGINT) FROM corr
WHERE customer_state IN (SELECT * FROM top_cols) GROUP BY customer_state""",
        ctes=CORRIDOR_CTE,
    ),
)
def corridor_axis_totals(ctx: Ctx):
    corr = C.corridor_stats(ctx.dataset)
    rows = C.corridor_axis_top(corr, "primary_seller_state", 12).select(
        F.lit("primary_seller_state").alias("axis"), F.col("primary_seller_state").alias("state"), "axis_orders"
    )
    cols = C.corridor_axis_top(corr, "customer_state", 15).select(
        F.lit("customer_state").alias("axis"), F.col("customer_state").alias("state"), "axis_orders"
    )
    return rows.unionByName(cols)


@query(
    "seller_volumes",
    statement(
        "SELECT seller_id, COUNT(DISTINCT order_id) AS seller_orders FROM v_items GROUP BY seller_id",
        frame=False,
        dataset=False,
    ),
)
def seller_volumes(ctx: Ctx):
    return C.seller_volumes(ctx.tables["order_items"])


@query(
    "global_counts",
    statement(
        """SELECT (SELECT COUNT(*) FROM frame) AS frame_rows, COUNT(*) AS dataset_rows,
  AVG(is_late) AS base_rate FROM dataset""",
        ["base_rate"],
    ),
)
def global_counts(ctx: Ctx):
    """Rows in the order frame and in the model dataset, and the base late rate (A10)."""
    frame_rows = ctx.frame.agg(F.count(F.lit(1)).alias("frame_rows"))
    ds = ctx.dataset.agg(F.count(F.lit(1)).alias("dataset_rows"), F.avg("is_late").alias("base_rate"))
    return attach_one_row(frame_rows, ds).select("frame_rows", "dataset_rows", "base_rate")
