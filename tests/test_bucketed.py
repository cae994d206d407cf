"""Bucketed order-keyed tables remove the order_id exchanges of the order frame."""

from __future__ import annotations

from shipwise.operators.order_frame import build_modeling_frame
from shipwise.plans.context import Ctx, rounded
from shipwise.sources.sinks import stage_bucketed


def exchanges_on_order_id(df) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum(1 for line in plan.splitlines() if "Exchange hashpartitioning(order_id" in line)


def test_bucketed_staging_keeps_results_and_drops_exchanges(spark):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # static plan, to count exchanges
    try:
        tables = Ctx(spark, "/root/testdata/sf0.001").tables
        plain = build_modeling_frame(tables)
        staged = build_modeling_frame(stage_bucketed(spark, tables, buckets=8))
        cols = plain.columns
        # sums of doubles depend on summation order: compare at 6 digits
        assert sorted(map(tuple, rounded(plain.select(cols)).collect()), key=str) == sorted(
            map(tuple, rounded(staged.select(cols)).collect()), key=str)
        assert exchanges_on_order_id(staged) < exchanges_on_order_id(plain)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
