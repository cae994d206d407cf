"""AQE splits a hot product on the item side of the order frame's left join."""

from __future__ import annotations

from pyspark.sql import functions as F

from shipwise.operators import order_frame as OF

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_product_join_is_split_and_complete(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        n = 30000
        items = spark.range(n).select(
            (F.col("id") % 5000).alias("order_id"), F.col("id").cast("int").alias("order_item_id"),
            F.when(F.col("id") % 2 == 0, F.lit(1)).otherwise(F.col("id") % 997).alias("product_id"),
            (F.col("id") % 50).alias("seller_id"), F.lit(10.0).alias("price"), F.lit(1.0).alias("freight_value"),
        )
        products = spark.range(1000).select(
            F.col("id").alias("product_id"), *[F.lit(1.0).alias(c) for c in OF.PRODUCT_MEASURES]
        )
        sellers = spark.range(50).select(F.col("id").alias("seller_id"), F.lit("S").alias("seller_state"))
        df = OF.enrich_items(items, products, sellers)
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
        assert len(rows) == n and all(r["product_weight_g"] == 1.0 for r in rows)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
