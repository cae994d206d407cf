"""shipwise: order-level delivery-risk analytics on Spark.

Layers: ``sources`` (table specs, readers, sinks, test-table adapter),
``functions`` (column expressions), ``operators`` (order frame, features,
profiling, cohorts, ordering, quantiles, metrics, slices), ``ml`` (Spark ML
stages, models, tuning, calibration, importance, job) and ``plans`` (the
registered queries and their SQL oracles).
"""

__version__ = "0.1.0"
