"""All registered queries (importing the modules fills the registry)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (  # noqa: F401
    cohort_queries,
    extension_queries,
    frame_queries,
    metric_queries,
    ml_queries,
    ordering_queries,
    profile_queries,
    source_queries,
)
from .registry import REGISTRY, runner


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: runner(name) for name in REGISTRY}


def oracle_sql() -> dict[str, str]:
    return {name: reg.sql for name, reg in REGISTRY.items() if reg.sql}
