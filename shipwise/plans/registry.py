"""Registry of named queries: Spark builder plus optional oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import configure
from .context import Ctx, rounded


@dataclass
class Registered:
    name: str
    build: Callable[[Ctx], DataFrame]
    sql: str | None


REGISTRY: dict[str, Registered] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Callable[[Ctx], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Registered(name, fn, sql)
        return fn

    return deco


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    reg = REGISTRY[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return rounded(reg.build(Ctx.get(spark, sf_dir)))

    run.__name__ = name
    return run
