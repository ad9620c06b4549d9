"""Registry binding named queries (Spark plan + DuckDB oracle SQL) to the
driver tables under an ``sf_dir``."""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sparkfold.session import ship_package

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    name: str
    fn: QueryFn
    oracle: str | None
    bench: bool


REGISTRY: dict[str, Entry] = {}


def query(name: str, oracle: str | None = None, bench: bool = True):
    def wrap(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        REGISTRY[name] = Entry(name, run, oracle.strip() if oracle else None, bench)
        return fn
    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
