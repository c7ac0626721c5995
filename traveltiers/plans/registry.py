"""Registered queries: one Spark builder and one DuckDB oracle per key.

Every query reads the driver's tables through a fixture (A: ``events``;
B: ``lineitem`` x ``orders``; both with ``customer`` and ``supplier``) and runs
over the whole input. Outputs are normalised for comparison: integers as
BIGINT, decimals as DOUBLE, audit timestamps as TIMESTAMP_NTZ in UTC, dates as
midnight TIMESTAMP_NTZ.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from traveltiers.plans import oracle as O
from traveltiers.plans.layers import Layers
from traveltiers.sources.fixtures import fixture


@dataclass(frozen=True)
class Query:
    name: str
    fixture: str
    build: Callable[[Layers], DataFrame]
    sql: str | None  # body over the oracle CTEs; None = no SQL form (rows-only check)


def normalize(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(t, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(t, T.DateType):
            c = c.cast("timestamp_ntz")  # midnight; converts identically through collect and pandas
        cols.append(c.alias(f.name))
    return df.select(*cols)


REGISTRY: dict[str, Query] = {}


def register(name: str, fixture_name: str, sql: str | None):
    def deco(fn: Callable[[Layers], DataFrame]):
        REGISTRY[name] = Query(name, fixture_name, fn, sql)
        return fn
    return deco


def layers_for(spark: SparkSession, sf_dir: str, fixture_name: str) -> Layers:
    return Layers(fixture(spark, sf_dir, fixture_name))


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    q = REGISTRY[name]
    return normalize(q.build(layers_for(spark, sf_dir, q.fixture)))


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, _n=name: run(_n, spark, sf_dir)) for name in REGISTRY}


def oracle_queries() -> dict[str, str]:
    return {name: O.with_layers(q.fixture, q.sql) for name, q in REGISTRY.items() if q.sql is not None}


# Importing the query modules fills REGISTRY.
from traveltiers.plans import queries  # noqa: E402,F401
from traveltiers.plans import operator_queries  # noqa: E402,F401
