"""Reading source and layer tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, schema: str | None = None) -> DataFrame:
    """Scan one parquet table; projection and filters are pushed down by Catalyst.

    With ``schema`` (the columns the caller needs, by name) Spark skips the
    footer-reading inference job and reads exactly those columns.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(table_path(sf_dir, name))


def resolve(spark: SparkSession, table: str | DataFrame) -> DataFrame:
    """A DataFrame as-is, or a catalog table by (qualified) name."""
    return table if isinstance(table, DataFrame) else spark.table(table)
