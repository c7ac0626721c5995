"""Bronze layer: raw copies with audit columns (narrow, no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traveltiers.functions.rules import audit_ts, row_hash

DEFAULT_SOURCE_SCHEMA = "raw"
PURCHASE_COLUMNS = [
    "id", "ts", "user_id", "destination_id", "clicked", "purchased",
    "booking_date", "price", "user_latitude", "user_longitude",
]
USER_COLUMNS = ["user_id", "ts", "mean_price_7d", "last_6m_purchases", "user_longitude", "user_latitude"]
ROW_HASH_COLUMNS = ["id", "ts", "user_id", "destination_id"]


def source_name(source_schema: str, table: str) -> str:
    return f"{source_schema}.{table}"


def bronze_travel_purchases(
    src: DataFrame,
    run_ts: str | None = None,
    source_schema: str = DEFAULT_SOURCE_SCHEMA,
    source_table: str = "travel_purchase",
) -> DataFrame:
    """10 source columns + ``_ingested_at``, ``_source_table`` and an MD5 row hash."""
    return src.select(
        *PURCHASE_COLUMNS,
        audit_ts(run_ts).alias("_ingested_at"),
        F.lit(source_name(source_schema, source_table)).alias("_source_table"),
        row_hash(*ROW_HASH_COLUMNS).alias("_row_hash"),
    )


def bronze_user_features(
    src: DataFrame,
    run_ts: str | None = None,
    source_schema: str = DEFAULT_SOURCE_SCHEMA,
    source_table: str = "user_features",
) -> DataFrame:
    return src.select(
        *USER_COLUMNS,
        audit_ts(run_ts).alias("_ingested_at"),
        F.lit(source_name(source_schema, source_table)).alias("_source_table"),
    )


def bronze_destinations(
    src: DataFrame,
    run_ts: str | None = None,
    source_schema: str = DEFAULT_SOURCE_SCHEMA,
    source_table: str = "destination_location",
) -> DataFrame:
    return src.select(
        "destination_id",
        F.col("name").alias("destination_name"),
        F.col("latitude").alias("dest_latitude"),
        F.col("longitude").alias("dest_longitude"),
        audit_ts(run_ts).alias("_ingested_at"),
        F.lit(source_name(source_schema, source_table)).alias("_source_table"),
    )
