"""Silver layer: key filters, defaults, range rules, calendar parts, segments.

All three tables are one narrow stage each (filter + project); the NOT NULL
key filters reach the parquet scan as pushed filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traveltiers.functions import rules as R


def filter_required_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keep rows whose keys are all non-NULL (NaN keys are kept, unlike ``dropna``)."""
    cond: Column | None = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df if cond is None else df.filter(cond)


def calendar_parts(ts: str | Column = "ts") -> list[Column]:
    t = R.col(ts)
    return [
        F.year(t).alias("transaction_year"),
        F.month(t).alias("transaction_month"),
        F.dayofweek(t).alias("transaction_day_of_week"),
        F.hour(t).alias("transaction_hour"),
        R.day_type(t).alias("day_type"),
    ]


def silver_travel_purchases(bronze: DataFrame, run_ts: str | None = None) -> DataFrame:
    kept = filter_required_keys(bronze, ["id", "user_id", "destination_id"])
    return kept.select(
        F.col("id").alias("transaction_id"),
        F.col("ts").alias("transaction_timestamp"),
        "user_id",
        "destination_id",
        R.default_false("clicked").alias("clicked"),
        R.default_false("purchased").alias("purchased"),
        "booking_date",
        R.clean_price("price").alias("price_usd"),
        "user_latitude",
        "user_longitude",
        R.price_invalid("price").alias("_price_invalid"),
        R.location_invalid("user_latitude", "user_longitude").alias("_location_invalid"),
        *calendar_parts("ts"),
        "_ingested_at",
        R.audit_ts(run_ts).alias("_processed_at"),
    )


def silver_users(bronze: DataFrame, run_ts: str | None = None) -> DataFrame:
    """All snapshots are kept (no deduplication); segments test the raw values."""
    kept = filter_required_keys(bronze, ["user_id"])
    return kept.select(
        "user_id",
        F.col("ts").alias("last_updated_at"),
        F.round(F.coalesce(F.col("mean_price_7d"), F.lit(0.0)), R.PRICE_SCALE).alias("avg_price_7day"),
        F.coalesce(F.col("last_6m_purchases"), F.lit(0).cast("bigint")).alias("purchases_6month"),
        R.clean_latitude("user_latitude").alias("user_latitude"),
        R.clean_longitude("user_longitude").alias("user_longitude"),
        R.frequency_segment("last_6m_purchases").alias("purchase_frequency_segment"),
        R.price_segment("mean_price_7d").alias("price_segment"),
        "_ingested_at",
        R.audit_ts(run_ts).alias("_processed_at"),
    )


def latest_user_snapshot(users: DataFrame) -> DataFrame:
    """Optional extra (off by default in the gold layer): one row per user, newest ``last_updated_at``.

    Snapshots of one time are told apart by the other columns (the greatest values, in column
    order), so the pick does not depend on row order. The struct's maximum is map-side
    combined; Spark runs it as a sort aggregate.
    """
    cols = [c for c in users.columns if c != "user_id"]
    others = [c for c in cols if c != "last_updated_at"]
    picked = users.groupBy("user_id").agg(F.max(F.struct("last_updated_at", *others)).alias("_s"))
    return picked.select("user_id", *[F.col(f"_s.{c}").alias(c) for c in cols])


def silver_destinations(bronze: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Hemisphere is derived from the raw latitude, before it is range-cleaned."""
    kept = filter_required_keys(bronze, ["destination_id"])
    return kept.select(
        "destination_id",
        R.normalize_name("destination_name").alias("destination_name"),
        R.clean_latitude("dest_latitude").alias("latitude"),
        R.clean_longitude("dest_longitude").alias("longitude"),
        R.hemisphere("dest_latitude").alias("hemisphere"),
        "_ingested_at",
        R.audit_ts(run_ts).alias("_processed_at"),
    )
