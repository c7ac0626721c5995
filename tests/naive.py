"""Plain forms for comparison: join the fact to the dimension, group once, rank over everything."""

from pyspark.sql import Window
from pyspark.sql import functions as F

DEST = ["destination_id", "destination_name", "latitude", "longitude", "hemisphere"]
USER = {"user_id": "user_id", "purchase_frequency_segment": "purchase_frequency_segment", "price_segment": "price_segment",
        "historical_avg_price": "avg_price_7day", "historical_purchases": "purchases_6month", "user_latitude": "user_latitude",
        "user_longitude": "user_longitude"}


def _share(part, whole):
    return F.when(whole != 0, F.round(part * F.lit(100).cast("decimal(5,1)") / whole, 2)).cast("double")


def _flags(fact):
    """The fact with one 0/1 column per kind of event and the money of bookings."""
    booked = F.coalesce("purchased", F.lit(False))
    return fact.select("*", F.coalesce("clicked", F.lit(False)).cast("bigint").alias("is_click"), booked.cast("bigint").alias("is_booking"),
                       F.when(booked, F.col("price_usd").cast("decimal(18,2)")).otherwise(0).alias("money"))


def _revenue():
    """NULL only where every row is a booking without a price; a row that matched nothing counts 0."""
    return F.sum(F.when(F.col("is_booking").isNull(), F.lit(0).cast("decimal(18,2)")).otherwise(F.col("money")))


def destinations(dim, fact):
    zero = F.lit(0).cast("bigint")
    joined = dim.join(_flags(fact), "destination_id", "left")
    out = joined.groupBy(*DEST).agg(
        F.count("*").alias("total_views"), F.coalesce(F.sum("is_click"), zero).alias("total_clicks"), F.coalesce(F.sum("is_booking"), zero).alias("total_bookings"),
        _revenue().alias("revenue"), F.count_distinct("user_id").alias("unique_visitors"),
        F.count_distinct(F.when(F.col("is_booking") == 1, F.col("user_id"))).alias("unique_buyers"),
        F.min("transaction_timestamp").alias("first_transaction"), F.max("transaction_timestamp").alias("last_transaction"))
    for name, by in (("booking_rank", "total_bookings"), ("revenue_rank", "revenue")):
        out = out.withColumn(name, F.rank().over(Window.orderBy(F.desc_nulls_last(by))).cast("bigint"))
    return (out.withColumn("click_rate_pct", _share(F.col("total_clicks"), F.col("total_views")))
            .withColumn("booking_rate_pct", _share(F.col("total_bookings"), F.col("total_clicks")))
            .withColumn("total_revenue_usd", F.col("revenue").cast("double")).drop("revenue"))


def users(dim, fact):
    zero = F.lit(0).cast("bigint")
    flags = _flags(fact.select("user_id", "destination_id", "transaction_id", "clicked", "purchased", "price_usd", "transaction_timestamp"))
    joined = dim.select(*[F.col(c).alias(n) for n, c in USER.items()]).join(flags, "user_id", "left")
    out = joined.groupBy(*USER).agg(
        F.count("transaction_id").alias("total_interactions"), F.coalesce(F.sum("is_click"), zero).alias("total_clicks"),
        F.coalesce(F.sum("is_booking"), zero).alias("total_purchases"), F.count("*").alias("rows"),
        _revenue().alias("spend"), F.count_distinct("destination_id").alias("destinations_viewed"),
        F.count_distinct(F.when(F.col("is_booking") == 1, F.col("destination_id"))).alias("destinations_booked"),
        F.min("transaction_timestamp").alias("first_activity"), F.max("transaction_timestamp").alias("last_activity"))
    tier = F.lit("bronze")
    for least, name in ((500, "silver"), (2000, "gold"), (5000, "platinum")):
        tier = F.when(F.col("spend") >= least, name).otherwise(tier)
    return (out.withColumn("conversion_rate_pct", _share(F.col("total_purchases"), F.col("rows"))).withColumn("total_spend_usd", F.col("spend").cast("double"))
            .withColumn("engagement_days", F.datediff("last_activity", "first_activity")).withColumn("customer_tier", tier).drop("spend", "rows"))
