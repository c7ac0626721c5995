"""The three source relations, derived from the driver's test tables.

Fixture A (``events``) exercises every cleaning rule; fixture B
(``lineitem`` joined with ``orders``) gives volume and several years of
history. Both share ``user_features`` (from ``customer``) and
``destination_location`` (from ``supplier``). Every column is a built-in
expression, so the fixtures are plain scans plus one join and scale with
the input tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from traveltiers.sources.tables import read_table

# Fixed values of the fixture definitions.
LAT_FRACTION = 0.1234567
LON_FRACTION = 0.7654321
SNAPSHOT_1 = "2024-01-01 00:00:00"
SNAPSHOT_2 = "2024-01-15 00:00:00"

# Input contract: the columns each fixture reads from the driver's tables, with their parquet types.
EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
LINEITEM_SCHEMA = ("l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double, "
                   "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
ORDERS_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz"
CUSTOMER_SCHEMA = "c_custkey bigint, c_acctbal double"
SUPPLIER_SCHEMA = "s_suppkey bigint, s_name string"


@dataclass(frozen=True)
class Sources:
    travel_purchase: DataFrame
    user_features: DataFrame
    destination_location: DataFrame


def _coord(n: str, mult: int, modulus: int, offset: int, frac: float) -> Column:
    return ((F.col(n) * F.lit(mult)) % F.lit(modulus) - F.lit(offset)).cast("double") + F.lit(frac)


def _lat(n: str, mult: int, modulus: int, offset: int) -> Column:
    return _coord(n, mult, modulus, offset, LAT_FRACTION)


def _lon(n: str, mult: int, modulus: int, offset: int) -> Column:
    return _coord(n, mult, modulus, offset, LON_FRACTION)


ORPHAN_SHIFT = 1_000_000_000


def _null_when(cond: Column, value: Column, dtype: str) -> Column:
    return F.when(cond, F.lit(None).cast(dtype)).otherwise(value)


def _or_orphan(key: str) -> Column:
    """Every 29th user id shifted out of the customers' range: an orphan, without dropping a customer."""
    return F.when(F.col(key) % 29 == 0, F.col(key) + ORPHAN_SHIFT).otherwise(F.col(key))


def travel_purchase_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule-coverage purchases from ``events``."""
    e = read_table(spark, sf_dir, "events", EVENTS_SCHEMA)
    eid = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("bigint")
    is_error = F.col("event_type") == F.lit("error")
    price = (
        F.when(eid % 501 == 0, F.lit(None).cast("double"))
        .when(eid % 251 == 0, -F.col("value"))
        .when(eid % 997 == 0, F.lit(60000.0))
        .otherwise(F.col("value") * F.lit(4))
    )
    return e.select(
        eid.alias("id"),
        F.col("ts"),
        _null_when(eid % 1009 == 0, _or_orphan("user_id"), "bigint").alias("user_id"),
        F.nullif(k, F.lit(99)).alias("destination_id"),
        _null_when(is_error, F.col("event_type").isin("click", "purchase"), "boolean").alias("clicked"),
        _null_when(is_error, F.col("event_type") == F.lit("purchase"), "boolean").alias("purchased"),
        F.col("ts").cast("date").alias("booking_date"),
        price.alias("price"),
        _null_when(eid % 307 == 0, _lat("user_id", 37, 181, 90), "double").alias("user_latitude"),
        _lon("user_id", 53, 361, 180).alias("user_longitude"),
    )


def travel_purchase_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume purchases from ``lineitem`` joined with ``orders`` (many months)."""
    li = read_table(spark, sf_dir, "lineitem", LINEITEM_SCHEMA)
    o = read_table(spark, sf_dir, "orders", ORDERS_SCHEMA)
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    return j.select(
        (F.col("l_orderkey") * F.lit(8) + F.col("l_linenumber")).alias("id"),
        F.col("l_shipdate").alias("ts"),
        _or_orphan("o_custkey").alias("user_id"),
        F.col("l_suppkey").alias("destination_id"),
        (F.col("l_linestatus") == F.lit("F")).alias("clicked"),
        (F.col("l_returnflag") == F.lit("R")).alias("purchased"),
        F.col("o_orderdate").cast("date").alias("booking_date"),
        F.col("l_extendedprice").alias("price"),
        _lat("o_custkey", 37, 181, 90).alias("user_latitude"),
        _lon("o_custkey", 53, 361, 180).alias("user_longitude"),
    )


def user_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots per customer (the second only for every tenth one)."""
    c = read_table(spark, sf_dir, "customer", CUSTOMER_SCHEMA)
    key = F.col("c_custkey")
    mean_price = _null_when(key % 17 == 0, F.col("c_acctbal") % F.lit(1000), "double")

    def snapshot(ts: str, purchases: Column) -> DataFrame:
        return c.select(
            key.alias("user_id"),
            F.lit(ts).cast("timestamp_ntz").alias("ts"),
            mean_price.alias("mean_price_7d"),
            purchases.alias("last_6m_purchases"),
            _lon("c_custkey", 53, 361, 180).alias("user_longitude"),
            _lat("c_custkey", 37, 181, 90).alias("user_latitude"),
        )

    first = snapshot(SNAPSHOT_1, _null_when(key % 19 == 0, key % 15, "bigint"))
    second_purchases = (
        F.when(key % 19 == 0, F.lit(None).cast("bigint"))
        .when(key % 20 == 0, (key + 5) % 15)
        .otherwise(key % 15)
    )
    second = snapshot(SNAPSHOT_2, second_purchases).filter(key % 10 == 0)
    return first.unionByName(second)


def destination_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier", SUPPLIER_SCHEMA)
    key = F.col("s_suppkey")
    return s.select(
        key.alias("destination_id"),
        F.lower(F.concat(F.lit(" "), F.col("s_name"), F.lit(" city "))).alias("name"),
        _null_when(key % 23 == 0, _lat("s_suppkey", 7, 191, 95), "double").alias("latitude"),
        _lon("s_suppkey", 59, 381, 190).alias("longitude"),
    )


def fixture_a(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources(travel_purchase_a(spark, sf_dir), user_features(spark, sf_dir), destination_location(spark, sf_dir))


def fixture_b(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources(travel_purchase_b(spark, sf_dir), user_features(spark, sf_dir), destination_location(spark, sf_dir))


def catalog_sources(spark: SparkSession, source_schema: str) -> Sources:
    """The three source tables by name from the catalog (``<schema>.travel_purchase`` ...)."""
    return Sources(
        spark.table(f"{source_schema}.travel_purchase"),
        spark.table(f"{source_schema}.user_features"),
        spark.table(f"{source_schema}.destination_location"),
    )


def fixture(spark: SparkSession, sf_dir: str, name: str) -> Sources:
    return {"A": fixture_a, "B": fixture_b}[name.upper()](spark, sf_dir)
