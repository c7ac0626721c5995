"""Rules R1-R10 on literal rows: the reference's 21 unit cases plus boundary values."""

import math

import pytest
from pyspark.sql import functions as F

from traveltiers.functions import rules as R


def one(spark, col, value, dtype="double"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(col(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("price,valid", [
    (150.99, True), (-50.0, False), (100000.0, False), (None, False),
    (0.0, True), (50000.0, True), (50000.01, False), (float("nan"), False),
])
def test_price_rule(spark, price, valid):
    assert one(spark, R.price_invalid, price) is (not valid)
    cleaned = one(spark, R.clean_price, price)
    if valid:
        assert cleaned == round(price, 2)
    else:
        assert cleaned is None


def test_price_rounds_half_up(spark):
    assert one(spark, R.clean_price, 1.005) == 1.01
    assert one(spark, R.clean_price, 2.675) == 2.68


@pytest.mark.parametrize("lat,lon,invalid", [
    (45.5, -122.4, False), (100.0, -122.4, True), (45.5, 200.0, True),
    (90.0, 180.0, False), (-90.0, -180.0, False), (90.000001, 0.0, True), (-90.000001, 0.0, True),
    (0.0, 180.000001, True), (0.0, -180.000001, True), (None, 0.0, True), (0.0, None, True),
])
def test_location_invalid(spark, lat, lon, invalid):
    df = spark.createDataFrame([(lat, lon)], "a double, b double")
    assert df.select(R.location_invalid("a", "b").alias("r")).first()["r"] is invalid


@pytest.mark.parametrize("v,expected", [
    (45.5, 45.5), (100.0, None), (90.0, 90.0), (-90.0, -90.0), (90.000001, None), (None, None),
    (12.3456784, 12.345678), (12.3456785, 12.345679),
])
def test_clean_latitude(spark, v, expected):
    assert one(spark, R.clean_latitude, v) == expected


@pytest.mark.parametrize("v,expected", [(-122.4, -122.4), (200.0, None), (180.0, 180.0), (-180.000001, None)])
def test_clean_longitude(spark, v, expected):
    assert one(spark, R.clean_longitude, v) == expected


@pytest.mark.parametrize("n,segment", [
    (15, "high_frequency"), (5, "medium_frequency"), (1, "low_frequency"),
    (10, "high_frequency"), (9, "medium_frequency"), (3, "medium_frequency"), (2, "low_frequency"),
    (None, "low_frequency"),
])
def test_frequency_segment(spark, n, segment):
    assert one(spark, R.frequency_segment, n, "bigint") == segment


@pytest.mark.parametrize("p,segment", [
    (750.0, "premium"), (350.0, "standard"), (99.0, "budget"), (500.0, "premium"), (499.99, "standard"),
    (200.0, "standard"), (199.99, "budget"), (None, "budget"), (-5.0, "budget"),
])
def test_price_segment(spark, p, segment):
    assert one(spark, R.price_segment, p) == segment


@pytest.mark.parametrize("spend,tier", [
    ("7500", "platinum"), ("3500", "gold"), ("1200", "silver"), ("250", "bronze"),
    ("5000", "platinum"), ("4999.99", "gold"), ("2000", "gold"), ("1999.99", "silver"),
    ("500", "silver"), ("499.99", "bronze"), (None, "bronze"),
])
def test_customer_tier(spark, spend, tier):
    from decimal import Decimal
    v = None if spend is None else Decimal(spend)
    assert one(spark, R.customer_tier, v, "decimal(38,2)") == tier


@pytest.mark.parametrize("num,den,expected", [
    (25, 100, 25.0), (50, 50, 100.0), (0, 0, None), (1, 3, 33.33), (2, 3, 66.67), (1, 8, 12.5),
    (1, 200, 0.5), (1, 400, 0.25), (1, 800, 0.13), (3, 2, 150.0), (0, 7, 0.0),
])
def test_pct_half_up_and_null_denominator(spark, num, den, expected):
    """0/0 is NULL (the SQL), not 0 (the reference's scalar unit test)."""
    df = spark.createDataFrame([(num, den)], "n bigint, d bigint")
    assert df.select(R.pct("n", "d").alias("r")).first()["r"] == expected


def test_pct_matches_integer_half_up_exhaustively(spark):
    df = spark.range(1, 200).withColumnRenamed("id", "d").crossJoin(
        spark.range(0, 200).withColumnRenamed("id", "n"))
    got = df.select("n", "d", R.pct("n", "d").alias("r")).collect()
    for r in got:
        want = ((20000 * r["n"] + r["d"]) // (2 * r["d"])) / 100
        assert r["r"] == want


def test_avg_cents_half_up(spark):
    df = spark.createDataFrame([(5, 2), (1000, 3), (1, 2), (None, 0), (2000, 3)], "s bigint, n bigint")
    got = [r["r"] for r in df.select(R.avg_cents("s", "n").alias("r")).collect()]
    assert got == [0.03, 3.33, 0.01, None, 6.67]


@pytest.mark.parametrize("price,expected", [(0.29, 29), (26.200000000000003, 2620), (50000.0, 5000000),
                                            (0.0, 0), (None, None), (1.01, 101)])
def test_cents_are_exact(spark, price, expected):
    assert one(spark, R.cents, price) == expected


@pytest.mark.parametrize("ts,kind", [
    ("2024-01-06 10:00:00", "weekend"), ("2024-01-07 10:00:00", "weekend"),
    ("2024-01-08 10:00:00", "weekday"), (None, "weekday"),
])
def test_day_type(spark, ts, kind):
    df = spark.createDataFrame([(ts,)], "s string").select(F.col("s").cast("timestamp_ntz").alias("t"))
    assert df.select(R.day_type("t").alias("r")).first()["r"] == kind


@pytest.mark.parametrize("lat,h", [(0.0, "Northern"), (-0.1, "Southern"), (None, "Southern"),
                                   (95.0, "Northern"), (float("nan"), "Northern")])
def test_hemisphere_uses_raw_latitude(spark, lat, h):
    assert one(spark, R.hemisphere, lat) == h


@pytest.mark.parametrize("name,expected", [
    ("new-york", "New-york"), ("  são  paulo ", "São  Paulo"), (None, None),
    (" supplier#000000001 city ", "Supplier#000000001 City"), ("\tlima", "\tlima"),
])
def test_normalize_name(spark, name, expected):
    assert one(spark, R.normalize_name, name, "string") == expected


def test_row_hash_skips_nulls(spark):
    df = spark.createDataFrame([(1, None, 3), (1, 3, None)], "a bigint, b bigint, c bigint")
    h = [r["h"] for r in df.select(R.row_hash("a", "b", "c").alias("h")).collect()]
    assert h[0] == h[1]  # documented collision: concat_ws drops NULLs
    import hashlib
    assert h[0] == hashlib.md5(b"1|3").hexdigest()


def test_nan_is_not_a_valid_price(spark):
    assert one(spark, R.clean_price, math.nan) is None
