"""Invariants across layers on fixture B at sf0.01."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_MID
from traveltiers.plans.layers import Layers
from traveltiers.sources.fixtures import fixture


@pytest.fixture(scope="module")
def L(spark):
    return Layers(fixture(spark, SF_MID, "B"))


def test_daily_and_monthly_totals_equal_silver_rows(L):
    n = L.silver_travel_purchases.count()
    daily = L.gold_daily_revenue_metrics.agg(F.sum("total_transactions")).first()[0]
    monthly = L.gold_monthly_summary.agg(F.sum("total_transactions")).first()[0]
    assert n == daily == monthly == 60000


def test_revenue_agrees_across_grains(L):
    cents = lambda c: F.sum(F.round(F.col(c) * 100).cast("bigint"))
    daily = L.gold_daily_revenue_metrics.agg(cents("total_revenue_usd")).first()[0]
    monthly = L.gold_monthly_summary.agg(cents("monthly_revenue_usd")).first()[0]
    dest = L.gold_destination_performance.agg(cents("total_revenue_usd")).first()[0]
    assert daily == monthly == dest == 23917407505  # FIXTURES.md: 239,174,075.05


def test_destination_invariants(L):
    perf = L.gold_destination_performance
    assert perf.count() == L.silver_destinations.count()
    bad = perf.filter((F.col("unique_buyers") > F.col("unique_visitors"))
                      | (F.col("total_bookings") > F.col("total_views"))).count()
    assert bad == 0
    assert perf.agg(F.min("booking_rank"), F.min("revenue_rank")).first() == (1, 1)


def test_engagement_invariants(L):
    eng = L.gold_user_engagement
    assert eng.count() == 1571
    bad = eng.filter((F.col("destinations_booked") > F.col("destinations_viewed"))
                     | (F.col("total_purchases") > F.col("total_interactions"))
                     | (F.col("engagement_days") < 0)).count()
    assert bad == 0


def test_fixture_b_counts(L):
    """FIXTURES.md fixture B at sf0.01."""
    s = L.silver_travel_purchases
    row = s.agg(F.count_if("_price_invalid").alias("pi"), F.count_if("purchased").alias("p"),
                F.count_if(F.col("purchased") & F.col("_price_invalid")).alias("ppi"),
                F.count_if("clicked").alias("c")).first()
    assert (row.pi, row.p, row.ppi, row.c) == (31770, 20046, 10626, 29936)
    assert L.gold_daily_revenue_metrics.count() == 2499
    assert L.gold_monthly_summary.count() == 83
    assert L.gold_daily_revenue_metrics.filter(F.col("click_to_purchase_rate_pct") > 100).count() == 259


def test_results_do_not_depend_on_cluster_conf(spark, L):
    """The production settings (no estimate-based broadcasts, other partitioning) give the same rows."""
    from traveltiers.session import cluster_conf

    tables = ["gold_daily_revenue_metrics", "gold_destination_performance", "gold_user_engagement",
              "gold_monthly_summary"]
    before = {t: getattr(L, t).collect() for t in tables}
    conf = {k: v for k, v in cluster_conf(50 * 2**30, 8).items() if spark.conf.isModifiable(k)}
    conf["spark.sql.files.maxPartitionBytes"] = str(256 * 1024)  # many small splits on the test files
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        fresh = Layers(fixture(spark, SF_MID, "B"))
        for t in tables:
            after = getattr(fresh, t).collect()
            assert sorted(map(tuple, after), key=str) == sorted(map(tuple, before[t]), key=str), t
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
