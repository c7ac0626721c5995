"""Gold semantics and the eager-aggregation rewrite."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_MID, SF_SMALL
from tests import naive
from traveltiers.operators import gold, silver
from traveltiers.plans.layers import Layers
from traveltiers.sources.fixtures import fixture

FACT_SCHEMA = ("transaction_id bigint, transaction_timestamp timestamp_ntz, user_id bigint, destination_id bigint, "
               "clicked boolean, purchased boolean, price_usd double, transaction_year int, transaction_month int, "
               "day_type string")
DEST_SCHEMA = "destination_id bigint, destination_name string, latitude double, longitude double, hemisphere string"
USER_SCHEMA = ("user_id bigint, purchase_frequency_segment string, price_segment string, avg_price_7day double, "
               "purchases_6month bigint, user_latitude double, user_longitude double")


def ts(s):
    return datetime.fromisoformat(s)


def fact_rows():
    # id, ts, user, dest, clicked, purchased, price
    raw = [
        (1, "2024-01-06 10:00:00", 1, 10, True, True, 100.0),
        (2, "2024-01-07 11:00:00", 1, 10, True, False, 50.0),
        (3, "2024-01-08 12:00:00", 2, 10, False, True, 2500.0),   # purchase without click (trap 4)
        (4, "2024-01-08 13:00:00", 2, 11, False, True, None),     # purchased, NULL price (trap 5)
        (5, "2024-03-01 09:00:00", 3, 12, True, True, 6000.0),
        (6, "2024-03-02 09:00:00", 3, 12, True, True, 0.0),
        (7, "2024-03-02 09:30:00", 99, 12, False, False, 10.0),   # orphan user
    ]
    out = []
    for i, t, u, d, c, p, price in raw:
        dt = ts(t)
        out.append((i, dt, u, d, c, p, price, dt.year, dt.month, "weekday"))
    return out


@pytest.fixture()
def frames(spark):
    fact = spark.createDataFrame(fact_rows(), FACT_SCHEMA)
    dests = spark.createDataFrame([
        (10, "Alpha", 1.0, 2.0, "Northern"),
        (11, "Beta", -1.0, 2.0, "Southern"),
        (12, "Gamma", None, None, "Southern"),
        (13, "Delta", 5.0, 5.0, "Northern"),     # no purchases (trap 1)
        (12, "Gamma", None, None, "Southern"),   # duplicate dimension row
    ], DEST_SCHEMA)
    users = spark.createDataFrame([
        (1, "low_frequency", "budget", 0.0, 0, 1.0, 1.0),
        (2, "low_frequency", "budget", 0.0, 0, 1.0, 1.0),
        (2, "low_frequency", "budget", 0.0, 0, 1.0, 1.0),   # equal snapshot: counts x2 (trap 6)
        (3, "high_frequency", "premium", 600.0, 12, None, None),
        (4, "low_frequency", "budget", 0.0, 0, None, None),  # no purchases (trap 2)
    ], USER_SCHEMA)
    return fact, dests, users


def by_key(rows, key):
    return {r[key]: r for r in rows}


def test_destination_traps(spark, frames):
    fact, dests, _ = frames
    out = by_key(gold.gold_destination_performance(dests, fact).collect(), "destination_id")
    delta = out[13]
    assert (delta.total_views, delta.total_clicks, delta.total_bookings) == (1, 0, 0)
    assert delta.click_rate_pct == 0.0 and delta.booking_rate_pct is None
    assert delta.total_revenue_usd == 0.0 and delta.unique_visitors == 0 and delta.first_transaction is None
    beta = out[11]  # only a NULL-price purchase: revenue NULL, ranked last
    assert beta.total_revenue_usd is None and beta.total_bookings == 1
    assert beta.revenue_rank == 4
    gamma = out[12]  # duplicated dimension row: counts and money doubled, distincts not
    assert gamma.total_views == 6 and gamma.total_bookings == 4 and gamma.total_revenue_usd == 12000.0
    assert gamma.unique_visitors == 2 and gamma.unique_buyers == 1
    assert gamma.avg_booking_value_usd == 3000.0
    alpha = out[10]  # 3 purchases (one unclicked) over 2 clicks
    assert alpha.booking_rate_pct == 100.0 and alpha.total_bookings == 2
    assert [out[k].booking_rank for k in (12, 10, 11, 13)] == [1, 2, 3, 4]


def test_user_traps(spark, frames):
    fact, _, users = frames
    rows = gold.gold_user_engagement(users, fact).collect()
    out = by_key(rows, "user_id")
    u4 = out[4]
    assert u4.total_interactions == 0 and u4.conversion_rate_pct == 0.0 and u4.total_spend_usd == 0.0
    assert u4.customer_tier == "bronze" and u4.engagement_days is None and u4.avg_purchase_usd is None
    u2 = out[2]  # two equal snapshots merge into one group with doubled counts
    assert len([r for r in rows if r.user_id == 2]) == 1
    assert u2.total_interactions == 4 and u2.total_purchases == 4 and u2.total_spend_usd == 5000.0
    assert u2.customer_tier == "platinum" and u2.destinations_viewed == 2 and u2.destinations_booked == 2
    assert u2.avg_purchase_usd == 2500.0 and u2.engagement_days == 0
    u3 = out[3]
    assert u3.customer_tier == "platinum" and u3.total_spend_usd == 6000.0 and u3.engagement_days == 1


def test_daily_and_monthly(spark, frames):
    fact, _, _ = frames
    extra = spark.createDataFrame([(8, None, 1, 10, True, True, 5.0, None, None, "weekday")], FACT_SCHEMA)
    daily = gold.gold_daily_revenue_metrics(fact.unionByName(extra)).collect()
    null_day = [r for r in daily if r.report_date is None]
    assert len(null_day) == 1 and null_day[0].total_transactions == 1  # trap 20
    d8 = [r for r in daily if r.report_date is not None and r.report_date.day == 8][0]
    assert d8.total_purchases == 2 and d8.total_clicks == 0 and d8.click_to_purchase_rate_pct is None
    assert d8.total_revenue_usd == 2500.0 and d8.min_transaction_usd == 2500.0
    monthly = gold.sort_monthly(gold.gold_monthly_summary(fact.unionByName(extra))).collect()
    assert [(r.transaction_year, r.transaction_month) for r in monthly] == [(None, None), (2024, 1), (2024, 3)]
    assert monthly[0].prev_month_revenue is None
    assert monthly[1].prev_month_revenue == 5.0
    assert monthly[2].prev_month_revenue == monthly[1].monthly_revenue_usd  # previous row, month 2 skipped


def _compare(a, b, cols):
    a = a.select(*cols)
    b = b.select(*cols)
    return a.exceptAll(b).count(), b.exceptAll(a).count(), a.count()


@pytest.mark.parametrize("sf_dir,fix", [(SF_SMALL, "A"), (SF_MID, "A"), (SF_MID, "B")])
def test_eager_aggregation_equals_literal_join(spark, sf_dir, fix):
    L = Layers(fixture(spark, sf_dir, fix))
    lit_d = naive.destinations(L.silver_destinations, L.silver_travel_purchases)
    ours_d = L.gold_destination_performance
    only_ours, only_lit, n = _compare(ours_d, lit_d, lit_d.columns)
    assert (only_ours, only_lit) == (0, 0) and n > 0
    lit_u = naive.users(L.silver_users, L.silver_travel_purchases)
    only_ours, only_lit, n = _compare(L.gold_user_engagement, lit_u, lit_u.columns)
    assert (only_ours, only_lit) == (0, 0) and n > 0


def test_distributed_rank_equals_window(spark):
    from pyspark.sql import Window, functions as F
    from traveltiers.operators.ranking import rank_desc
    rows = [(i, (i % 7) if i % 5 else None, (i * 2654435761) % (1 << 40) - (1 << 39)) for i in range(3000)]
    rows += [(10_000 + i, 0, 0) for i in range(1500)]  # one hot value holding a third of the rows
    rows += [(20_000 + i, v, v) for i, v in enumerate((-(1 << 63), (1 << 63) - 1, -1, 65535, 65536, -65536))]
    df = spark.createDataFrame(rows, "k bigint, m bigint, x bigint")
    ours = rank_desc(df, {"rm": "m", "rx": "x"})
    ref = df
    for out, m in (("rm", "m"), ("rx", "x")):
        ref = ref.withColumn(out, F.rank().over(Window.orderBy(F.desc_nulls_last(m))).cast("bigint"))
    assert _compare(ours, ref, ["k", "rm", "rx"])[:2] == (0, 0)


def test_fixture_a_counts(spark):
    """FIXTURES.md section 4, fixture A at sf0.01."""
    L = Layers(fixture(spark, SF_MID, "A"))
    s = L.silver_travel_purchases
    row = s.agg(F.count("*").alias("n"), F.count_if("_price_invalid").alias("pi"),
                F.count_if("_location_invalid").alias("li"),
                F.count_if(F.col("purchased") & F.col("_price_invalid")).alias("ppi")).first()
    assert (row.n, row.pi, row.li, row.ppi) == (9872, 67, 81, 17)
    assert L.gold_daily_revenue_metrics.count() == 30
    revenue = L.gold_daily_revenue_metrics.agg(F.sum(F.col("total_revenue_usd").cast("decimal(18,2)"))).first()[0]
    assert str(revenue) == "372463.64"
    tiers = dict(L.gold_user_engagement.groupBy("customer_tier").count().collect())
    assert tiers == {"platinum": 6, "gold": 107, "silver": 37, "bronze": 1421}
    seg = dict(L.silver_users.groupBy("purchase_frequency_segment").count().collect())
    assert seg == {"high_frequency": 521, "medium_frequency": 710, "low_frequency": 419}


def test_silver_filters_keys_and_flags(spark):
    from traveltiers.operators import bronze
    src = spark.createDataFrame([
        (1, "2024-01-06 00:00:00", 1, 1, None, None, 0.0, 45.0, 10.0),
        (2, "2024-01-06 00:00:00", None, 1, True, True, 1.0, 45.0, 10.0),
        (3, "2024-01-06 00:00:00", 1, None, True, True, 1.0, 45.0, 10.0),
        (4, "2024-01-06 00:00:00", 1, 1, True, True, float("nan"), 95.0, 10.0),
    ], "id bigint, t string, user_id bigint, destination_id bigint, clicked boolean, purchased boolean, "
       "price double, user_latitude double, user_longitude double")
    src = src.select("id", F.col("t").cast("timestamp_ntz").alias("ts"), "user_id", "destination_id", "clicked",
                     "purchased", F.to_date("t").alias("booking_date"), "price", "user_latitude", "user_longitude")
    s = silver.silver_travel_purchases(bronze.bronze_travel_purchases(src, "2024-02-01 00:00:00")).collect()
    assert sorted(r.transaction_id for r in s) == [1, 4]
    r1, r4 = sorted(s, key=lambda r: r.transaction_id)
    assert r1.clicked is False and r1.purchased is False and r1.price_usd == 0.0 and not r1._price_invalid
    assert r4.price_usd is None and r4._price_invalid and r4._location_invalid and r4.day_type == "weekend"


def test_shared_pairs_give_the_same_tables(spark):
    L = Layers(fixture(spark, SF_MID, "B"))
    fact = L.silver_travel_purchases
    pairs = gold.purchase_pairs(fact)
    a = gold.gold_destination_performance(L.silver_destinations, fact, L.run_ts, pairs=pairs)
    b = L.gold_destination_performance
    assert _compare(a, b, b.columns)[:2] == (0, 0)
    a = gold.gold_user_engagement(L.silver_users, fact, L.run_ts, pairs=pairs)
    b = L.gold_user_engagement
    assert _compare(a, b, b.columns)[:2] == (0, 0)


def test_partials_give_days_and_months_without_expand(spark, frames):
    """Item sets merge exactly: days and months equal countDistinct, also for NULL and negative ids and a NULL timestamp."""
    import contextlib
    import io

    fact, _, _ = frames
    odd = [(20 + i, ts(f"2024-01-{8 + i % 3:02d} 01:00:00"), u, k, True, i % 2 == 0, 1.25 * i, 2024, 1, "weekday")
           for i, (u, k) in enumerate([(-1, 10), (-64, 11), (None, 12), (63, None), (64, -65), (1 << 62, 10), (-(1 << 63), 11), (1, 10), (1, 10)])]
    fact = fact.unionByName(spark.createDataFrame(odd + [(40, None, 7, 10, True, True, None, None, None, "weekday")], FACT_SCHEMA))
    fact = fact.withColumn("report_date", F.to_date("transaction_timestamp"))
    partials = gold.purchase_partials(fact)
    for got, keys, u, d in [
        (gold.gold_daily_revenue_metrics(fact), gold.DAY_KEYS, "unique_users", "unique_destinations"),
        (gold.gold_monthly_summary(fact), gold.MONTH_KEYS, "active_users", "destinations_in_demand"),
        (gold.gold_monthly_summary(None, partials=partials), gold.MONTH_KEYS, "active_users", "destinations_in_demand"),
    ]:
        want = fact.groupBy(*keys).agg(F.countDistinct("user_id").alias(u), F.countDistinct("destination_id").alias(d))
        assert got.select(*keys, u, d).exceptAll(want).count() == 0 and got.count() == want.count()
        plan = io.StringIO()
        with contextlib.redirect_stdout(plan):
            got.explain()
        assert "Expand" not in plan.getvalue() and plan.getvalue().count("Union") == 1
    assert partials.agg(F.sum("_n")).first()[0] == fact.count()


def test_months_do_not_depend_on_the_path(spark):
    L = Layers(fixture(spark, SF_MID, "B"))
    a = gold.gold_monthly_summary(L.silver_travel_purchases, L.run_ts)
    b = gold.gold_monthly_summary(None, L.run_ts, gold.purchase_partials(L.silver_travel_purchases))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_id_sets(spark):
    from traveltiers.operators import idsets

    values = [0, 1, 63, 64, -1, -64, -65, (1 << 63) - 1, -(1 << 63), 5, 5, None]
    df = spark.createDataFrame([(v, v if v != 5 else None) for v in values], "a bigint, b bigint")
    sets = idsets.words(df, {"a": "a", "b": "b"})
    got = {(r["kind"], r["id"]) for r in idsets.ids(sets).collect()}
    assert got == {("a", v) for v in values if v is not None} | {("b", v) for v in values if v is not None and v != 5}
    assert {r["kind"]: r["n"] for r in sets.groupBy("kind").agg(idsets.size().alias("n")).collect()} == {"a": 10, "b": 9}
    other = idsets.words(spark.createDataFrame([(64,), (7,), (None,)], "a bigint"), {"a": "a"})
    assert {r["id"] for r in idsets.ids(idsets.minus(sets.where("kind = 'a'"), other)).collect()} == {v for v in values if v is not None and v != 64}
