
from __future__ import annotations

from traveltiers.operators import gold
from traveltiers.plans.layers import Layers
from traveltiers.plans.registry import register

# ---------------------------------------------------------------------------
# The ten layer tables
# ---------------------------------------------------------------------------


@register("bronze_travel_purchases", "A", "SELECT * FROM bronze_p")
def bronze_travel_purchases(L: Layers):
    return L.bronze_travel_purchases


@register("bronze_user_features", "A", "SELECT * FROM bronze_u")
def bronze_user_features(L: Layers):
    return L.bronze_user_features


@register("bronze_destinations", "A", "SELECT * FROM bronze_d")
def bronze_destinations(L: Layers):
    return L.bronze_destinations


@register("silver_travel_purchases", "A", "SELECT * FROM silver_p")
def silver_travel_purchases(L: Layers):
    return L.silver_travel_purchases


@register("silver_users", "A", "SELECT * FROM silver_u")
def silver_users(L: Layers):
    return L.silver_users


@register("silver_destinations", "A", "SELECT * FROM silver_d")
def silver_destinations(L: Layers):
    return L.silver_destinations


@register("gold_daily_revenue_metrics", "A", "SELECT * FROM gold_daily")
def gold_daily_revenue_metrics(L: Layers):
    return L.gold_daily_revenue_metrics


@register("gold_destination_performance", "A", "SELECT * FROM gold_dest")
def gold_destination_performance(L: Layers):
    return L.gold_destination_performance


@register("gold_user_engagement", "A", "SELECT * FROM gold_user")
def gold_user_engagement(L: Layers):
    return L.gold_user_engagement


@register("gold_monthly_summary", "B", "SELECT * FROM gold_monthly")
def gold_monthly_summary(L: Layers):
    return L.gold_monthly_summary


# Fixture B versions of the three other gold tables (volume: every lineitem row).
@register("gold_daily_revenue_metrics_b", "B", "SELECT * FROM gold_daily")
def gold_daily_revenue_metrics_b(L: Layers):
    return L.gold_daily_revenue_metrics


@register("gold_destination_performance_b", "B", "SELECT * FROM gold_dest")
def gold_destination_performance_b(L: Layers):
    return L.gold_destination_performance


@register("gold_user_engagement_b", "B", "SELECT * FROM gold_user")
def gold_user_engagement_b(L: Layers):
    return L.gold_user_engagement


# ---------------------------------------------------------------------------
# Windows and sorts
# ---------------------------------------------------------------------------


@register("rank_by_bookings", "B", "SELECT destination_id, total_bookings, booking_rank FROM gold_dest")
def rank_by_bookings(L: Layers):
    return L.gold_destination_performance.select("destination_id", "total_bookings", "booking_rank")


@register("rank_by_revenue", "B", "SELECT destination_id, total_revenue_usd, revenue_rank FROM gold_dest")
def rank_by_revenue(L: Layers):
    return L.gold_destination_performance.select("destination_id", "total_revenue_usd", "revenue_rank")


@register("lag_previous_month", "B",
          "SELECT transaction_year, transaction_month, monthly_revenue_usd, prev_month_revenue FROM gold_monthly")
def lag_previous_month(L: Layers):
    return L.gold_monthly_summary.select(
        "transaction_year", "transaction_month", "monthly_revenue_usd", "prev_month_revenue")


@register("sort_daily", "A", "SELECT * FROM gold_daily ORDER BY report_date NULLS FIRST")
def sort_daily(L: Layers):
    return gold.sort_daily(L.gold_daily_revenue_metrics)


@register("sort_destinations", "A", "SELECT * FROM gold_dest ORDER BY total_bookings DESC NULLS LAST")
def sort_destinations(L: Layers):
    return gold.sort_destinations(L.gold_destination_performance)


@register("sort_monthly", "B",
          "SELECT * FROM gold_monthly ORDER BY transaction_year NULLS FIRST, transaction_month NULLS FIRST")
def sort_monthly(L: Layers):
    return gold.sort_monthly(L.gold_monthly_summary)

