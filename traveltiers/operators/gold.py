"""Gold layer: daily, destination, user and monthly aggregates.

Money is summed exactly as integer cents and averages and rates are rounded
half-up from integers, so results do not depend on row order.

The two dimension tables are joined *after* the fact is aggregated to one
row per join key (eager aggregation). A literal "dimension LEFT JOIN fact,
then GROUP BY" shuffles every fact row and multiplies it by duplicate
dimension rows; here the fact shuffles only partial aggregates and the
dimension side carries a multiplicity ``_m`` instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from traveltiers.functions import rules as R
from traveltiers.operators import idsets
from traveltiers.operators.ranking import rank_desc
from traveltiers.operators.silver import latest_user_snapshot

DESTINATION_KEYS = ["destination_id", "destination_name", "latitude", "longitude", "hemisphere"]
USER_KEYS = [
    "user_id", "purchase_frequency_segment", "price_segment", "avg_price_7day",
    "purchases_6month", "user_latitude", "user_longitude",
]


def _purchase_measures() -> dict[str, Column]:
    """Partial aggregates shared by every gold table (all re-aggregatable by sum/min/max)."""
    purchased = F.col("purchased")
    price = R.cents("price_usd")
    bought = F.when(purchased, price)
    return {
        "_n": F.count(F.lit(1)),
        "_n_tx": F.count("transaction_id"),
        "_clicks": F.count_if(F.col("clicked")),
        "_purchases": F.count_if(purchased),
        # SUM(CASE WHEN purchased THEN price ELSE 0 END): NULL only when every row is a NULL-price purchase.
        "_revenue": F.sum(F.when(purchased, price).otherwise(F.lit(0).cast("bigint"))),
        "_bought_sum": F.sum(bought),
        "_bought_n": F.count(bought),
    }


def purchase_pairs(purchases: DataFrame) -> DataFrame:
    """Partial aggregates per ``(user_id, destination_id)`` pair: the first level shared by the
    destination and the user tables (compute it once and pass it as ``pairs`` to both)."""
    m = _purchase_measures()
    return purchases.groupBy("user_id", "destination_id").agg(
        *[e.alias(n) for n, e in m.items()],
        F.min("transaction_timestamp").alias("_first"),
        F.max("transaction_timestamp").alias("_last"),
        F.bool_or(F.col("purchased")).alias("_any_purchased"),
    )


def fact_by_key(purchases: DataFrame, key: str, other: str, pairs: DataFrame | None = None) -> DataFrame:
    """One row per ``key`` with counts, money, first/last timestamps and exact
    distinct counts of ``other`` (all, and among purchases).

    Two hash aggregations instead of ``countDistinct``: the first groups by
    ``(key, other)``, so a hot ``key`` is spread over many reducers, and the
    second re-aggregates one row per pair. No ``Expand`` triples the rows.
    ``pairs`` (from ``purchase_pairs``) replaces the first level when given.
    """
    m = _purchase_measures()
    if pairs is None:
        pairs = purchases.groupBy(key, other).agg(
            *[e.alias(n) for n, e in m.items()],
            F.min("transaction_timestamp").alias("_first"),
            F.max("transaction_timestamp").alias("_last"),
            F.bool_or(F.col("purchased")).alias("_any_purchased"),
        )
    return pairs.groupBy(key).agg(
        *[F.sum(n).alias(n) for n in m],
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
        F.count(other).alias("_distinct_other"),
        F.count_if(F.col(other).isNotNull() & F.col("_any_purchased")).alias("_distinct_other_bought"),
    )


def dimension_groups(dim: DataFrame, keys: list[str]) -> DataFrame:
    """Group keys of the dimension with their multiplicity ``_m`` (NULLs group together).

    Grouped with map-side combine before any shuffle, so a key with very many
    (identical) snapshots costs one row per map task, never one hot task; only
    the grouped rows are then shuffled on the join key.
    """
    return dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("_m"))


def _scaled(matched: Column, m: Column, value: str, unmatched: Column) -> Column:
    """A count or sum of the literal join: ``m`` copies of the fact aggregate, or the
    value one NULL-extended row gives when nothing matches."""
    return F.when(matched, m * F.col(value)).otherwise(unmatched)


DAY_KEYS = ["report_date", "transaction_year", "transaction_month", "day_type"]
MONTH_KEYS = ["transaction_year", "transaction_month"]
_SUMS = ["_n", "_clicks", "_purchases", "_revenue", "_bought_sum", "_bought_n"]


def purchase_partials(purchases: DataFrame, keys: list[str] = DAY_KEYS) -> DataFrame:
    """Re-aggregatable partials by ``keys``, in one pass over the fact and without ``Expand``.

    One row per (keys, kind, word): the ids of that kind (``user`` or ``destination``) as bits of
    a 64-bit word (``operators.idsets``). The measures stand on the user rows alone. Everything
    merges by sum, min, max and OR, so a table of daily partials gives days, months, any other
    grain and the distinct keys of the fact. A hot day spreads over its words.
    """
    price, cents = F.col("price_usd"), R.cents("price_usd")
    bought = F.when(F.col("purchased"), cents)
    one, none, no_price = F.lit(1).cast("bigint"), F.lit(None).cast("bigint"), F.lit(None).cast("double")
    flag = lambda c: F.when(F.col(c), 1).otherwise(0).cast("bigint")
    measures = {
        "_n": one, "_clicks": flag("clicked"), "_purchases": flag("purchased"),
        # SUM(CASE WHEN purchased THEN price ELSE 0 END): NULL only when every row is a NULL-price purchase.
        "_revenue": F.when(F.col("purchased"), cents).otherwise(F.lit(0).cast("bigint")),
        "_bought_sum": bought, "_bought_n": F.when(bought.isNotNull(), 1).otherwise(0).cast("bigint"),
    }
    paid = F.when(F.col("purchased"), price)
    user = F.struct(F.lit("user").alias("kind"), idsets.word_of("user_id").alias("word"), idsets.bit_of("user_id").alias("bit"),
                    *[e.alias(n) for n, e in measures.items()], paid.alias("_paid"))
    destination = F.struct(F.lit("destination").alias("kind"), idsets.word_of("destination_id").alias("word"),
                           idsets.bit_of("destination_id").alias("bit"), *[none.alias(n) for n in measures], no_price.alias("_paid"))
    own = {"report_date": F.to_date("transaction_timestamp")}
    rows = purchases.select(*[own.get(k, F.col(k)).alias(k) for k in keys], F.inline(F.array(user, destination)))
    return rows.groupBy(*keys, "kind", "word").agg(
        F.bit_or("bit").alias("bits"), *[F.sum(n).alias(n) for n in _SUMS], F.min("_paid").alias("_min"), F.max("_paid").alias("_max"))


def merge_partials(partials: DataFrame, keys: list[str]) -> DataFrame:
    """Partials of a coarser grain from those of a finer one."""
    return partials.groupBy(*keys, "kind", "word").agg(
        F.bit_or("bits").alias("bits"), *[F.sum(n).alias(n) for n in _SUMS], F.min("_min").alias("_min"), F.max("_max").alias("_max"))


def _grain(partials: DataFrame, keys: list[str]) -> DataFrame:
    """One row per ``keys``: the sums, and the exact distinct counts as set sizes."""
    distinct = lambda kind: F.sum(F.when(F.col("kind") == kind, F.coalesce(F.bit_count("bits"), F.lit(0))).otherwise(0)).cast("bigint")
    return partials.groupBy(*keys).agg(
        *[F.sum(n).alias(n) for n in _SUMS], F.min("_min").alias("_min"), F.max("_max").alias("_max"),
        distinct("user").alias("_users"), distinct("destination").alias("_destinations"))


def gold_daily_revenue_metrics(purchases: DataFrame | None, run_ts: str | None = None, partials: DataFrame | None = None) -> DataFrame:
    """Grain: (date, year, month, day type); year, month and day type follow from the date.

    ``partials`` (from ``purchase_partials``) replaces the pass over the fact when given.
    """
    g = _grain(purchase_partials(purchases) if partials is None else partials, DAY_KEYS)
    return g.select(
        *DAY_KEYS,
        F.col("_n").alias("total_transactions"),
        F.col("_clicks").alias("total_clicks"),
        F.col("_purchases").alias("total_purchases"),
        R.pct("_purchases", "_n").alias("conversion_rate_pct"),
        R.pct("_purchases", "_clicks").alias("click_to_purchase_rate_pct"),
        R.money_from_cents("_revenue").alias("total_revenue_usd"),
        R.avg_cents("_bought_sum", "_bought_n").alias("avg_transaction_value_usd"),
        F.col("_min").alias("min_transaction_usd"), F.col("_max").alias("max_transaction_usd"),
        F.col("_users").alias("unique_users"), F.col("_destinations").alias("unique_destinations"),
        R.audit_ts(run_ts).alias("_generated_at"),
    )


def destination_metrics(destinations: DataFrame, purchases: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """destinations LEFT JOIN purchases grouped by the 5 destination columns (no ranks yet).

    ``_revenue_cents`` keeps the exact revenue the revenue rank orders by.
    """
    dim = dimension_groups(destinations, DESTINATION_KEYS)
    fact = fact_by_key(purchases.select(
        "destination_id", "user_id", "transaction_id", "clicked", "purchased",
        "price_usd", "transaction_timestamp"), "destination_id", "user_id", pairs)
    j = dim.join(fact, "destination_id", "left")
    matched = F.col("_n").isNotNull()
    m = F.col("_m")
    views = _scaled(matched, m, "_n", m)
    clicks = _scaled(matched, m, "_clicks", F.lit(0).cast("bigint"))
    bookings = _scaled(matched, m, "_purchases", F.lit(0).cast("bigint"))
    revenue = _scaled(matched, m, "_revenue", F.lit(0).cast("bigint"))
    return j.select(
        *DESTINATION_KEYS,
        views.alias("total_views"),
        clicks.alias("total_clicks"),
        bookings.alias("total_bookings"),
        R.pct(clicks, views).alias("click_rate_pct"),
        R.pct(bookings, clicks).alias("booking_rate_pct"),
        R.money_from_cents(revenue).alias("total_revenue_usd"),
        R.avg_cents("_bought_sum", "_bought_n").alias("avg_booking_value_usd"),
        F.coalesce(F.col("_distinct_other"), F.lit(0).cast("bigint")).alias("unique_visitors"),
        F.coalesce(F.col("_distinct_other_bought"), F.lit(0).cast("bigint")).alias("unique_buyers"),
        F.col("_first").alias("first_transaction"),
        F.col("_last").alias("last_transaction"),
        revenue.alias("_revenue_cents"),
    )


def gold_destination_performance(
    destinations: DataFrame,
    purchases: DataFrame,
    run_ts: str | None = None,
    pairs: DataFrame | None = None,
) -> DataFrame:
    """Destination metrics plus ``booking_rank`` and ``revenue_rank`` (RANK, DESC, NULLS LAST)."""
    metrics = destination_metrics(destinations, purchases, pairs)
    ranked = rank_desc(metrics, {"booking_rank": "total_bookings", "revenue_rank": "_revenue_cents"})
    return ranked.select(
        *DESTINATION_KEYS,
        "total_views", "total_clicks", "total_bookings", "click_rate_pct", "booking_rate_pct",
        "total_revenue_usd", "avg_booking_value_usd", "unique_visitors", "unique_buyers",
        "first_transaction", "last_transaction", "booking_rank", "revenue_rank",
        R.audit_ts(run_ts).alias("_generated_at"),
    )


def gold_user_engagement(users: DataFrame, purchases: DataFrame, run_ts: str | None = None,
                         latest_snapshot_only: bool = False, pairs: DataFrame | None = None) -> DataFrame:
    """users LEFT JOIN purchases grouped by 7 user columns; duplicate snapshots multiply counts.

    ``latest_snapshot_only`` (extra, off by default) keeps each user's newest snapshot first.
    """
    if latest_snapshot_only:
        users = latest_user_snapshot(users)
    dim = dimension_groups(users, USER_KEYS)
    fact = fact_by_key(purchases.select(
        "user_id", "destination_id", "transaction_id", "clicked", "purchased",
        "price_usd", "transaction_timestamp"), "user_id", "destination_id", pairs)
    j = dim.join(fact, "user_id", "left")
    matched = F.col("_n").isNotNull()
    m = F.col("_m")
    zero = F.lit(0).cast("bigint")
    rows = _scaled(matched, m, "_n", m)
    purchases_n = _scaled(matched, m, "_purchases", zero)
    spend = _scaled(matched, m, "_revenue", F.lit(0).cast("bigint"))
    return j.select(
        "user_id", "purchase_frequency_segment", "price_segment",
        F.col("avg_price_7day").alias("historical_avg_price"),
        F.col("purchases_6month").alias("historical_purchases"),
        "user_latitude", "user_longitude",
        _scaled(matched, m, "_n_tx", zero).alias("total_interactions"),
        _scaled(matched, m, "_clicks", zero).alias("total_clicks"),
        purchases_n.alias("total_purchases"),
        R.pct(purchases_n, rows).alias("conversion_rate_pct"),
        R.money_from_cents(spend).alias("total_spend_usd"),
        R.avg_cents("_bought_sum", "_bought_n").alias("avg_purchase_usd"),
        F.coalesce(F.col("_distinct_other"), zero).alias("destinations_viewed"),
        F.coalesce(F.col("_distinct_other_bought"), zero).alias("destinations_booked"),
        F.col("_first").alias("first_activity"),
        F.col("_last").alias("last_activity"),
        F.datediff(F.col("_last"), F.col("_first")).alias("engagement_days"),
        R.customer_tier(R.money_from_cents(spend)).alias("customer_tier"),
        R.audit_ts(run_ts).alias("_generated_at"),
    )


def gold_monthly_summary(purchases: DataFrame | None, run_ts: str | None = None, partials: DataFrame | None = None) -> DataFrame:
    """Grain (year, month) plus the previous row's revenue.

    ``partials`` of days (``purchase_partials``) roll up to months when given; otherwise the fact
    is read once. The LAG window runs over the aggregated months only: at most 12 rows per
    calendar year of data, so one task is a proven bound.
    """
    months = purchase_partials(purchases, MONTH_KEYS) if partials is None else merge_partials(partials, MONTH_KEYS)
    g = _grain(months, MONTH_KEYS)
    revenue = R.money_from_cents("_revenue")
    order = Window.orderBy(F.asc_nulls_first("transaction_year"), F.asc_nulls_first("transaction_month"))
    return g.select(
        *MONTH_KEYS,
        F.col("_n").alias("total_transactions"),
        F.col("_purchases").alias("total_bookings"),
        revenue.alias("monthly_revenue_usd"),
        R.avg_cents("_bought_sum", "_bought_n").alias("avg_booking_value_usd"),
        F.col("_users").alias("active_users"), F.col("_destinations").alias("destinations_in_demand"),
        R.pct("_purchases", "_n").alias("monthly_conversion_pct"),
        F.lag(revenue, 1).over(order).alias("prev_month_revenue"),
        R.audit_ts(run_ts).alias("_generated_at"),
    )


# Presentation order (the stored tables are unordered).
def sort_daily(daily: DataFrame) -> DataFrame:
    return daily.orderBy(F.asc_nulls_first("report_date"))


def sort_destinations(perf: DataFrame) -> DataFrame:
    return perf.orderBy(F.desc_nulls_last("total_bookings"))


def sort_monthly(monthly: DataFrame) -> DataFrame:
    return monthly.orderBy(F.asc_nulls_first("transaction_year"), F.asc_nulls_first("transaction_month"))
