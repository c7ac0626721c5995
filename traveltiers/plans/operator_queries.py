"""
joins, aggregates, rules, quality checks, sinks and extras)."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from traveltiers.functions import rules as R
from traveltiers.operators import extras, gold, idsets, quality, silver
from traveltiers.operators.bronze import USER_COLUMNS
from traveltiers.plans import oracle as O
from traveltiers.plans.layers import AS_OF, AS_OF_LATE, Layers
from traveltiers.plans.pipeline import FACT, METADATA, PIPELINE, refreshed_days, run_pipeline, whole_days
from traveltiers.plans.registry import register
from traveltiers.sources.fixtures import SNAPSHOT_1, SNAPSHOT_2, Sources
from traveltiers.sources.sink import TableSink

# ---------------------------------------------------------------------------
# Scans and projections
# ---------------------------------------------------------------------------


@register("scan_source", "A", "SELECT * FROM src_p")
def scan_source(L: Layers):
    return L.sources.travel_purchase


@register("project_columns", "A", f"SELECT {', '.join(USER_COLUMNS)} FROM src_u")
def project_columns(L: Layers):
    return L.sources.user_features.select(*USER_COLUMNS)


@register("project_rename", "A", "SELECT destination_id, destination_name, dest_latitude, dest_longitude FROM bronze_d")
def project_rename(L: Layers):
    return L.bronze_destinations.select("destination_id", "destination_name", "dest_latitude", "dest_longitude")


@register("audit_columns", "A", "SELECT id, _ingested_at, _source_table FROM bronze_p")
def audit_columns(L: Layers):
    return L.bronze_travel_purchases.select("id", "_ingested_at", "_source_table")


@register("row_hash", "A", "SELECT id, ts, user_id, destination_id, _row_hash FROM bronze_p")
def row_hash(L: Layers):
    return L.bronze_travel_purchases.select("id", "ts", "user_id", "destination_id", "_row_hash")


# ---------------------------------------------------------------------------
# Filters and predicates
# ---------------------------------------------------------------------------


@register("filter_required_keys", "A",
          "SELECT id, user_id, destination_id FROM bronze_p "
          "WHERE id IS NOT NULL AND user_id IS NOT NULL AND destination_id IS NOT NULL")
def filter_required_keys(L: Layers):
    return silver.filter_required_keys(L.bronze_travel_purchases, ["id", "user_id", "destination_id"]).select(
        "id", "user_id", "destination_id")


@register("count_invalid_prices", "A", "SELECT COUNT(*) AS invalid_prices FROM silver_p WHERE _price_invalid")
def count_invalid_prices(L: Layers):
    return L.silver_travel_purchases.filter(F.col("_price_invalid")).agg(F.count(F.lit(1)).alias("invalid_prices"))


@register("count_platinum_users", "A",
          "SELECT COUNT(*) AS platinum_users FROM gold_user WHERE customer_tier = 'platinum'")
def count_platinum_users(L: Layers):
    return L.gold_user_engagement.filter(F.col("customer_tier") == "platinum").agg(
        F.count(F.lit(1)).alias("platinum_users"))


@register("validate_price", "A",
          f"SELECT id, price, {O.PRICE_USD} AS price_usd, {O.PRICE_INVALID} AS _price_invalid FROM bronze_p")
def validate_price(L: Layers):
    b = L.bronze_travel_purchases
    return b.select("id", "price", R.clean_price("price").alias("price_usd"),
                    R.price_invalid("price").alias("_price_invalid"))


@register("validate_location", "A",
          f"SELECT id, user_latitude, user_longitude, {O.LOCATION_INVALID} AS _location_invalid FROM bronze_p")
def validate_location(L: Layers):
    b = L.bronze_travel_purchases
    return b.select("id", "user_latitude", "user_longitude",
                    R.location_invalid("user_latitude", "user_longitude").alias("_location_invalid"))


@register("derive_day_type", "A",
          f"SELECT id, ts, {O.DOW.format('ts')} AS day_of_week, {O.DAY_TYPE.format('ts')} AS day_type FROM bronze_p")
def derive_day_type(L: Layers):
    b = L.bronze_travel_purchases
    return b.select("id", "ts", F.dayofweek("ts").alias("day_of_week"), R.day_type("ts").alias("day_type"))


@register("calendar_parts", "A",
          "SELECT transaction_id, transaction_timestamp, transaction_year, transaction_month, "
          "transaction_day_of_week, transaction_hour FROM silver_p")
def calendar_parts(L: Layers):
    return L.silver_travel_purchases.select(
        "transaction_id", "transaction_timestamp", "transaction_year", "transaction_month",
        "transaction_day_of_week", "transaction_hour")


# ---------------------------------------------------------------------------
# Rules (R4-R10, E1, E4, E15)
# ---------------------------------------------------------------------------


@register("clean_coordinates", "A",
          f"SELECT user_id, ts, {O.clean_coord('user_latitude', 90)} AS user_latitude, "
          f"{O.clean_coord('user_longitude', 180)} AS user_longitude FROM bronze_u")
def clean_coordinates(L: Layers):
    b = L.bronze_user_features
    return b.select("user_id", "ts", R.clean_latitude("user_latitude").alias("user_latitude"),
                    R.clean_longitude("user_longitude").alias("user_longitude"))


@register("segment_users", "A",
          "SELECT user_id, last_updated_at, purchase_frequency_segment, price_segment FROM silver_u")
def segment_users(L: Layers):
    return L.silver_users.select("user_id", "last_updated_at", "purchase_frequency_segment", "price_segment")


@register("derive_hemisphere", "A",
          "SELECT destination_id, dest_latitude, "
          "CASE WHEN dest_latitude >= 0 THEN 'Northern' ELSE 'Southern' END AS hemisphere FROM bronze_d")
def derive_hemisphere(L: Layers):
    b = L.bronze_destinations
    return b.select("destination_id", "dest_latitude", R.hemisphere("dest_latitude").alias("hemisphere"))


@register("normalize_names", "A", "SELECT destination_id, destination_name FROM silver_d")
def normalize_names(L: Layers):
    return L.silver_destinations.select("destination_id", "destination_name")


@register("default_booleans", "A",
          "SELECT transaction_id, clicked, purchased FROM silver_p")
def default_booleans(L: Layers):
    return L.silver_travel_purchases.select("transaction_id", "clicked", "purchased")


@register("round_values", "A",
          "SELECT user_id, last_updated_at, avg_price_7day, purchases_6month FROM silver_u")
def round_values(L: Layers):
    return L.silver_users.select("user_id", "last_updated_at", "avg_price_7day", "purchases_6month")


@register("tier_customers", "A", "SELECT user_id, total_spend_usd, customer_tier FROM gold_user")
def tier_customers(L: Layers):
    return L.gold_user_engagement.select("user_id", "total_spend_usd", "customer_tier")


@register("engagement_days", "A",
          "SELECT user_id, first_activity, last_activity, engagement_days FROM gold_user")
def engagement_days(L: Layers):
    return L.gold_user_engagement.select("user_id", "first_activity", "last_activity", "engagement_days")


# ---------------------------------------------------------------------------
# Joins (J1, J2 / F5)
# ---------------------------------------------------------------------------


@register("left_join_destinations", "A",
          "SELECT destination_id, destination_name, total_views, total_clicks, total_bookings, "
          "total_revenue_usd FROM gold_dest")
def left_join_destinations(L: Layers):
    return L.destination_metrics.select(
        "destination_id", "destination_name", "total_views", "total_clicks", "total_bookings", "total_revenue_usd")


@register("left_join_users", "A",
          "SELECT user_id, price_segment, total_interactions, total_purchases, conversion_rate_pct, "
          "total_spend_usd FROM gold_user")
def left_join_users(L: Layers):
    return L.gold_user_engagement.select(
        "user_id", "price_segment", "total_interactions", "total_purchases", "conversion_rate_pct",
        "total_spend_usd")


@register("anti_join_orphans", "A", """
SELECT DISTINCT 'user' AS kind, t.user_id AS orphan_id
FROM silver_p t LEFT JOIN silver_u u ON t.user_id = u.user_id WHERE u.user_id IS NULL AND t.user_id IS NOT NULL
UNION ALL
SELECT DISTINCT 'destination' AS kind, t.destination_id AS orphan_id
FROM silver_p t LEFT JOIN silver_d d ON t.destination_id = d.destination_id
WHERE d.destination_id IS NULL AND t.destination_id IS NOT NULL""")
def anti_join_orphans(L: Layers):
    sets = quality.key_sets(L.silver_travel_purchases, ["user_id", "destination_id"])
    orphans = quality.orphan_sets(sets, {"user_id": L.silver_users, "destination_id": L.silver_destinations})
    return idsets.ids(orphans).select(F.regexp_replace("kind", "_id$", "").alias("kind"), F.col("id").alias("orphan_id"))


# ---------------------------------------------------------------------------
# Aggregations
# ---------------------------------------------------------------------------


@register("group_daily", "A",
          "SELECT report_date, transaction_year, transaction_month, day_type, total_transactions FROM gold_daily")
def group_daily(L: Layers):
    return L.gold_daily_revenue_metrics.select(
        "report_date", "transaction_year", "transaction_month", "day_type", "total_transactions")


@register("group_user_attributes", "A",
          f"SELECT {', '.join(gold.USER_KEYS)}, COUNT(*) AS snapshots FROM silver_u GROUP BY {', '.join(gold.USER_KEYS)}")
def group_user_attributes(L: Layers):
    return gold.dimension_groups(L.silver_users, gold.USER_KEYS).withColumnRenamed("_m", "snapshots")


@register("group_monthly", "B", "SELECT transaction_year, transaction_month, total_transactions FROM gold_monthly")
def group_monthly(L: Layers):
    return L.gold_monthly_summary.select("transaction_year", "transaction_month", "total_transactions")


@register("agg_count_star", "A", "SELECT destination_id, total_views FROM gold_dest")
def agg_count_star(L: Layers):
    return L.destination_metrics.select("destination_id", "total_views")


@register("agg_count_column", "A", "SELECT user_id, price_segment, total_interactions FROM gold_user")
def agg_count_column(L: Layers):
    return L.gold_user_engagement.select("user_id", "price_segment", "total_interactions")


@register("agg_conditional_count", "A", "SELECT report_date, total_clicks, total_purchases FROM gold_daily")
def agg_conditional_count(L: Layers):
    return L.gold_daily_revenue_metrics.select("report_date", "total_clicks", "total_purchases")


@register("agg_conditional_sum", "B", "SELECT report_date, total_revenue_usd FROM gold_daily")
def agg_conditional_sum(L: Layers):
    return L.gold_daily_revenue_metrics.select("report_date", "total_revenue_usd")


@register("agg_conditional_avg", "B", "SELECT report_date, avg_transaction_value_usd FROM gold_daily")
def agg_conditional_avg(L: Layers):
    return L.gold_daily_revenue_metrics.select("report_date", "avg_transaction_value_usd")


@register("agg_conditional_minmax", "A",
          "SELECT report_date, min_transaction_usd, max_transaction_usd FROM gold_daily")
def agg_conditional_minmax(L: Layers):
    return L.gold_daily_revenue_metrics.select("report_date", "min_transaction_usd", "max_transaction_usd")


@register("agg_first_last_activity", "A",
          "SELECT destination_id, first_transaction, last_transaction FROM gold_dest")
def agg_first_last_activity(L: Layers):
    return L.destination_metrics.select("destination_id", "first_transaction", "last_transaction")


@register("agg_count_distinct", "A", "SELECT report_date, unique_users, unique_destinations FROM gold_daily")
def agg_count_distinct(L: Layers):
    return L.gold_daily_revenue_metrics.select("report_date", "unique_users", "unique_destinations")


@register("monthly_from_daily_partials", "B", "SELECT * FROM gold_monthly")
def monthly_from_daily_partials(L: Layers):
    """Months rolled up from the partials of days; distinct users and destinations from merged id sets."""
    return gold.gold_monthly_summary(None, L.run_ts, L.daily_partials)


@register("agg_conditional_distinct", "B", "SELECT destination_id, unique_visitors, unique_buyers FROM gold_dest")
def agg_conditional_distinct(L: Layers):
    return L.destination_metrics.select("destination_id", "unique_visitors", "unique_buyers")


@register("agg_rate_pct", "B",
          "SELECT report_date, conversion_rate_pct, click_to_purchase_rate_pct FROM gold_daily")
def agg_rate_pct(L: Layers):
    return L.gold_daily_revenue_metrics.select("report_date", "conversion_rate_pct", "click_to_purchase_rate_pct")


@register("global_totals", "A", f"""
SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE _price_invalid) AS invalid_prices,
  CAST({O.REVENUE} AS DOUBLE) AS total_revenue_usd, MAX(transaction_timestamp) AS last_transaction
FROM silver_p""")
def global_totals(L: Layers):
    s = L.silver_travel_purchases
    return s.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("_price_invalid")).alias("invalid_prices"),
        R.money_from_cents(F.sum(F.when(F.col("purchased"), R.cents("price_usd")).otherwise(F.lit(0))))
        .alias("total_revenue_usd"),
        F.max("transaction_timestamp").alias("last_transaction"),
    )


# ---------------------------------------------------------------------------
# Data quality
# ---------------------------------------------------------------------------


@register("dq_record_counts", "A", O.DQ_RECORD_COUNTS)
def dq_record_counts(L: Layers):
    spark = L.sources.travel_purchase.sparkSession
    return quality.record_count_checks(spark, L.tables())


@register("dq_referential_integrity", "A", O.DQ_REFERENTIAL)
def dq_referential_integrity(L: Layers):
    return quality.referential_integrity_checks(L.tables())


@register("dq_orphans_from_partials", "B", O.DQ_REFERENTIAL)
def dq_orphans_from_partials(L: Layers):
    """Both orphan checks from the daily partials' id sets."""
    return quality.referential_integrity_checks(L.tables(), L.daily_partials)


@register("dq_freshness", "A", O.dq_freshness())
def dq_freshness(L: Layers):
    spark = L.sources.travel_purchase.sparkSession
    return quality.freshness_checks(spark, L.tables(), AS_OF)


@register("dq_freshness_late", "A", O.dq_freshness("TIMESTAMP '2024-02-02 13:00:00'"))
def dq_freshness_late(L: Layers):
    spark = L.sources.travel_purchase.sparkSession
    return quality.freshness_checks(spark, L.tables(), AS_OF_LATE)


@register("dq_business_rules", "A", O.DQ_BUSINESS)
def dq_business_rules(L: Layers):
    return quality.business_rule_checks(L.tables())


@register("dq_audit_log", "A", O.dq_audit_log())
def dq_audit_log(L: Layers):
    spark = L.sources.travel_purchase.sparkSession
    L = Layers(L.sources, L.run_ts, share=True)
    return quality.quality_checks(spark, L.tables(), AS_OF, L.daily_partials)


@register("dq_summary", "A", O.dq_summary())
def dq_summary(L: Layers):
    spark = L.sources.travel_purchase.sparkSession
    L = Layers(L.sources, L.run_ts, share=True)
    return quality.summarize(quality.quality_checks(spark, L.tables(), AS_OF, L.daily_partials))


# ---------------------------------------------------------------------------
# Sinks (K1-K7)
# ---------------------------------------------------------------------------


def _sink(L: Layers, tag: str) -> TableSink:
    spark = L.sources.travel_purchase.sparkSession
    return TableSink(spark, database=f"traveltiers_{tag}")


@register("sink_overwrite_roundtrip", "A", "SELECT * FROM silver_d")
def sink_overwrite_roundtrip(L: Layers):
    sink = _sink(L, "roundtrip")
    sink.write(L.silver_destinations, "silver_destinations")
    sink.write(L.silver_destinations, "silver_destinations")  # second overwrite replaces, never appends
    return sink.read("silver_destinations")


@register("write_metrics", "A", """
SELECT 'bronze_travel_purchases' AS "table", COUNT(*) AS rows_written FROM bronze_p
UNION ALL SELECT 'bronze_user_features', COUNT(*) FROM bronze_u
UNION ALL SELECT 'bronze_destinations', COUNT(*) FROM bronze_d""")
def write_metrics(L: Layers):
    sink = _sink(L, "metrics")
    for name in ("bronze_travel_purchases", "bronze_user_features", "bronze_destinations"):
        sink.write(getattr(L, name), name)
    # Row counts observed during the writes, read back with the tables' names (3 rows).
    spark = L.sources.travel_purchase.sparkSession
    return spark.createDataFrame(list(sink.written.items()), "table string, rows_written bigint")


def _values(columns: str, rows: list[tuple[str, ...]]) -> str:
    """Oracle rows as VALUES."""
    said = ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {said}) v({columns})"


@register("schema_comment", "A", _values('"schema", comment', [(
    "traveltiers_schema", "Tiered travel analytics: raw, cleaned and aggregated tables with quality checks")]))
def schema_comment(L: Layers):
    return _sink(L, "schema").schema_comment()


@register("table_comment", "A", _values('"table", comment', [("silver_destinations", "Silver: cleaned destinations")]))
def table_comment(L: Layers):
    sink = _sink(L, "comment")
    sink.write(L.silver_destinations, "silver_destinations", comment="an older comment")
    sink.write(L.silver_destinations, "silver_destinations", comment=METADATA["silver_destinations"]["comment"])
    return sink.table_comment("silver_destinations")


@register("table_properties", "A", _values('"key", "value"', [
    ("layer", "gold"), ("business_domain", "finance"), ("refresh_frequency", "daily"), ("pipeline", "traveltiers")]))
def table_properties(L: Layers):
    sink = _sink(L, "properties")
    meta = METADATA["gold_daily_revenue_metrics"]
    sink.write(L.gold_daily_revenue_metrics, "gold_daily_revenue_metrics", comment=meta["comment"],
               properties={**meta["properties"], "pipeline": PIPELINE})
    return sink.properties("gold_daily_revenue_metrics")


@register("column_comments", "A", _values("col_name, data_type, comment", [
    ("transaction_id", "bigint", "Transaction identifier"), ("user_id", "bigint", "References silver_users"),
    ("destination_id", "bigint", "References silver_destinations"), ("price_usd", "double", "Validated price in USD"),
    ("_price_invalid", "boolean", "Quality flag: price missing or out of range"), ("day_type", "string", "weekend or weekday")]))
def column_comments(L: Layers):
    sink = _sink(L, "comments")
    sink.write(L.silver_travel_purchases, "silver_travel_purchases",
               column_comments=METADATA["silver_travel_purchases"]["columns"])
    return sink.column_comments("silver_travel_purchases")


@register("audit_log_persisted", "A", O.dq_audit_log())
def audit_log_persisted(L: Layers):
    """The audit log as the quality layer writes it, read back from its table."""
    sink = _sink(L, "audit")
    run_pipeline(sink.spark, L.sources, sink, run_ts=L.run_ts, as_of=AS_OF, raise_on_failure=False)
    return sink.read("dq_audit_log")


def _refreshed(L: Layers, tag: str) -> TableSink:
    """Day and month tables built from an older state of the fact (without the last month's clicks), then refreshed
    by day from the present one."""
    fact = L.silver_travel_purchases
    last = fact.agg(F.max(F.trunc("transaction_timestamp", "month"))).first()[0]
    older = fact.withColumn("clicked", F.col("clicked") & (F.trunc("transaction_timestamp", "month") != F.lit(last)))
    sink = _sink(L, tag)
    sink.write(older, FACT)
    whole_days(sink, L.run_ts)
    sink.write(fact, FACT)
    refreshed_days(sink, L.run_ts)
    return sink


@register("daily_refreshed_by_day", "A", "SELECT * FROM gold_daily")
def daily_refreshed_by_day(L: Layers):
    """The daily table after an incremental refresh of the days that have changed."""
    return _refreshed(L, "refresh_days").read("gold_daily_revenue_metrics")


@register("monthly_after_refresh", "A", "SELECT * FROM gold_monthly")
def monthly_after_refresh(L: Layers):
    """Months rolled up from the daily partials after an incremental refresh."""
    return gold.gold_monthly_summary(None, L.run_ts, _refreshed(L, "refresh_months").read("gold_daily_partials"))


@register("gate_verdict", "A", f"""
SELECT 'as given' AS sources, overall_status = 'FAIL' AS raised, fail_count AS failures, total_count AS persisted
FROM ({O.dq_summary()}) whole
UNION ALL
SELECT 'without destinations', true, CAST(3 AS BIGINT), total_count FROM ({O.dq_summary()}) whole""")
def gate_verdict(L: Layers):
    """Whether the gate raises, on the sources as they are and without any destination (three empty
    tables); the failures that it reports, and the audit rows that were persisted before it did."""
    spark = L.sources.travel_purchase.sparkSession
    empty = Sources(L.sources.travel_purchase, L.sources.user_features, L.sources.destination_location.limit(0))
    rows = []
    for name, tag, sources in (("as given", "gate", L.sources), ("without destinations", "gate_empty", empty)):
        sink = _sink(L, tag)
        try:
            run_pipeline(spark, sources, sink, run_ts=L.run_ts, as_of=AS_OF)
            raised = False
        except quality.DataQualityError:
            raised = True
        log = sink.read("dq_audit_log")
        rows.append((name, raised, log.where(F.col("status") == quality.FAIL).count(), log.count()))
    return spark.createDataFrame(rows, "sources string, raised boolean, failures bigint, persisted bigint")


@register("run_timestamp_unpinned", "A", """
SELECT 'bronze_travel_purchases' AS "table", COUNT(*) AS total_rows, CAST(1 AS BIGINT) AS distinct_times, true AS within_run FROM bronze_p
UNION ALL SELECT 'silver_users', COUNT(*), CAST(1 AS BIGINT), true FROM silver_u""")
def run_timestamp_unpinned(L: Layers):
    """Audit times without a pinned run time: one a query, and between its start and its end."""
    live = Layers(L.sources, run_ts=None)
    spark = L.sources.travel_purchase.sparkSession
    rows = []
    for name, column in (("bronze_travel_purchases", "_ingested_at"), ("silver_users", "_processed_at")):
        start = time.time()
        t = F.unix_micros(column) / 1e6
        got = getattr(live, name).agg(F.count(F.lit(1)), F.count_distinct(column), F.min(t), F.max(t)).first()
        rows.append((name, got[0], got[1], start - 0.001 <= got[2] and got[3] <= time.time() + 0.001))
    return spark.createDataFrame(rows, "table string, total_rows bigint, distinct_times bigint, within_run boolean")


# ---------------------------------------------------------------------------
# Extras (X1-X3), declared by the reference but not implemented there
# ---------------------------------------------------------------------------


@register("changed_rows", "A", f"""
SELECT COALESCE(o.user_id, n.user_id) AS user_id,
  CASE WHEN o.user_id IS NULL THEN 'inserted' WHEN n.user_id IS NULL THEN 'deleted'
       WHEN o.mean_price_7d IS DISTINCT FROM n.mean_price_7d
         OR o.last_6m_purchases IS DISTINCT FROM n.last_6m_purchases
         OR o.user_longitude IS DISTINCT FROM n.user_longitude
         OR o.user_latitude IS DISTINCT FROM n.user_latitude THEN 'updated'
       ELSE 'unchanged' END AS change
FROM (SELECT * FROM bronze_u WHERE ts = TIMESTAMP '{SNAPSHOT_1}') o
FULL OUTER JOIN (SELECT * FROM bronze_u WHERE ts = TIMESTAMP '{SNAPSHOT_2}') n ON o.user_id = n.user_id""")
def changed_rows(L: Layers):
    b = L.bronze_user_features
    cols = ["mean_price_7d", "last_6m_purchases", "user_longitude", "user_latitude"]
    old = b.filter(F.col("ts") == F.lit(SNAPSHOT_1).cast("timestamp_ntz"))
    new = b.filter(F.col("ts") == F.lit(SNAPSHOT_2).cast("timestamp_ntz"))
    return extras.changed_rows(old, new, "user_id", cols)


_SNAPSHOT = "(SELECT * FROM bronze_u WHERE ts = TIMESTAMP '{}')"


@register("changed_values", "A", "\nUNION ALL\n".join(f"""
SELECT COALESCE(o.user_id, n.user_id) AS user_id, '{c}' AS column_name, o.{c} AS old_value, n.{c} AS new_value,
  CAST(CASE WHEN o.user_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS n_old, CAST(CASE WHEN n.user_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS n_new
FROM {_SNAPSHOT.format(SNAPSHOT_1)} o FULL OUTER JOIN {_SNAPSHOT.format(SNAPSHOT_2)} n ON o.user_id = n.user_id
WHERE o.user_id IS NULL OR n.user_id IS NULL OR o.{c} IS DISTINCT FROM n.{c}"""
    for c in ("mean_price_7d", "last_6m_purchases")))
def changed_values(L: Layers):
    b = L.bronze_user_features
    old = b.filter(F.col("ts") == F.lit(SNAPSHOT_1).cast("timestamp_ntz"))
    new = b.filter(F.col("ts") == F.lit(SNAPSHOT_2).cast("timestamp_ntz"))
    out = extras.changed_values(old, new, "user_id", ["mean_price_7d", "last_6m_purchases"])
    return out.withColumns({c: F.col(c).cast("double") for c in ("old_value", "new_value")})


def _completeness_sql() -> str:
    cols = ["transaction_id", "transaction_timestamp", "user_id", "destination_id", "clicked", "purchased",
            "booking_date", "price_usd", "user_latitude", "user_longitude", "_price_invalid",
            "_location_invalid", "transaction_year", "transaction_month", "transaction_day_of_week",
            "transaction_hour", "day_type", "_ingested_at", "_processed_at"]
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count, "
        f"COUNT(*) AS total_count FROM silver_p" for c in cols)


@register("completeness", "A", _completeness_sql())
def completeness(L: Layers):
    return extras.completeness(L.silver_travel_purchases)


@register("key_uniqueness", "B",
          "SELECT transaction_id, COUNT(*) AS copies FROM silver_p GROUP BY transaction_id HAVING COUNT(*) > 1")
def key_uniqueness(L: Layers):
    return extras.duplicate_keys(L.silver_travel_purchases, "transaction_id")
