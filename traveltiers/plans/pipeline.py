"""End-to-end run: bronze -> silver -> gold -> quality gate.

Each layer is written through a ``TableSink`` and read back before the next
layer is built, exactly like the scheduled job's hand-over by table. That
also cuts lineage at every layer boundary, so a lost executor only recomputes
work inside one layer. The quality run is one plan over the written tables;
its 17 rows are collected once, written as the audit log, and only then does
the gate raise.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from traveltiers.operators import bronze, gold, quality, silver
from traveltiers.operators.extras import changed_rows
from traveltiers.session import checkpoint_dir, reliable_checkpoint
from traveltiers.sources.fixtures import Sources
from traveltiers.sources.sink import OWN, TableSink

PIPELINE = "traveltiers"

# Table metadata (comment, properties, column comments), set after every overwrite.
METADATA: dict[str, dict] = {
    "bronze_travel_purchases": {
        "comment": "Bronze: raw purchase events with ingestion metadata",
        "properties": {"layer": "bronze", "source_table": "travel_purchase"},
        "columns": {"id": "Transaction identifier (primary key)", "ts": "Event time",
                    "user_id": "User identifier (foreign key)",
                    "destination_id": "Destination identifier (foreign key)",
                    "purchased": "Whether the purchase was completed", "price": "Price in USD",
                    "_ingested_at": "Ingestion time", "_row_hash": "MD5 of id|ts|user_id|destination_id"},
    },
    "bronze_user_features": {
        "comment": "Bronze: raw user feature snapshots",
        "properties": {"layer": "bronze", "source_table": "user_features"},
        "columns": {"user_id": "User identifier", "mean_price_7d": "Mean price over 7 days",
                    "last_6m_purchases": "Purchases in the last 6 months"},
    },
    "bronze_destinations": {
        "comment": "Bronze: raw destination reference data",
        "properties": {"layer": "bronze", "source_table": "destination_location"},
        "columns": {"destination_id": "Destination identifier", "destination_name": "Destination name"},
    },
    "silver_travel_purchases": {
        "comment": "Silver: cleaned purchases with quality flags and calendar parts",
        "properties": {"layer": "silver", "data_quality": "validated"},
        "columns": {"transaction_id": "Transaction identifier", "user_id": "References silver_users",
                    "destination_id": "References silver_destinations", "price_usd": "Validated price in USD",
                    "_price_invalid": "Quality flag: price missing or out of range",
                    "day_type": "weekend or weekday"},
    },
    "silver_users": {
        "comment": "Silver: cleaned user snapshots with segments",
        "properties": {"layer": "silver", "data_quality": "validated"},
        "columns": {"user_id": "User identifier", "purchase_frequency_segment": "high / medium / low frequency",
                    "price_segment": "premium / standard / budget"},
    },
    "silver_destinations": {
        "comment": "Silver: cleaned destinations",
        "properties": {"layer": "silver", "data_quality": "validated"},
        "columns": {"destination_id": "Destination identifier", "destination_name": "Title-cased name",
                    "hemisphere": "Northern or Southern"},
    },
    "gold_daily_revenue_metrics": {
        "comment": "Gold: daily revenue and transaction metrics",
        "properties": {"layer": "gold", "business_domain": "finance", "refresh_frequency": "daily"},
        "columns": {"report_date": "Report date", "conversion_rate_pct": "Purchases per transaction, percent",
                    "total_revenue_usd": "Revenue in USD"},
    },
    "gold_daily_partials": {
        "comment": "Gold: re-aggregatable daily partials, with users and destinations as id sets",
        "properties": {"layer": "gold", "refresh_frequency": "daily"},
        "columns": {"kind": "user or destination", "word": "Id without its last six bits",
                    "bits": "Which of the word's 64 ids occur"},
    },
    "gold_destination_performance": {
        "comment": "Gold: destination performance",
        "properties": {"layer": "gold", "business_domain": "marketing", "refresh_frequency": "daily"},
        "columns": {"destination_id": "Destination identifier", "booking_rank": "Rank by bookings (1 = top)",
                    "revenue_rank": "Rank by revenue (1 = top)"},
    },
    "gold_user_engagement": {
        "comment": "Gold: user engagement and value tier",
        "properties": {"layer": "gold", "business_domain": "customer", "refresh_frequency": "daily"},
        "columns": {"user_id": "User identifier", "customer_tier": "platinum / gold / silver / bronze"},
    },
    "gold_monthly_summary": {
        "comment": "Gold: monthly summary",
        "properties": {"layer": "gold", "business_domain": "executive", "refresh_frequency": "monthly"},
        "columns": {},
    },
    "dq_audit_log": {"comment": "Data-quality check results of the last run", "properties": {}, "columns": {}},
}


@dataclass
class PipelineResult:
    rows_written: dict[str, int]
    audit: list
    status: str
    report: dict[str, dict]


def report_metrics() -> dict[str, dict[str, Column]]:
    """Figures reported after each write, observed during the write itself."""
    return {
        "silver_travel_purchases": {"invalid_prices": F.count_if(F.col("_price_invalid"))},
        # Exact: summed as cents (the per-day values are already rounded to cents).
        "gold_daily_revenue_metrics": {
            "total_revenue_cents": F.sum(F.round(F.col("total_revenue_usd") * 100).cast("bigint"))},
        "gold_user_engagement": {"platinum_users": F.count_if(F.col("customer_tier") == "platinum")},
    }


def _write(sink: TableSink, df: DataFrame, table: str, source_schema: str | None = None, own: dict[str, str] | None = None,
           days: list | None = None, **kw) -> DataFrame:
    """Write a table with its metadata and read it back; with ``days``, only the rows of these report dates are replaced."""
    meta = METADATA.get(table, {})
    props = {**meta.get("properties", {}), "pipeline": PIPELINE, **(own or {})}
    if source_schema and props.get("layer") == "bronze":
        props["source_system"] = source_schema
    said = dict(comment=meta.get("comment"), properties=props, column_comments=meta.get("columns"), observe=report_metrics().get(table))
    if days is None:
        sink.write(df, table, **said, **kw)
    else:
        sink.patch(df, table, "report_date", days, **said, **kw)
    return sink.read(table)


LAYERS = ("bronze", "silver", "gold", "quality")
_TABLES = [name for name, _ in quality.LAYER_TABLES]


def run_bronze(sink: TableSink, sources: Sources, run_ts: str | None = None,
               source_schema: str = bronze.DEFAULT_SOURCE_SCHEMA) -> None:
    """The three bronze tables from the sources."""
    for table, make, df in [
        ("bronze_travel_purchases", bronze.bronze_travel_purchases, sources.travel_purchase),
        ("bronze_user_features", bronze.bronze_user_features, sources.user_features),
        ("bronze_destinations", bronze.bronze_destinations, sources.destination_location),
    ]:
        _write(sink, make(df, run_ts, source_schema), table, source_schema)


def run_silver(sink: TableSink, run_ts: str | None = None, partition_silver: bool = False) -> None:
    """The three silver tables from the written bronze ones."""
    _write(sink, silver.silver_travel_purchases(sink.read("bronze_travel_purchases"), run_ts), "silver_travel_purchases",
           partition_by=["transaction_year", "transaction_month"] if partition_silver else None)
    _write(sink, silver.silver_users(sink.read("bronze_user_features"), run_ts), "silver_users")
    _write(sink, silver.silver_destinations(sink.read("bronze_destinations"), run_ts), "silver_destinations")


FACT = "silver_travel_purchases"
#: Property of the daily partials: the version of the fact that they and the day and month tables stand on.
BUILT_FROM = OWN + "built_from"
#: Beyond so many changed days (the days stand in a view's text) the day tables are written whole.
MAX_CHANGED_DAYS = 400


def run_gold(sink: TableSink, run_ts: str | None = None, refresh: bool = False) -> None:
    """The daily partials and the four gold tables from the written silver ones.

    With ``refresh`` the partials and the daily table get only the days whose facts have changed.
    """
    fact = sink.read(FACT)
    partials = refreshed_days(sink, run_ts) if refresh else None
    if partials is None:
        partials = whole_days(sink, run_ts)
    _write(sink, gold.gold_monthly_summary(None, run_ts, partials), "gold_monthly_summary")
    # The (user, destination) first level is shared by the next two tables: one scan and one
    # shuffle of the fact, checkpointed into the shared folder, instead of one per table.
    pairs = reliable_checkpoint(gold.purchase_pairs(fact))
    _write(sink, gold.gold_destination_performance(sink.read("silver_destinations"), fact, run_ts, pairs=pairs),
           "gold_destination_performance")
    _write(sink, gold.gold_user_engagement(sink.read("silver_users"), fact, run_ts, pairs=pairs), "gold_user_engagement")


def whole_days(sink: TableSink, run_ts: str | None = None) -> DataFrame:
    """The stored daily partials and the daily table from the whole fact; returns the partials.

    Days, months and the orphan checks come from the partials, so the fact is read once for all of them.
    """
    own = {BUILT_FROM: ",".join(sink.versions(FACT))}
    partials = _write(sink, gold.purchase_partials(sink.read(FACT)), "gold_daily_partials", own=own)
    _write(sink, gold.gold_daily_revenue_metrics(None, run_ts, partials), "gold_daily_revenue_metrics")
    return partials


def changed_days(old: DataFrame, new: DataFrame) -> list:
    """The report dates (None: NULL) on which two states of the fact hold different rows, as to what the daily partials read.

    One multiset difference by day, without a join; a hot day spreads over its values. The result is bounded by the calendar.
    """
    cols = ["transaction_timestamp", "user_id", "destination_id", "clicked", "purchased", "price_usd"]
    by_day = [df.select(F.to_date("transaction_timestamp").alias("report_date"), *cols) for df in (old, new)]
    return [r.report_date for r in changed_rows(*by_day, "report_date", cols).where("change <> 'unchanged'").collect()]


def on_days(fact: DataFrame, days: list) -> DataFrame:
    """The fact's rows of these days. Year and month prune the partitions of a partitioned fact, the times row groups."""
    known = sorted(d for d in days if d is not None)
    at = F.col("transaction_timestamp")
    hit = F.lit(False)
    if known:
        months = F.lit(False)
        for year in sorted({d.year for d in known}):
            months |= (F.col("transaction_year") == year) & F.col("transaction_month").isin(sorted({d.month for d in known if d.year == year}))
        hit = (at >= F.lit(str(known[0])).cast("timestamp_ntz")) & (at < F.lit(str(known[-1] + timedelta(days=1))).cast("timestamp_ntz"))
        hit = months & hit & F.to_date(at).isin(known)
    return fact.where(hit | at.isNull() if None in days else hit)


def refreshed_days(sink: TableSink, run_ts: str | None = None) -> DataFrame | None:
    """The partials and the daily table with only their changed days written anew; returns the partials.

    The present fact is compared with the version that the partials were built from. None, with
    nothing done, where that version or the tables are gone or too many days have changed: then
    ``whole_days`` is due. The daily table goes first and the partials, which name the fact's
    version, last: a run that stops between them finds the same days again. Days that have not
    changed keep their ``_generated_at``.
    """
    now, before = sink.versions(FACT), (sink.own_property("gold_daily_partials", BUILT_FROM) or "").split(",")
    if not sink.version("gold_daily_revenue_metrics") or len(before) != 1 or not before[0] or not sink.spark.catalog.tableExists(f"{sink.database}.{before[0]}"):
        return None
    fact = sink.read(FACT)
    days = changed_days(sink.read(before[0]), fact) if now != before else []
    if len(days) > MAX_CHANGED_DAYS:
        return None
    if days:
        part = reliable_checkpoint(gold.purchase_partials(on_days(fact, days)))
        _write(sink, gold.gold_daily_revenue_metrics(None, run_ts, part), "gold_daily_revenue_metrics", days=days)
        _write(sink, part, "gold_daily_partials", own={BUILT_FROM: ",".join(now)}, days=days)
    return sink.read("gold_daily_partials")


def run_quality(sink: TableSink, as_of: str | None = None) -> list:
    """The 17 checks over the written tables, written as the audit log; a missing table gives FAIL rows."""
    names = [*_TABLES, "gold_daily_partials"]
    there = {t: sink.read(t) for t in names if sink.version(t)}
    tables = {t: there.get(t, sink.name(t)) for t in _TABLES}
    audit_rows = quality.audit_rows(sink.spark, tables, as_of, there.get("gold_daily_partials"))
    _write(sink, sink.spark.createDataFrame(audit_rows, quality.CHECK_SCHEMA), "dq_audit_log")
    return audit_rows


def run_pipeline(
    spark: SparkSession,
    sources: Sources | None,
    sink: TableSink,
    run_ts: str | None = None,
    as_of: str | None = None,
    source_schema: str = bronze.DEFAULT_SOURCE_SCHEMA,
    partition_silver: bool = False,
    raise_on_failure: bool = True,
    layers: Sequence[str] = LAYERS,
    refresh: bool = False,
) -> PipelineResult:
    """The named ``layers``, in their order; each reads the tables that the ones before have written,
    in this run or an earlier one. ``sources`` are needed for bronze alone. Without the quality layer
    the status is PASS and the audit empty. With ``refresh`` the day tables get their changed days only,
    and ``report`` has the figures of what was written."""
    unknown = set(layers) - set(LAYERS)
    if unknown:
        raise ValueError(f"no such layer: {sorted(unknown)}")
    checkpoint_dir(spark)  # a cluster session without the shared folder fails before the first write
    if "bronze" in layers:
        run_bronze(sink, sources, run_ts, source_schema)
    if "silver" in layers:
        run_silver(sink, run_ts, partition_silver)
    if "gold" in layers:
        run_gold(sink, run_ts, refresh)
    audit_rows = run_quality(sink, as_of) if "quality" in layers else []
    failed = any(r["status"] == quality.FAIL for r in audit_rows)
    report = {table: dict(sink.observed.get(table, {})) for table in sink.written}
    daily = report.get("gold_daily_revenue_metrics", {})
    if daily.get("total_revenue_cents") is not None:
        daily["total_revenue_usd"] = daily["total_revenue_cents"] / 100
    result = PipelineResult(dict(sink.written), audit_rows, quality.FAIL if failed else quality.PASS, report)
    if raise_on_failure:
        quality.gate(audit_rows)
    return result
