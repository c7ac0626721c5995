"""Quality checks, the audit log, the gate and the end-to-end pipeline."""

import tempfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from traveltiers.operators import quality
from traveltiers.plans.layers import AS_OF, AS_OF_LATE, Layers
from traveltiers.plans.pipeline import run_pipeline
from traveltiers.sources.fixtures import fixture
from traveltiers.sources.sink import TableSink


def test_audit_log_fixture_a(spark):
    L = Layers(fixture(spark, SF_SMALL, "A"))
    rows = quality.quality_checks(spark, L.tables(), AS_OF).collect()
    assert len(rows) == 17
    assert sorted(rows[0].asDict()) == quality.CHECK_COLUMNS
    status = {(r.check, r.table): (r.status, r.actual) for r in rows}
    assert status[("referential_integrity", "silver_travel_purchases -> silver_users")] == ("WARN", "1")
    assert status[("referential_integrity", "silver_travel_purchases -> silver_destinations")] == ("WARN", "89")
    assert status[("data_freshness", "bronze_travel_purchases")] == ("PASS", "12.0 hours")
    assert all(r.status == "PASS" for r in rows if r.check == "record_count")
    summary = quality.summarize(spark.createDataFrame(rows, quality.CHECK_SCHEMA)).first()
    assert (summary.pass_count, summary.warn_count, summary.fail_count, summary.total_count) == (15, 2, 0, 17)
    assert summary.overall_status == "PASS"


def test_freshness_warns_after_a_day(spark):
    L = Layers(fixture(spark, SF_SMALL, "A"))
    rows = quality.freshness_checks(spark, L.tables(), AS_OF_LATE).collect()
    assert {(r.status, r.actual) for r in rows} == {("WARN", "37.0 hours")}
    assert {r.layer for r in rows} == {"bronze", "silver", "gold"}


def test_empty_table_fails_count_and_is_infinitely_old(spark):
    empty = spark.createDataFrame([], "_ingested_at timestamp")
    c = quality.record_count_check(spark, empty, "bronze_travel_purchases", "bronze").first()
    assert (c.status, c.actual) == ("FAIL", "0")
    f = quality.freshness_check(empty, "bronze_travel_purchases", "_ingested_at", AS_OF).first()
    assert (f.status, f.actual) == ("WARN", "inf hours")


def test_missing_table_is_a_fail_row(spark):
    c = quality.record_count_check(spark, "no_such_db.no_such_table", "silver_users", "silver").first()
    assert c.status == "FAIL" and c.check == "record_count" and c.actual


def test_missing_tables_are_fail_rows(spark):
    rows = quality.quality_checks(spark, {}, AS_OF).collect()
    assert len(rows) == 17 and {r.status for r in rows} == {"FAIL"}
    assert sorted(r.check for r in rows).count("referential_integrity") == 2


def test_unreadable_table_is_fail_rows_and_the_others_are_checked(spark, tmp_path):
    tables = Layers(fixture(spark, SF_SMALL, "A")).tables()
    good = {(r.check, r.table): (r.status, r.actual) for r in quality.audit_rows(spark, tables, AS_OF)}
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "part-0.parquet").write_bytes(b"PAR1 this is no parquet file PAR1")
    tables["silver_users"] = spark.read.schema(tables["silver_users"].schema).parquet(str(tmp_path / "t"))
    rows = quality.audit_rows(spark, tables, AS_OF)
    spark.createDataFrame(rows, quality.CHECK_SCHEMA)
    got = {(r.check, r.table): (r.status, r.actual) for r in rows}
    broken = {("record_count", "silver_users"), ("referential_integrity", "silver_travel_purchases -> silver_users")}
    assert {k: v for k, v in got.items() if k not in broken} == {k: v for k, v in good.items() if k not in broken}
    assert len(rows) == 17 and all(got[k][0] == "FAIL" and got[k][1] for k in broken)


def test_business_rules(spark):
    fact = spark.createDataFrame([(-1.0,), (2.0,)], "price_usd double")
    daily = spark.createDataFrame([(101.0,), (50.0,), (None,)], "conversion_rate_pct double")
    rows = quality.business_rule_checks({"silver_travel_purchases": fact,
                                         "gold_daily_revenue_metrics": daily}).collect()
    assert [(r.status, r.actual) for r in rows] == [("FAIL", "1"), ("FAIL", "1")]


def test_gate_raises_only_on_fail(spark):
    ok = [{"status": "PASS"}, {"status": "WARN"}]
    quality.gate(ok)
    with pytest.raises(quality.DataQualityError):
        quality.gate(ok + [{"status": "FAIL"}])


def test_pipeline_end_to_end_and_gate_after_audit_write(spark):
    root = tempfile.mkdtemp(prefix="tt-pipeline-")
    sink = TableSink(spark, database="tt_pipeline_test", root=root)
    src = fixture(spark, SF_SMALL, "A")
    res = run_pipeline(spark, src, sink, run_ts="2024-02-01 00:00:00", as_of=AS_OF)
    assert res.status == "PASS" and len(res.audit) == 17
    assert res.rows_written["silver_travel_purchases"] == 991
    assert res.rows_written["gold_daily_revenue_metrics"] == 30
    assert res.rows_written["gold_user_engagement"] == 157
    # The figures reported after the writes (FIXTURES.md, fixture A at sf0.001).
    assert res.report["silver_travel_purchases"]["invalid_prices"] == 5
    assert res.report["gold_daily_revenue_metrics"]["total_revenue_cents"] == 4136776
    assert res.report["gold_user_engagement"]["platinum_users"] == 2
    assert sink.read("dq_audit_log").count() == 17
    props = dict(sink.properties("gold_monthly_summary").collect())
    assert props["layer"] == "gold" and props["refresh_frequency"] == "monthly"
    assert props["pipeline"] == "traveltiers"
    comments = {r.col_name: r.comment for r in sink.column_comments("silver_users").collect()}
    assert "customer_tier" not in comments and comments["price_segment"]

    # A broken source: no destinations -> record counts FAIL; the audit log is written, then the gate raises.
    broken = src.__class__(src.travel_purchase, src.user_features, src.destination_location.limit(0))
    sink2 = TableSink(spark, database="tt_pipeline_broken", root=tempfile.mkdtemp(prefix="tt-broken-"))
    with pytest.raises(quality.DataQualityError):
        run_pipeline(spark, broken, sink2, run_ts="2024-02-01 00:00:00", as_of=AS_OF)
    audit = sink2.read("dq_audit_log")
    fails = audit.filter(F.col("status") == "FAIL").select("table").collect()
    assert {r.table for r in fails} == {"bronze_destinations", "silver_destinations",
                                        "gold_destination_performance"}


def test_overwrite_replaces_rows(spark):
    sink = TableSink(spark, database="tt_overwrite_test", root=tempfile.mkdtemp(prefix="tt-ow-"))
    df = spark.range(5)
    assert sink.write(df, "t", comment="first", properties={"layer": "x"}) == 5
    assert sink.write(spark.range(3), "t", properties={"layer": "y"}) == 3
    assert sink.read("t").count() == 3
    assert dict(sink.properties("t").collect())["layer"] == "y"


def test_freshness_on_a_missing_table_is_a_fail_row(spark):
    """Deliberate difference: the reference prints and skips it; here it is an audit row."""
    rows = quality.freshness_checks(spark, {}, AS_OF,
                                    columns=[("gold_daily_revenue_metrics", "_generated_at")]).collect()
    assert len(rows) == 1 and rows[0].status == "FAIL" and rows[0].layer == "gold"
    assert rows[0].check == "data_freshness" and rows[0].actual


def test_partitioned_silver_gives_the_same_tables(spark):
    src = fixture(spark, SF_SMALL, "A")
    kw = dict(run_ts="2024-02-01 00:00:00", as_of=AS_OF)
    plain = TableSink(spark, database="tt_plain", root=tempfile.mkdtemp(prefix="tt-plain-"))
    parted = TableSink(spark, database="tt_parted", root=tempfile.mkdtemp(prefix="tt-parted-"))
    a = run_pipeline(spark, src, plain, **kw)
    b = run_pipeline(spark, src, parted, partition_silver=True, **kw)
    b2 = run_pipeline(spark, src, parted, partition_silver=True, **kw)  # second run: slot swap, partitioned
    assert a.rows_written == b.rows_written == b2.rows_written
    assert a.report == b.report
    for t in ("gold_daily_revenue_metrics", "gold_destination_performance", "gold_user_engagement"):
        x, y = plain.read(t), parted.read(t)
        assert x.exceptAll(y.select(*x.columns)).count() == 0 and y.count() == x.count()
    assert "transaction_year" in parted.read("silver_travel_purchases").columns
