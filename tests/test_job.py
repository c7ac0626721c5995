"""The batch job reads the three source tables by name from the catalog."""

import tempfile

from tests.conftest import SF_SMALL
from traveltiers.plans import job
from traveltiers.sources.fixtures import fixture


def test_job_from_catalog_tables(spark):
    root = tempfile.mkdtemp(prefix="tt-job-")
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS tt_raw LOCATION '{root}/raw'")
    src = fixture(spark, SF_SMALL, "A")
    for name, df in [("travel_purchase", src.travel_purchase), ("user_features", src.user_features),
                     ("destination_location", src.destination_location)]:
        df.write.mode("overwrite").option("path", f"{root}/raw/{name}").saveAsTable(f"tt_raw.{name}")
    code = job.main(["--source-schema", "tt_raw", "--target-schema", "tt_job", "--root", f"{root}/out",
                     "--run-ts", "2024-02-01 00:00:00", "--as-of", "2024-02-01 12:00:00"])
    assert code == 0
    assert spark.table("tt_job.silver_travel_purchases").count() == 991
    assert spark.table("tt_job.dq_audit_log").count() == 17
    src_col = spark.table("tt_job.bronze_travel_purchases").select("_source_table").first()[0]
    assert src_col == "tt_raw.travel_purchase"


def test_job_runs_layers_by_themselves(spark):
    """Each layer reads what an earlier run wrote; a layer without its input fails, and nothing else is written."""
    import pytest

    root = tempfile.mkdtemp(prefix="tt-layers-")
    base = ["--sf-dir", SF_SMALL, "--fixture", "A", "--target-schema", "tt_layers", "--root", root,
            "--run-ts", "2024-02-01 00:00:00", "--as-of", "2024-02-01 12:00:00"]
    with pytest.raises(Exception):
        job.main([*base, "--layers", "silver"])
    assert job.main([*base, "--layers", "quality"]) == 1  # no table yet: FAIL rows, kept in the audit log
    log = spark.table("tt_layers.dq_audit_log").collect()
    assert len(log) == 17 and {r.status for r in log} == {"FAIL"}
    assert job.main([*base, "--layers", "bronze"]) == 0
    assert not spark.catalog.tableExists("tt_layers.silver_users")
    assert job.main([*base, "--layers", "silver, gold"]) == 0
    assert job.main([*base, "--layers", "silver,gold", "--refresh"]) == 0
    assert job.main([*base, "--layers", "quality"]) == 0
    whole = tempfile.mkdtemp(prefix="tt-whole-")
    assert job.main([*base[:5], "tt_whole", "--root", whole, *base[8:]]) == 0
    for t in ("gold_daily_revenue_metrics", "gold_destination_performance", "gold_user_engagement", "gold_monthly_summary", "dq_audit_log"):
        a, b = spark.table(f"tt_layers.{t}"), spark.table(f"tt_whole.{t}")
        assert a.exceptAll(b).count() == 0 and a.count() == b.count(), t
    with pytest.raises(SystemExit):
        job.main([*base, "--layers", "platinum"])
