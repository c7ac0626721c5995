"""Extras (X1-X3), the optional latest-snapshot view, sink metadata and session helpers."""

import tempfile
from datetime import datetime

from pyspark.sql import functions as F

from traveltiers.operators import extras, silver
from traveltiers.session import checkpoint_dir, cluster_conf
from traveltiers.sources.sink import TableSink


def test_changed_rows(spark):
    old = spark.createDataFrame([(1, 1.0, None), (2, 2.0, 5), (3, 3.0, 1)], "k bigint, a double, b bigint")
    new = spark.createDataFrame([(1, 1.0, None), (2, 2.0, None), (4, 4.0, 4)], "k bigint, a double, b bigint")
    got = dict(extras.changed_rows(old, new, "k", ["a", "b"]).collect())
    assert got == {1: "unchanged", 2: "updated", 3: "deleted", 4: "inserted"}


def test_changed_rows_on_repeated_and_null_keys(spark):
    kind = "k bigint, a double"
    old = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 1.0), (2, 1.0), (3, 1.0), (None, 1.0)], kind)
    new = spark.createDataFrame([(1, 2.0), (1, 1.0), (2, 1.0), (3, 1.0), (3, 3.0), (None, 1.0), (4, 1.0), (4, 1.0)], kind)
    got = [tuple(r) for r in extras.changed_rows(old, new, "k", ["a"]).collect()]
    assert dict(got) == {1: "unchanged", 2: "updated", 3: "updated", 4: "inserted", None: "unchanged"}
    assert len(got) == 5
    assert {r.change for r in extras.changed_rows(old, old, "k", ["a"]).collect()} == {"unchanged"}


def test_completeness_and_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, "x"), (2, None)], "k bigint, v string")
    got = {r.column_name: (r.null_count, r.total_count) for r in extras.completeness(df).collect()}
    assert got == {"k": (0, 3), "v": (2, 3)}
    assert [tuple(r) for r in extras.duplicate_keys(df, "k").collect()] == [(1, 2)]


def test_latest_user_snapshot(spark):
    users = spark.createDataFrame([
        (1, datetime(2024, 1, 1), 10.0), (1, datetime(2024, 1, 15), 20.0), (2, datetime(2024, 1, 1), 5.0),
    ], "user_id bigint, last_updated_at timestamp_ntz, avg_price_7day double")
    got = {r.user_id: r.avg_price_7day for r in silver.latest_user_snapshot(users).collect()}
    assert got == {1: 20.0, 2: 5.0}
    tied = spark.createDataFrame([(1, datetime(2024, 1, 1), 1.0), (1, datetime(2024, 1, 1), 2.0)], users.schema)
    for rows in (tied, tied.orderBy("avg_price_7day"), tied.orderBy(F.desc("avg_price_7day"))):
        assert silver.latest_user_snapshot(rows.coalesce(1)).first().avg_price_7day == 2.0


def test_sink_comments_and_schema(spark):
    root = tempfile.mkdtemp(prefix="tt-meta-")
    sink = TableSink(spark, database="tt_meta_test", root=root)
    df = spark.range(3).withColumn("price_usd", F.lit(1.5))
    sink.write(df, "facts", comment="Silver: test facts", properties={"layer": "silver"},
               column_comments={"price_usd": "Validated price in USD"})
    ext = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED `tt_meta_test`.`facts`").collect()}
    assert ext.get("Comment") == "Silver: test facts"
    comments = {r.col_name: r.comment for r in sink.column_comments("facts").collect()}
    assert comments == {"price_usd": "Validated price in USD"}
    db = {r.info_name: r.info_value for r in spark.sql("DESCRIBE SCHEMA `tt_meta_test`").collect()}
    assert "Tiered travel analytics" in db.get("Comment", "")
    assert sink.written["facts"] == 3


def test_checkpoint_dir_and_cluster_conf(spark):
    assert checkpoint_dir(spark)
    conf = cluster_conf(100 * 2**40, 8000)
    assert conf["spark.sql.shuffle.partitions"] == str(100 * 2**40 // 10 // (128 * 2**20))
    assert int(conf["spark.sql.files.maxPartitionBytes"]) == 256 * 2**20
    small = cluster_conf(50 * 2**20, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"


def test_failed_write_keeps_previous_version(spark):
    import pytest
    sink = TableSink(spark, database="tt_versions_test", root=tempfile.mkdtemp(prefix="tt-versions-"))
    sink.write(spark.range(4), "t")
    first = sink.location("t")
    sink.write(spark.range(2), "t")
    second = sink.location("t")
    assert first != second
    assert sink.read("t").count() == 2
    broken = spark.range(5).withColumn("x", F.when(F.col("id") == 3, F.raise_error(F.lit("boom"))))
    with pytest.raises(Exception):
        sink.write(broken, "t")
    assert sink.read("t").count() == 2 and sink.location("t") == second
    sink.write(spark.range(7), "t")
    assert sink.read("t").count() == 7
    assert len(versions(spark, "tt_versions_test", "t")) == 2  # the current one and the one before


def versions(spark, database, table):
    return [r.tableName for r in spark.sql(f"SHOW TABLES IN {database} LIKE '{table}__v*'").collect()]


def test_reader_keeps_the_version_that_it_opened(spark):
    sink = TableSink(spark, database="tt_reader_test", root=tempfile.mkdtemp(prefix="tt-reader-"))
    sink.write(spark.range(4), "t", comment="one", properties={"a": "1"})
    opened = sink.read("t")
    sink.write(spark.range(9), "t", comment="two", properties={"b": "2"})
    assert opened.count() == 4 and sink.read("t").count() == 9
    assert dict(sink.properties("t").collect()) == {"b": "2"}
    assert sink.table_comment("t").first().comment == "two"


def test_a_stop_at_any_step_leaves_a_whole_table(spark, monkeypatch):
    """Another session reads while each step of a write stops: always the old rows with the old metadata, or the new with the new."""
    import pytest
    sink = TableSink(spark, database="tt_steps_test", root=tempfile.mkdtemp(prefix="tt-steps-"))
    other = spark.newSession()

    def seen():
        df = other.table("tt_steps_test.t")
        comment = [r.data_type for r in other.sql("DESCRIBE TABLE EXTENDED tt_steps_test.t").collect() if r.col_name == "Comment"]
        return df.count(), df.columns, comment

    sink.write(spark.range(4), "t", comment="four")
    assert seen() == (4, ["id"], ["four"])
    own = type(spark).sql
    five = spark.range(5).withColumn("y", F.lit(1))
    for step, after in (("CREATE OR REPLACE VIEW", (4, ["id"], ["four"])), ("SHOW TABLES", (5, ["id", "y"], ["five"])), ("DROP TABLE", (5, ["id", "y"], ["five"]))):
        def stop(text, *args, step=step, **kw):
            if text.startswith(step):
                raise RuntimeError("stopped")
            assert seen()[0] in (4, 5)
            return own(sink.spark, text, *args, **kw)

        with monkeypatch.context() as m:
            m.setattr(type(spark), "sql", lambda self, text, *a, **kw: stop(text, *a, **kw) if self is sink.spark else own(self, text, *a, **kw))
            with pytest.raises(RuntimeError):
                sink.write(five, "t", comment="five")
        assert seen() == after
    assert sink.write(spark.range(7), "t") == 7
    assert seen()[:2] == (7, ["id"]) and len(versions(spark, "tt_steps_test", "t")) == 2


def test_table_of_an_older_layout_is_replaced(spark):
    sink = TableSink(spark, database="tt_layout_test", root=tempfile.mkdtemp(prefix="tt-layout-"))
    spark.range(3).write.saveAsTable("tt_layout_test.t")
    assert sink.write(spark.range(5), "t") == 5 and sink.read("t").count() == 5


def test_partitioned_write_rebalances(spark):
    """Many small tasks leave one file a month; a hot month gets several of the advisory size."""
    import glob
    import os
    sink = TableSink(spark, database="tt_rebalance_test", root=tempfile.mkdtemp(prefix="tt-rebalance-"))
    rows = spark.range(0, 120_000, numPartitions=12).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 4 + 2).cast("int").alias("month"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(1 << 20))
    try:
        sink.write(rows, "t", partition_by=["month"])
    finally:
        if old is None:
            spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        else:
            spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    folder = sink.location("t").removeprefix("file:")
    files = {d: len(glob.glob(f"{folder}/{d}/*.parquet")) for d in os.listdir(folder) if d.startswith("month=")}
    assert set(files) == {f"month={m}" for m in range(1, 6)}
    assert 1 < files["month=1"] < 12 and sum(files.values()) <= 30, files  # without the hint: 12 files each
    assert sink.read("t").groupBy("month").count().agg(F.sum("count")).first()[0] == 120_000


def test_changed_values(spark):
    kind = "k bigint, a double, b bigint"
    old = spark.createDataFrame([(1, 1.0, None), (2, 2.0, 5), (3, 3.0, 1), (5, 1.0, 1), (5, 2.0, 1), (None, 1.0, 1)], kind)
    new = spark.createDataFrame([(1, 1.0, None), (2, 2.0, None), (4, 4.0, 4), (5, 2.0, 1), (5, 3.0, 1), (5, 4.0, 1), (None, 1.0, 2)], kind)
    got = sorted((tuple(r) for r in extras.changed_values(old, new, "k", ["a", "b"]).collect()), key=repr)
    assert got == sorted([(2, "b", "5", None, 1, 1), (3, "a", "3.0", None, 1, 0), (3, "b", "1", None, 1, 0), (4, "a", None, "4.0", 0, 1),
                          (4, "b", None, "4", 0, 1), (5, "a", "1.0", "3.0", 1, 2), (5, "b", None, "1", 0, 1), (None, "b", "1", "2", 1, 1)], key=repr)


def test_engagement_latest_snapshot_option(spark):
    from tests.conftest import SF_SMALL
    from traveltiers.operators import gold
    from traveltiers.plans.layers import Layers
    from traveltiers.sources.fixtures import fixture

    L = Layers(fixture(spark, SF_SMALL, "A"))
    every = gold.gold_user_engagement(L.silver_users, L.silver_travel_purchases)
    latest = gold.gold_user_engagement(L.silver_users, L.silver_travel_purchases, latest_snapshot_only=True)
    n_users = L.silver_users.select("user_id").distinct().count()
    assert latest.count() == n_users == 150 and every.count() > 150
    assert latest.groupBy("user_id").count().filter("count > 1").count() == 0


def test_checkpoint_dir_is_the_configured_shared_folder(spark):
    d = checkpoint_dir(spark)
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        assert configured.rstrip("/").split("/")[-1] in d
    assert spark.sparkContext.getCheckpointDir() == d


def test_freshness_ties_go_to_the_even_digit(spark):
    from pyspark.sql import functions as F
    from traveltiers.operators.quality import _one_decimal
    ages = [0.0, 0.05, 0.25, 0.35, 0.75, 12.25, 12.35, 12.75, 36.95, 99.949999, 100000.45, -0.25, -3.1]
    rows = spark.createDataFrame([(a,) for a in ages], "a double").select("a", _one_decimal(F.col("a")).alias("t")).collect()
    assert all(r["t"] == "%.1f hours" % r["a"] for r in rows)
