"""Incremental refresh: only changed days are written, and the tables equal a full rebuild."""

import tempfile
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from traveltiers.plans import pipeline
from traveltiers.sources import sink as sinks
from traveltiers.sources.sink import TableSink

RUN = "2024-02-01 00:00:00"
KIND = ("transaction_id long, transaction_timestamp timestamp_ntz, user_id long, destination_id long, clicked boolean, purchased boolean, "
        "price_usd double, transaction_year int, transaction_month int, day_type string")


def fact(spark, rows):
    """(id, time, user, destination, clicked, purchased, price)"""
    full = [(*r, r[1] and r[1].year, r[1] and r[1].month, "weekend" if r[1] and r[1].isoweekday() > 5 else "weekday") for r in rows]
    return spark.createDataFrame(full, KIND)


def make(spark, name):
    return TableSink(spark, database=f"tt_{name}", root=tempfile.mkdtemp(prefix="tt-refresh-"))


def state(sink, table):
    return sorted((tuple(r) for r in sink.read(table).collect()), key=repr)


A = [(1, datetime(2024, 1, 1, 9), 1, 10, True, True, 5.0), (2, datetime(2024, 1, 1, 10), 2, 10, True, False, None),
     (3, datetime(2024, 1, 31, 23, 59), 1, 11, False, False, 2.0), (4, datetime(2024, 2, 1), 3, 11, True, True, None),
     (5, None, 4, 12, True, False, 1.0), (6, datetime(2024, 2, 2, 1), 5, 12, True, True, 8.0)]
#: Day 1: a price changes; 31 January: its only row goes; 1 February: unchanged; no day: a row comes; 2 February: as before; 3 March is new.
B = [(1, datetime(2024, 1, 1, 9), 1, 10, True, True, 6.0), A[1], A[3], A[4], (7, None, 9, 12, False, False, 3.0), A[5],
     (8, datetime(2024, 3, 3, 3), 70, 12, True, True, 9.0)]
CHANGED = {date(2024, 1, 1), date(2024, 1, 31), None, date(2024, 3, 3)}


def build(sink, df):
    sink.write(df, pipeline.FACT)
    pipeline.whole_days(sink, RUN)


@pytest.mark.parametrize("parted", [False, True])
def test_refresh_equals_rebuild(spark, parted):
    sink, other = make(spark, f"refresh_{parted}"), make(spark, f"rebuild_{parted}")
    build(sink, fact(spark, A))
    sink.write(fact(spark, B), pipeline.FACT, partition_by=["transaction_year", "transaction_month"] if parted else None)
    assert set(pipeline.changed_days(fact(spark, A), sink.read(pipeline.FACT))) == CHANGED
    pipeline.refreshed_days(sink, RUN)
    build(other, fact(spark, B))
    for table in ("gold_daily_revenue_metrics", "gold_daily_partials"):
        assert state(sink, table) == state(other, table)
    newest = spark.table(sink.name(sink.version("gold_daily_revenue_metrics")))
    assert {r.report_date for r in newest.collect()} == CHANGED - {date(2024, 1, 31)}  # a day without rows is only left out
    assert len(sink.versions("gold_daily_revenue_metrics")) == 2
    before = sink.versions("gold_daily_partials")
    pipeline.refreshed_days(sink, RUN)  # nothing has changed: nothing is written
    assert sink.versions("gold_daily_partials") == before


def test_stop_between_the_tables_is_made_good(spark, monkeypatch):
    sink = make(spark, "refresh_stop")
    build(sink, fact(spark, A))
    sink.write(fact(spark, B), pipeline.FACT)
    real = pipeline._write

    def stop(sink, df, table, **kw):
        if table == "gold_daily_partials":
            raise RuntimeError("stopped")
        return real(sink, df, table, **kw)

    monkeypatch.setattr(pipeline, "_write", stop)
    with pytest.raises(RuntimeError):
        pipeline.refreshed_days(sink, RUN)
    monkeypatch.setattr(pipeline, "_write", real)
    pipeline.refreshed_days(sink, RUN)
    other = make(spark, "rebuild_stop")
    build(other, fact(spark, B))
    for table in ("gold_daily_revenue_metrics", "gold_daily_partials"):
        assert state(sink, table) == state(other, table)


def test_no_refresh_without_its_base(spark, monkeypatch):
    sink = make(spark, "refresh_base")
    sink.write(fact(spark, A), pipeline.FACT)
    assert pipeline.refreshed_days(sink, RUN) is None  # no tables yet
    pipeline.whole_days(sink, RUN)
    monkeypatch.setattr(pipeline, "MAX_CHANGED_DAYS", 2)
    sink.write(fact(spark, B), pipeline.FACT)
    assert pipeline.refreshed_days(sink, RUN) is None  # too many days
    sink.write(fact(spark, A), pipeline.FACT)  # the version that the partials stand on is dropped
    assert pipeline.refreshed_days(sink, RUN) is None


def test_patches(spark, monkeypatch):
    monkeypatch.setattr(sinks, "MAX_PARTS", 3)
    sink = make(spark, "patches")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k long, v string")
    with pytest.raises(ValueError):
        sink.patch(df, "t", "k", [1])
    sink.write(df, "t", comment="first")
    new = spark.createDataFrame([("x", 1), ("y", 1)], "v string, k long")  # columns in another order
    assert sink.patch(new, "t", "k", [1], comment="second", column_comments={"v": "text"}) == 2
    assert state(sink, "t") == [(1, "x"), (1, "y"), (2, "b"), (None, "c")]
    assert sink.table_comment("t").first().comment == "second" and sink.column_comments("t").first().col_name == "v"
    sink.patch(df.where("k IS NULL").withColumn("v", F.lit("z")), "t", "k", [None, 7])
    assert state(sink, "t") == [(1, "x"), (1, "y"), (2, "b"), (None, "z")] and len(sink.versions("t")) == 3
    sink.patch(df.limit(0), "t", "k", [2])  # the parts are written as one
    assert state(sink, "t") == [(1, "x"), (1, "y"), (None, "z")] and len(sink.versions("t")) == 1
    with pytest.raises(Exception, match="beyond the patch"):
        sink.patch(df, "t", "k", [1])
    assert state(sink, "t") == [(1, "x"), (1, "y"), (None, "z")]
