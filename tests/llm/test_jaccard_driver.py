"""What the Jaccard join leaves to the driver."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import DataFrame

from traveltiers.llm import common, jaccard_join


def guessed(df: DataFrame) -> int:
    """The planner's guess of a table's bytes."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def test_rounds_of_components_do_not_multiply_the_guessed_sizes(spark):
    links = spark.createDataFrame([(bytes([i]), bytes([i + 1])) for i in range(12)], "a binary, b binary")
    got = jaccard_join.components(links)
    assert {(bytes(r["sig"]), bytes(r["comp"])) for r in got.collect()} == {(bytes([i]), bytes([0])) for i in range(13)}
    assert guessed(got) < 2**64


def test_restart_keeps_rows_and_schema_and_forgets_the_guess(spark):
    one = spark.createDataFrame([(1, "a", None), (2, None, [1.5])], "k long, t string, x array<double>")
    two = one.crossJoin(one.select("k").withColumnRenamed("k", "j"))
    got = common.restart(two)
    assert got.schema == two.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, two.collect()))
    assert guessed(got.crossJoin(got)) <= (2**63 - 1) ** 2
    assert common.restart(one.filter("k > 9")).collect() == []


@pytest.mark.parametrize("most", [1, 3, 4, 40, 1000])
def test_heavy_table_holds_the_most_frequent_and_is_chosen_by_executors(spark, monkeypatch, most):
    def whole_rows(*_):
        raise AssertionError("rows of every task are brought to the driver")

    monkeypatch.setattr(DataFrame, "toPandas", whole_rows)
    monkeypatch.setattr(jaccard_join, "HEAVY_TABLE", most)
    texts = [" ".join(f"w{i // 3 + k}" for k in range(9)) for i in range(30)] + [f"{'a b c d e'} x{i}" for i in range(7)]
    staged = jaccard_join.sets(spark.createDataFrame(list(enumerate(dict.fromkeys(texts))), "doc_id long, text string").coalesce(1)).cache()
    times = Counter(int(h) for t in dict.fromkeys(texts) for h in jaccard_join.shortened(jaccard_join.shingles(t)))
    want = sorted(((-c, h) for h, c in times.items() if c > 1))[:most]
    known, counts = jaccard_join.heavy_table(spark, staged)
    staged.unpersist()
    assert known.dtype == np.uint64 and counts.dtype == np.int64
    assert list(zip(known.tolist(), counts.tolist())) == sorted((h, -c) for c, h in want)


def test_heavy_table_of_nothing_is_empty(spark):
    staged = jaccard_join.sets(spark.createDataFrame([(1, None), (2, "a b c")], "doc_id long, text string"))
    known, counts = jaccard_join.heavy_table(spark, staged)
    assert len(known) == len(counts) == 0
