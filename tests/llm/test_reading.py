"""How the operators read tables."""

from traveltiers.llm import common


def test_tables_are_read_without_buffers_as_large_as_a_row_group(spark, tmp_path):
    rows = [(i, None if i % 7 == 0 else f"text {i}", [float(i)] * (i % 3)) for i in range(300)]
    kept = spark.createDataFrame(rows, "k long, t string, x array<double>")
    kept.write.option("parquet.block.size", "1024").parquet(f"{tmp_path}/some.parquet")
    got = common.table(spark, str(tmp_path), "some")
    options = got._jdf.queryExecution().analyzed().relation().options()
    assert options.contains("parquet.hadoop.vectored.io.enabled") and options.apply("parquet.hadoop.vectored.io.enabled") == "false"
    assert sorted((r["k"], r["t"], r["x"]) for r in got.collect()) == rows
