"""RANK over a whole relation, without one task that sees all rows.

The metrics are ``bigint``. The relation is materialised once in the shared checkpoint folder
(it has one row per ranked entity, so what lies under it is computed once), and one long table
``(metric, value, count)`` of the distinct values serves every rank. The 64 bits of a value
(shifted so that order is unsigned) are read as four digits of 16 bits, most significant first.
Counts are summed for each prefix of each level in one aggregate, and one window over the
children of a prefix adds up the greater siblings. A value's rank is one plus these sums
over its four levels. A window holds at most 2**16 + 1 rows at any size of the input, prefixes
depend on the value alone, and one plan serves every size. NULLs come last: at the first level
they stand below every digit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from traveltiers.session import reliable_checkpoint

DIGIT_BITS, LEVELS = 16, 4


def _prefix(value: Column, level: int) -> Column:
    """The first ``level`` digits of a value (0: the common parent of all); -1 for NULL."""
    if level == 0:
        return F.lit(0).cast("bigint")
    ordered = value.bitwiseXOR(F.lit(-(1 << 63)).cast("bigint"))
    if level < LEVELS:
        return F.coalesce(F.shiftrightunsigned(ordered, 64 - DIGIT_BITS * level), F.lit(-1).cast("bigint"))
    return F.coalesce(value, F.lit(0).cast("bigint"))  # under parent -1 a NULL has no siblings


def _histogram(df: DataFrame, metrics: list[str]) -> DataFrame:
    """``(metric, value, count)`` of all metrics; ``metric`` is the place in the list."""
    rows = df.select(F.inline(F.array(*[F.struct(F.lit(i).alias("metric"), F.col(m).alias("value")) for i, m in enumerate(metrics)])))
    return rows.groupBy("metric", "value").agg(F.count(F.lit(1)).alias("count"))


def _by_level(histogram: DataFrame) -> DataFrame:
    """Each value once a level: its prefix there and that prefix's parent."""
    levels = [F.struct(F.lit(k).alias("level"), _prefix(F.col("value"), k - 1).alias("parent"), _prefix(F.col("value"), k).alias("node"))
              for k in range(1, LEVELS + 1)]
    return histogram.select("metric", "value", "count", F.inline(F.array(*levels)))


def rank_table(histogram: DataFrame) -> DataFrame:
    """``(metric, value, rank)``: 1 + the number of rows with a greater value."""
    spread = _by_level(histogram)
    nodes = spread.groupBy("metric", "level", "parent", "node").agg(F.sum("count").alias("n"))
    # A node below 0 stands for NULL at the first level; the last level's nodes are the values themselves, in their own order.
    greater = Window.partitionBy("metric", "level", "parent").orderBy(F.desc("node")).rowsBetween(Window.unboundedPreceding, -1)
    above = nodes.select("metric", "level", "parent", "node", F.coalesce(F.sum("n").over(greater), F.lit(0)).alias("above"))
    place = ["metric", "level", "parent", "node"]
    return spread.join(above, place).groupBy("metric", "value").agg((F.lit(1) + F.sum("above")).cast("bigint").alias("rank"))


def rank_desc(df: DataFrame, metrics: dict[str, str]) -> DataFrame:
    """Add one rank column per ``{out_name: metric_column}`` (bigint); ties share a rank, gaps follow."""
    df = reliable_checkpoint(df)
    ranks = rank_table(_histogram(df, list(metrics.values())))
    # One struct as key keeps the table whole on the right side of every join, so one exchange serves all.
    ranks = ranks.select(F.struct("metric", "value").alias("_place"), F.col("rank").alias("_rank"))
    for i, (out, metric) in enumerate(metrics.items()):
        place = F.struct(F.lit(i).alias("metric"), F.col(metric).alias("value"))
        df = df.withColumn("_own", place).join(ranks, F.col("_own").eqNullSafe(F.col("_place")), "left")
        df = df.withColumnRenamed("_rank", out).drop("_own", "_place")
    return df
