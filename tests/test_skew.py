"""One destination holding a third of all purchases: same results, no hot task."""

from pyspark.sql import functions as F

from tests.conftest import SF_MID
from tests import naive
from traveltiers.operators import gold
from traveltiers.plans.layers import Layers
from traveltiers.sources.fixtures import fixture


def test_hot_destination(spark):
    L = Layers(fixture(spark, SF_MID, "B"))
    fact = L.silver_travel_purchases
    hot = F.when(F.col("transaction_id") % 3 == 0, F.lit(0).cast("bigint")).otherwise(F.col("destination_id"))
    skewed = fact.withColumn("destination_id", hot)
    share = skewed.agg(F.avg((F.col("destination_id") == 0).cast("double"))).first()[0]
    assert share > 0.33

    literal = naive.destinations(L.silver_destinations, skewed)
    ours = gold.gold_destination_performance(L.silver_destinations, skewed)
    cols = literal.columns
    assert ours.select(*cols).exceptAll(literal).count() == 0
    assert literal.exceptAll(ours.select(*cols)).count() == 0

    # The first fact shuffle hashes (destination, user): the hot destination's pairs spread out.
    # (AQE coalescing is paused so the small test shuffle keeps its 8 hash partitions.)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        pairs = skewed.groupBy("destination_id", "user_id").count().filter(F.col("destination_id") == 0)
        per_part = pairs.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    finally:
        spark.conf.set(key, old)
    counts = [r["count"] for r in per_part]
    assert len(counts) >= 4 and max(counts) / sum(counts) < 0.5
