"""The narrow layers accept a streaming DataFrame unchanged."""

import os
import tempfile

from traveltiers.operators import bronze, silver


def test_bronze_silver_on_a_file_stream(spark):
    root = tempfile.mkdtemp(prefix="tt-stream-")
    src_dir = os.path.join(root, "src")
    rows = [(1, "2024-01-06 10:00:00", 7, 3, True, None, 120.5, 10.0, 20.0),
            (2, "2024-01-08 10:00:00", None, 3, True, True, 10.0, 10.0, 20.0),
            (3, "2024-01-08 11:00:00", 8, 4, False, True, -1.0, 95.0, 20.0)]
    df = spark.createDataFrame(rows, "id bigint, t string, user_id bigint, destination_id bigint, clicked boolean, "
                                     "purchased boolean, price double, user_latitude double, user_longitude double")
    df = df.selectExpr("id", "cast(t as timestamp_ntz) as ts", "user_id", "destination_id", "clicked", "purchased",
                       "cast(t as date) as booking_date", "price", "user_latitude", "user_longitude")
    df.write.parquet(src_dir)
    stream = spark.readStream.schema(df.schema).parquet(src_dir)
    out = silver.silver_travel_purchases(bronze.bronze_travel_purchases(stream, "2024-02-01 00:00:00"))
    assert out.isStreaming
    q = (out.writeStream.format("memory").queryName("tt_silver_stream")
         .option("checkpointLocation", os.path.join(root, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = {r.transaction_id: r for r in spark.sql("SELECT * FROM tt_silver_stream").collect()}
    assert sorted(got) == [1, 3]
    assert got[1].purchased is False and got[1].price_usd == 120.5 and got[1].day_type == "weekend"
    assert got[3].price_usd is None and got[3]._price_invalid and got[3]._location_invalid
