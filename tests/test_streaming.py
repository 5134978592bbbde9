"""The incremental delivery stream agrees with the batch aggregate."""

import datetime
import os
import tempfile

from pyspark.sql import functions as F

from adlens.sources.testdata import TestdataBinding
from adlens.streaming.delivery import daily_delivery, impression_stream


def test_stream_matches_batch_counts(spark, sf_small):
    base = tempfile.mkdtemp(prefix="adlens-stream-", dir="/tmp")
    src = os.path.join(base, "impressions")
    imp = TestdataBinding(spark, sf_small).ad_impressions()
    imp.write.parquet(src)
    q = (daily_delivery(impression_stream(spark, src)).writeStream
         .outputMode("complete").format("memory").queryName("delivery_test")
         .option("checkpointLocation", os.path.join(base, "ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.table("delivery_test")
    want = (imp.groupBy(((F.year("impression_timestamp") * 10000 + F.month("impression_timestamp") * 100
                          + F.dayofmonth("impression_timestamp"))).alias("date_key"), "campaign_id")
            .agg(F.count(F.lit(1)).alias("impressions_served"),
                 F.sum("revenue_usd").alias("revenue_usd")))
    diff = (got.select("date_key", "campaign_id", "impressions_served", "revenue_usd")
            .exceptAll(want.select("date_key", "campaign_id", "impressions_served",
                                   F.col("revenue_usd").cast("decimal(38,6)"))))
    assert got.count() == want.count() > 0
    assert diff.count() == 0


def test_append_stream_emits_each_closed_day_once(spark, sf_small):
    """start_delivery in append mode: every day older than the watermark is
    written once with the batch counts; days still open are not written."""
    from adlens.streaming.delivery import start_delivery
    base = tempfile.mkdtemp(prefix="adlens-stream-append-", dir="/tmp")
    src, sink = os.path.join(base, "impressions"), os.path.join(base, "out")
    imp = TestdataBinding(spark, sf_small).ad_impressions()
    imp.write.parquet(src)
    q = start_delivery(spark, src, sink, os.path.join(base, "ckpt"), once=True)
    q.awaitTermination(600)
    got = spark.read.parquet(sink)
    day = F.to_date("impression_timestamp")
    last = imp.agg(F.max(day)).first()[0]
    want = (imp.withColumn("d", day)
            .groupBy((F.year("d") * 10000 + F.month("d") * 100 + F.dayofmonth("d")).alias("date_key"),
                     "campaign_id")
            .agg(F.count(F.lit(1)).alias("impressions_served"),
                 F.sum("revenue_usd").cast("decimal(38,6)").alias("revenue_usd")))
    cols = ["date_key", "campaign_id", "impressions_served", "revenue_usd"]
    # the watermark trails the latest event by two days: days ending by then are closed
    closed_before = int((last - datetime.timedelta(days=2)).strftime("%Y%m%d"))
    assert got.count() > 0
    assert got.groupBy("date_key", "campaign_id").count().filter("count > 1").count() == 0
    assert got.filter(F.col("date_key") >= int(last.strftime("%Y%m%d"))).count() == 0
    closed = want.filter(F.col("date_key") < closed_before)
    assert got.filter(F.col("date_key") < closed_before).select(cols).exceptAll(
        closed.select(cols)).count() == 0
    assert closed.select(cols).exceptAll(
        got.filter(F.col("date_key") < closed_before).select(cols)).count() == 0


def test_late_impressions_are_counted(spark, sf_small):
    """A row of a day that is emitted already adds to no day, but is counted."""
    from adlens.streaming.delivery import late_rows, start_delivery
    base = tempfile.mkdtemp(prefix="adlens-stream-late-", dir="/tmp")
    src, sink = os.path.join(base, "impressions"), os.path.join(base, "out")
    one = TestdataBinding(spark, sf_small).ad_impressions().limit(1)
    kept = spark.createDataFrame(one.collect(), one.schema)
    at = F.col("impression_timestamp")
    for name, days in (("a", 40), ("b", 0), ("c", 80)):  # b comes 40 days too late
        kept.withColumn("impression_timestamp", (at + F.expr(f"interval {days} days")).cast(
            one.schema["impression_timestamp"].dataType)).coalesce(1).write.mode(
            "append").parquet(src)
        q = start_delivery(spark, src, sink, os.path.join(base, "ckpt"), once=True)
        q.awaitTermination(300)
        assert late_rows(q) == (name == "b")
    got = spark.read.parquet(sink)
    assert got.count() == 1 and got.first().impressions_served == 1
