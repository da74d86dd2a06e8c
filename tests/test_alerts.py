"""Alerts on a stream: each window once, late records stated."""

import pytest
from pyspark.sql import functions as F

from bronzeflow.operators import metrics
from bronzeflow.streaming import alerts, queue

SCHEMA = "ts timestamp, valid boolean"


@pytest.fixture
def feed(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([], SCHEMA).write.parquet(source)

    def send(*rows):
        """Write the rows, run the stream on from its checkpoint; all windows told so far."""
        if rows:
            df = spark.createDataFrame(rows, "ts string, valid boolean")
            df.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        rates = alerts.failure_rates(stream, "ts", "valid", "30 minutes", threshold=0.4)
        queue.drain(rates, out, f"{out}-checkpoint")
        told = spark.read.schema("window_start timestamp, records bigint, invalid bigint, ratio double, alert boolean").parquet(out)
        return sorted((f"{r.window_start:%H:%M}", r.records, r.invalid, r.alert) for r in told.collect())

    return send, source, out


def test_windows_are_told_once_when_they_are_over(feed):
    send, *_ = feed
    day = "2024-01-01 "
    assert send((day + "00:10", True), (day + "00:50", False), (day + "01:10", True)) == []
    # 20 minutes behind the newest: in time
    assert send((day + "00:55", False), (day + "01:20", True)) == []
    first = ("00:00", 3, 2, True)
    assert send((day + "01:50", True)) == [first]
    # a restart without new rows repeats nothing
    assert send() == [first]
    # without a verdict: time moves on, nothing is counted, a window of such rows only is not told
    assert send((day + "05:00", None), (None, False)) == [first, ("01:00", 3, 0, False)]


def test_records_that_come_too_late_are_dropped_and_found(spark, feed):
    send, source, out = feed
    day = "2024-01-01 "
    told = send((day + "00:10", True), (day + "02:00", True))
    assert told == [("00:00", 1, 0, False)]
    assert send((day + "00:20", False), (day + "00:30", False)) == told
    wrong = alerts.corrections(spark.read.parquet(out), spark.read.schema(SCHEMA).parquet(source), "ts", "valid", threshold=0.4)
    got = sorted((f"{r.window_start:%H:%M}", r.records, r.invalid, r.alert, r.told_records) for r in wrong.collect())
    assert got == [("00:00", 3, 2, True, 1), ("02:00", 1, 0, False, None)]


def test_the_batch_form_gives_the_same_rows(spark):
    rows = spark.range(500).selectExpr("timestamp_seconds(id * 97) AS ts", "id % 7 <> 0 AS valid")
    batch = metrics.failure_rate_windows(rows, "ts", "valid").collect()
    again = alerts.failure_rates(rows, "ts", "valid", "1 hour").collect()
    assert sorted(batch) == sorted(again)


def test_no_records_tell_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert alerts.failure_rates(none, "ts", "valid", "1 hour").count() == 0
    assert alerts.corrections(alerts.failure_rates(none, "ts", "valid", "1 hour"), none, "ts", "valid").count() == 0
