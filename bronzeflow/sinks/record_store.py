"""Idempotency store of telemetry records, one folder for each day.

Keys are reserved as pending before they are sent and completed afterwards. Each
state of a batch is a folder below its day, so a run reads only the days of its own
records, and what is older than the window goes by folder. ``compact`` folds the
batches of a day into one by overwriting that day alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bronzeflow.sinks.tables import read_table, remove, subfolders

PENDING, COMPLETED = "pending", "completed"
_KEYS = "record_key string, correlation_id string, created_at string, status string, partition_date string, batch_id int"


@dataclass(frozen=True)
class RecordStore:
    """Folder of the store and days that a key is remembered."""

    root: str
    ttl_days: int = 7

    def __post_init__(self) -> None:
        if self.ttl_days < 1:
            raise ValueError("the idempotency window is at least 24 h")


def days_of(records: DataFrame) -> list[str]:
    """The days of some records: one short text a day."""
    return sorted(r["partition_date"] for r in records.select("partition_date").distinct().collect() if r["partition_date"] is not None)


def read_days(spark: SparkSession, store: RecordStore, days: list[str] | None = None, without: int | None = None) -> DataFrame:
    """(partition_date, record_key, status) of some days, or all; other folders are not opened. A batch may be left out."""
    held = read_table(spark, store.root, _KEYS)
    if days is not None:
        held = held.filter(F.col("partition_date").isin(days))
    if without is not None:
        held = held.filter(F.col("batch_id") != without)
    return held.select("partition_date", "record_key", "status")


def add(keys: DataFrame, store: RecordStore, status: str, batch_id: int) -> None:
    """Add a batch's keys (partition_date, record_key, correlation_id, created_at) in a state.

    Only the folders of these days and this batch are replaced, so a replay repeats
    itself and the completed state takes the place of the pending one.
    """
    rows = keys.select("record_key", "correlation_id", "created_at", F.lit(status).alias("status"), "partition_date", F.lit(int(batch_id)).alias("batch_id"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("partition_date", "batch_id").parquet(store.root)


def compact(spark: SparkSession, store: RecordStore, day: str, batch_id: int) -> None:
    """Fold the batches of a day up to ``batch_id`` into that one: a key once, in its furthest state.

    The folded day is written first and the batches it holds go afterwards; in between a
    key is there twice, which means the same. No other run may write the day meanwhile.
    """
    folder = f"{store.root}/partition_date={day}"
    older = [i for i in subfolders(spark, folder, "batch_id") if i < batch_id]
    if not older:
        return
    held = read_table(spark, store.root, _KEYS).filter((F.col("partition_date") == day) & (F.col("batch_id") <= batch_id))
    # The furthest state is also the smallest text.
    last = F.min(F.struct("status", "created_at", "correlation_id")).alias("last")
    folded = held.groupBy("record_key", "partition_date").agg(last).select("record_key", "last.*", "partition_date")
    staged = f"{folder}/_folded"
    folded.select("record_key", "correlation_id", "created_at", "status").write.mode("overwrite").parquet(staged)
    rows = spark.read.parquet(staged).withColumns({"partition_date": F.lit(day), "batch_id": F.lit(int(batch_id))})
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("partition_date", "batch_id").parquet(store.root)
    for i in older:
        remove(spark, f"{folder}/batch_id={i}")
    remove(spark, staged)


def purge(spark: SparkSession, store: RecordStore, as_of: str) -> list[str]:
    """Remove the folders of days before the window that ends on a date; returns the days."""
    oldest = (date.fromisoformat(as_of[:10]) - timedelta(days=store.ttl_days)).isoformat()
    gone = [day for day in subfolders(spark, store.root, "partition_date", str) if day < oldest]
    for day in gone:
        remove(spark, f"{store.root}/partition_date={day}")
    return gone
