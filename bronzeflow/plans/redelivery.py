"""Work items that failed for a passing reason: tried again later, a bounded number of times.

After each batch the open redeliveries are written as a whole: those open before,
without the objects that the batch tried, and those it has to try again. A batch
reads the newest such table only, which grows with what is open, not with
history. A replayed batch starts from the table before it and replaces its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bronzeflow.sinks.tables import Tables, read_table, remove, subfolders, write_batch

_OPEN = "s3_key string, correlation_id string, message string, attempts int, due_at timestamp"
_TRIED = "s3_key string, correlation_id string, message string, redeliver boolean"
_EXHAUSTED = "correlation_id string, error_type string, file_reference string, failure_reason string, batch_id int"
# Fixed value: reason code of messages that were delivered too often
EXHAUSTED = "delivery_attempts_exhausted"
_KEPT_TABLES = 3


@dataclass(frozen=True)
class Retry:
    """Attempts in all, and the wait before the next one: `wait_seconds`, doubled each time, up to `most_seconds`."""

    attempts: int = 10
    wait_seconds: float = 60.0
    most_seconds: float = 3600.0


def open_redeliveries(spark: SparkSession, tables: Tables, before: int | None = None) -> DataFrame:
    """(s3_key, correlation_id, message, attempts, due_at) still to be tried again, after the last batch or before a given one."""
    batches = [b for b in subfolders(spark, tables.redeliveries, "batch_id") if before is None or b < before]
    if not batches:
        return spark.createDataFrame([], _OPEN)
    return read_table(spark, f"{tables.redeliveries}/batch_id={batches[-1]}", _OPEN)


def with_due(messages: DataFrame, tables: Tables, at: str, batch_id: int) -> DataFrame:
    """Messages (body) of a batch with those that are due at its time.

    An object that is both due and in the batch is one attempt: repeated items of a batch are dropped.
    """
    due = open_redeliveries(messages.sparkSession, tables, batch_id).filter(F.col("due_at") <= F.lit(at).cast("timestamp"))
    return messages.select("body").unionByName(due.select(F.encode("message", "UTF-8").alias("body")))


def settle(spark: SparkSession, tables: Tables, retry: Retry, at: str, batch_id: int) -> None:
    """Write what is open after a batch, and a letter for each message that used up its attempts.

    A success, a lasting failure and a refusal all end a redelivery; only attempts that
    fail for a passing reason count, one for each batch.
    """
    tried = (
        read_table(spark, f"{tables.outcomes}/batch_id={int(batch_id)}", _TRIED)
        .filter("message IS NOT NULL")
        .groupBy("s3_key")
        .agg(F.max_by(F.struct("correlation_id", "message"), "redeliver").alias("_item"), F.max("redeliver").alias("_again"))
    )
    before = open_redeliveries(spark, tables, batch_id)
    held = before.join(tried, "s3_key", "full_outer")
    count = F.coalesce("attempts", F.lit(0)) + F.col("_again").cast("int")
    wait = F.least(F.lit(retry.wait_seconds) * F.pow(F.lit(2.0), count - 1), F.lit(retry.most_seconds))
    due = F.timestamp_micros(F.unix_micros(F.lit(at).cast("timestamp")) + (wait * 1_000_000).cast("bigint"))
    again = held.filter("_again").select(
        "s3_key", "_item.correlation_id", "_item.message", count.alias("attempts"), due.alias("due_at")
    )
    waiting = held.filter("_again IS NULL").select(*before.columns)
    left = F.col("attempts") < retry.attempts
    write_batch(
        again.filter(~left).select(
            F.coalesce("correlation_id", F.lit("unknown")).alias("correlation_id"),
            F.lit(EXHAUSTED).alias("error_type"),
            F.col("s3_key").alias("file_reference"),
            F.concat(F.lit("failed "), "attempts", F.lit(" times for a passing reason")).alias("failure_reason"),
        ),
        tables.exhausted,
        batch_id,
    )
    write_batch(waiting.unionByName(again.filter(left)), tables.redeliveries, batch_id)
    # A batch may be replayed from the table before it; older ones are never read again.
    for old in subfolders(spark, tables.redeliveries, "batch_id")[:-_KEPT_TABLES]:
        remove(spark, f"{tables.redeliveries}/batch_id={old}")


def exhausted(spark: SparkSession, tables: Tables) -> DataFrame:
    """Dead letters of messages that used up their attempts."""
    return read_table(spark, tables.exhausted, _EXHAUSTED)
