"""A lifecycle log whose reading does not grow with its history.

Events of a batch lie in the batch's folder, in buckets of their object. Every few
batches the log so far is folded into a short one, a snapshot in the same buckets:
some events per version and one per object, whatever happened before. A batch then
reads the snapshot and the few batches after it, and of both only the buckets of its
own objects. A snapshot counts from when its mark is written; what it covers is
removed afterwards, so at every moment one complete log can be read.

Version rows of the folded log are those of the whole one. Base rows are too if all
events of an object, its queued marks included, are in the log.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bronzeflow.operators import tracking
from bronzeflow.sinks.tables import read_table, remove, subfolders, write_batch
from bronzeflow.workspace import materialize

_SCHEMA = tracking.EVENT_SCHEMA + ", bucket int"
_EVENTS = [column.split()[0] for column in tracking.EVENT_SCHEMA.split(", ")]


@dataclass(frozen=True)
class History:
    """Folder of the log, buckets of its objects, batches after which it is folded.

    ``buckets`` is part of the stored layout.
    """

    root: str
    buckets: int = 16
    every: int = 8

    @property
    def batches(self) -> str:
        return f"{self.root}/batches"

    @property
    def snapshots(self) -> str:
        return f"{self.root}/snapshots"

    @property
    def marks(self) -> str:
        return f"{self.root}/marks"


def bucket_of(history: History, partition_key: str = "partition_key", row_key: str = "row_key") -> Column:
    return F.pmod(F.xxhash64(partition_key, row_key), F.lit(history.buckets)).cast("int")


def _bucketed(events: DataFrame, history: History) -> DataFrame:
    """Events with their bucket, those of a bucket in one file."""
    return events.select(*_EVENTS, bucket_of(history).alias("bucket")).repartition("bucket")


def append(events: DataFrame, history: History, batch_id: int, step: int = 1) -> None:
    """Write the events of a step of a batch, each step in a folder of its own; a replayed batch replaces itself."""
    _bucketed(events, history).write.mode("overwrite").partitionBy("bucket").parquet(f"{history.batches}/batch_id={int(batch_id)}/step={int(step)}")


def covered(spark: SparkSession, history: History) -> int:
    """The last batch that a complete snapshot holds; -1 without one."""
    return max(subfolders(spark, history.marks, "batch_id"), default=-1)


def read(spark: SparkSession, history: History, before: int | None = None, buckets: list[int] | None = None) -> DataFrame:
    """The log of all batches, or of those before one, as events; of some buckets only, if given."""
    last = covered(spark, history)
    if before is not None and last >= before:
        raise ValueError(f"the snapshot of batch {last} is not older than batch {before}")
    later = [i for i in subfolders(spark, history.batches, "batch_id") if i > last and (before is None or i < before)]
    paths = [f"{history.batches}/batch_id={i}" for i in later] + ([f"{history.snapshots}/batch_id={last}"] if last >= 0 else [])
    parts = [read_table(spark, path, _SCHEMA).select(*_EVENTS, "bucket") for path in sorted(paths)]
    log = parts[0] if parts else spark.createDataFrame([], _SCHEMA)
    for part in parts[1:]:
        log = log.unionAll(part)
    if buckets is not None:
        log = log.filter(F.col("bucket").isin(buckets))
    return log.select(*_EVENTS)


def of_objects(spark: SparkSession, history: History, objects: DataFrame, before: int | None = None) -> DataFrame:
    """The log of some objects (partition_key, row_key): only their buckets are opened.

    ``objects`` is read twice; hand in a written table.
    """
    own = objects.select("partition_key", "row_key").distinct()
    # At most as many numbers as there are buckets.
    buckets = sorted(r["b"] for r in own.select(bucket_of(history).alias("b")).distinct().collect())
    return read(spark, history, before, buckets).join(own, ["partition_key", "row_key"], "left_semi")


def fold(spark: SparkSession, history: History, batch_id: int) -> bool:
    """Fold everything before a batch into a snapshot, if ``every`` batches have gathered; whether it did.

    Run it where all earlier batches have ended, as at the start of a batch. The
    snapshot takes the time of the newest folded event, so later ones have to be newer,
    or of that time with a higher ``seq`` than three.
    """
    last = covered(spark, history)
    waiting = [i for i in subfolders(spark, history.batches, "batch_id") if last < i < batch_id]
    if len(waiting) < history.every:
        return False
    log = materialize(read(spark, history, batch_id), "history")
    at = log.agg(F.date_format(F.max("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("at")).first()["at"]
    short = tracking.compact(log, at or "1970-01-01T00:00:00+00:00")
    until = max(waiting)
    write_batch(_bucketed(short, history), history.snapshots, until, ("bucket",))
    write_batch(spark.range(1).select("id"), history.marks, until)
    prune(spark, history)
    return True


def prune(spark: SparkSession, history: History) -> None:
    """Remove what the newest complete snapshot covers; harmless to repeat."""
    last = covered(spark, history)
    for folder, newest in ((history.batches, last), (history.snapshots, last - 1), (history.marks, last - 1)):
        for i in subfolders(spark, folder, "batch_id"):
            if i <= newest:
                remove(spark, f"{folder}/batch_id={i}")
