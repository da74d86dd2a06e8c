"""Queue sources and stream operators."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bronzeflow.context import RunContext
from bronzeflow.operators.incremental import with_record_key
from bronzeflow.plans import redelivery
from bronzeflow.plans.worker import Store, batch_context, run_batch
from bronzeflow.sinks.tables import Tables


def read_queue(spark: SparkSession, fmt: str, options: dict[str, str], schema: str | None = None) -> DataFrame:
    """Messages as (body binary) from a stream source such as kafka or parquet files.

    Bound a batch with ``maxOffsetsPerTrigger`` or ``maxFilesPerTrigger``.
    """
    reader = spark.readStream.format(fmt).options(**options)
    stream = (reader.schema(schema) if schema else reader).load()
    return stream.select(F.col("value").cast("binary").alias("body"))


def dedupe_events(events: DataFrame, ts: str, event_id: str, window: str = "24 hours") -> DataFrame:
    """First event per id; the watermark is how long ids are remembered."""
    timed = events.withColumn(ts, F.col(ts).cast("timestamp"))
    return timed.withWatermark(ts, window).dropDuplicatesWithinWatermark([event_id])


def dedupe_records(records: DataFrame, site: str, measured: str, window: str = "24 hours") -> DataFrame:
    """First telemetry record per site and measurement time within the window."""
    timed = with_record_key(records, site, measured).withColumn(
        measured, F.col(measured).cast("timestamp")
    )
    return timed.withWatermark(measured, window).dropDuplicatesWithinWatermark(["record_key"])


def run_worker(
    work_messages: DataFrame, tables: Tables, store: Store, ctx: RunContext, checkpoint: str,
    every: str | None = None, packed: bool = False, clock: Callable[[], str] | None = None,
    retry: redelivery.Retry | None = None, sidecar_root: str | None = None,
) -> StreamingQuery:
    """Process a queue stream batch by batch; without ``every`` until it is drained.

    Each batch has its own time, from ``clock``, recorded so that a replay
    repeats it. Without one a draining run has the time of ``ctx`` throughout,
    and a run that goes on takes the present time.

    With ``retry`` a batch also tries the items again that are due at its time,
    and gives up those that used up their attempts. A run that goes on has
    batches without new messages too; a drained queue leaves what is not yet due
    to the next run with messages. ``sidecar_root`` is that of ``run_batch``.
    """
    told = clock or (_now if every else lambda: ctx.run_ts)

    def batch(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        own = batch_context(spark, tables, ctx, batch_id, told)
        if retry is None:
            run_batch(spark, df, tables, store, own, batch_id, packed, sidecar_root)
            return
        sent = df.filter(~F.col("_tick")) if "_tick" in df.columns else df
        due = redelivery.with_due(sent, tables, own.run_ts, batch_id)
        run_batch(spark, due, tables, store, own, batch_id, packed, sidecar_root)
        redelivery.settle(spark, tables, retry, own.run_ts, batch_id)

    if retry is not None and every:
        # Without new messages there is no batch, and so no attempt: one row a second keeps them coming.
        ticks = work_messages.sparkSession.readStream.format("rate").option("numPartitions", 1).load()
        ticks = ticks.select(F.lit(None).cast("binary").alias("body"), F.lit(True).alias("_tick"))
        work_messages = work_messages.select("body", F.lit(False).alias("_tick")).union(ticks)
    writer = work_messages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def _now() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="seconds")


def drain(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Write everything a stream has now to parquet files and stop."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
