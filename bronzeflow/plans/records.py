"""Record path: validate telemetry records, reserve their keys, count what happened."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bronzeflow.context import RunContext
from bronzeflow.operators import incremental, messages, metrics
from bronzeflow.sinks import record_store
from bronzeflow.sinks.tables import Tables, subfolders, write_batch
from bronzeflow.workspace import materialize


@dataclass(frozen=True)
class RecordRun:
    """Outputs of a record run."""

    emitted: DataFrame
    dead_letters: DataFrame
    stats: DataFrame


def process_records(
    payloads: DataFrame, store: DataFrame, order_by: list[str], ctx: RunContext
) -> RecordRun:
    """Plan a run over JSON payloads against the idempotency store.

    New and pending keys are emitted. ``emit`` adds them to the store as pending
    before the emission and as completed after it.
    """
    # emitted records, dead letters and counters start from it
    checked = materialize(messages.check_records(payloads), "checked")
    valid = checked.filter(F.size("errors") == 0).withColumns(
        {
            "SiteID": F.try_variant_get("document", "$.SiteID", "bigint"),
            "measdatetime": F.try_variant_get("document", "$.measdatetime", "string"),
        }
    )
    keyed = incremental.with_record_key(valid.drop("document", "errors"))
    emitted = incremental.reserve_first(keyed, store, order_by)
    counted = checked.selectExpr("1L AS retrieved", "size(errors) = 0 AS valid", "false AS emitted")
    sent = emitted.selectExpr("0L AS retrieved", "NULL AS valid", "true AS emitted")
    stats = metrics.invocation_stats(
        counted.unionByName(sent).withColumn("correlation_id", F.lit(ctx.correlation_id)),
        ["correlation_id"],
    )
    return RecordRun(
        emitted,
        messages.record_dead_letters(checked, ctx.correlation_id, ctx.run_ts, ctx.schema_version),
        stats,
    )


def emit(run: RecordRun, tables: Tables, ctx: RunContext, batch_id: int) -> None:
    """Write the outputs in order: reserve, emit, complete; then drop the days that are no longer remembered.

    A crash in between leaves keys pending, which the next run emits again. A
    replay of the same batch must see the store without that batch.
    """
    emitted, stats = materialize(run.emitted, "emitted"), materialize(run.stats, "stats")
    reserved = reserved_keys(emitted, ctx)
    store = record_store.RecordStore(tables.record_store)
    record_store.add(reserved, store, record_store.PENDING, batch_id)
    write_batch(emitted, tables.record_events, batch_id)
    write_batch(run.dead_letters, tables.record_dead_letters, batch_id)
    write_batch(stats, tables.record_metrics, batch_id)
    record_store.add(reserved, store, record_store.COMPLETED, batch_id)
    days = subfolders(emitted.sparkSession, store.root, "partition_date", str)
    # the window ends with the newest day met, so a run over old records remembers them too
    record_store.purge(emitted.sparkSession, store, min([ctx.run_date, *days[-1:]]))


def reserved_keys(emitted: DataFrame, ctx: RunContext) -> DataFrame:
    """Rows of the idempotency store for the records of a run."""
    return emitted.select(
        "partition_date", "record_key",
        F.lit(ctx.correlation_id).alias("correlation_id"),
        F.lit(ctx.run_ts).alias("created_at"),
    )


def read_store(
    spark: SparkSession, tables: Tables, days: list[str] | None = None, without: int | None = None
) -> DataFrame:
    """The idempotency store, of some days only if given; a batch that is replayed is left out."""
    store = record_store.RecordStore(tables.record_store)
    return record_store.read_days(spark, store, days, without)
