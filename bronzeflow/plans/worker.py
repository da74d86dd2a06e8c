"""One batch of work items: validate, version, guard, store, publish, record.

The order of the writes is the contract: processing state, bronze copy, sidecar,
event, and the completed state last, because "completed" means "event
published". A batch that ends midway leaves its objects processing. Every table
is written per batch and replaced on replay; version and event id are resolved
from completed versions only, so a replay repeats the same events.
"""

from __future__ import annotations

import time
import warnings
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bronzeflow import contracts
from bronzeflow.context import RunContext
from bronzeflow.functions import keys
from bronzeflow.operators import (
    builders, failures, guard, incremental, messages, metrics, ownership, tracking,
)
from bronzeflow.operators.schema import first_error
from bronzeflow.sinks import bronze, history, sidecars
from bronzeflow.sinks.messages import event_messages
from bronzeflow.sinks.tables import Tables, read_batch, read_table, write_batch
from bronzeflow.workspace import materialize

Store = Callable[[DataFrame], DataFrame]

_OUTCOME = (
    "correlation_id string, s3_key string, discovered boolean, downloaded boolean, "
    "stored boolean, emitted boolean, failed boolean, redeliver boolean, message string, batch_id int"
)
_SOURCE = "PVDAQ-historical-worker"
_COUNTERS = (
    "source string, datasets_discovered bigint, datasets_downloaded bigint, datasets_stored bigint, "
    "datasets_emitted bigint, datasets_failed bigint, duration_ms double, correlation_id string, error string, batch_id int"
)
_DEAD_LETTER = "correlation_id string, error_type string, file_reference string, failure_reason string"


@dataclass(frozen=True)
class Prepared:
    """A batch before any content is read."""

    checked: DataFrame
    guarded: DataFrame


def prepare(
    work_messages: DataFrame,
    log_of: Callable[[DataFrame], DataFrame],
    owners_of: Callable[[DataFrame], DataFrame],
    ctx: RunContext,
) -> Prepared:
    """Validate bodies, drop repeated items, resolve versions and settle path ownership.

    ``log_of`` gives the lifecycle events of earlier batches of some objects
    (partition_key, row_key), ``owners_of`` the owners of some items' paths. Checked messages, items and located items,
    metadata only, are written once because several outputs start from them: the
    source is read, and a body parsed, once a batch.
    """
    checked = materialize(messages.check_work_items(work_messages).drop("document"), "checked")
    items = materialize(
        incremental.unique_work_items(messages.accepted_work_items(checked)), "items"
    )
    own = items.selectExpr(
        f"{keys.partition_key('site_id')} AS partition_key", f"{keys.row_key('s3_key')} AS row_key"
    )
    versions = tracking.fold_versions(log_of(own))
    versioned = incremental.resolve_versions(items, versions, unique=True)
    located = materialize(builders.with_paths(versioned, ctx), "located")
    return Prepared(checked, guard.guard_paths(located, owners_of(located)))


def lifecycle(
    items: DataFrame, kind: str, ctx: RunContext, seq: int, extra: dict[str, Column] | None = None
) -> DataFrame:
    """Lifecycle events of one kind for versioned items."""
    return tracking.as_events(
        items,
        kind,
        F.lit(ctx.run_ts).cast("timestamp"),
        {
            "partition_key": F.expr(keys.partition_key("site_id")),
            "row_key": F.expr(keys.row_key("s3_key")),
            "s3_key": F.col("s3_key"),
            "version": F.col("version"),
            **(extra or {}),
        },
        F.lit(seq),
    )


def completed_events(items: DataFrame, ctx: RunContext, seq: int) -> DataFrame:
    names = ["category", "storage_path", "file_hash", "ingestion_id", "source_url", "row_count",
             "metadata_path"]
    values = {name: F.col(name) for name in names}
    values |= {"completed_at": F.lit(ctx.run_ts), "ingestion_time": F.lit(ctx.run_ts)}
    return lifecycle(items, tracking.COMPLETED, ctx, seq, values)


def with_artifacts(stored: DataFrame, ctx: RunContext) -> DataFrame:
    """Add sidecar and envelope with their contract violations."""
    with_sidecar = builders.with_checked(
        stored, "metadata", builders.metadata(ctx), contracts.metadata_file(ctx)
    )
    return builders.with_checked(
        with_sidecar, "envelope", builders.envelope(ctx), contracts.dataset_available(ctx)
    )


def run_batch(
    spark: SparkSession,
    work_messages: DataFrame,
    tables: Tables,
    store: Store,
    ctx: RunContext,
    batch_id: int,
    packed: bool = False,
    sidecar_root: str | None = None,
) -> None:
    """Process one batch and write all its outputs, in order, and its counters, however it ends.

    ``packed`` keeps many small objects in few bronze files instead of a
    folder per dataset. With ``sidecar_root`` each sidecar is also a file under
    its metadata path there; an object whose file cannot be written is not published.
    """
    begun, error = time.monotonic(), None
    try:
        _process(spark, work_messages, tables, store, ctx, batch_id, packed, sidecar_root)
    except BaseException as raised:
        error = type(raised).__name__
        raise
    finally:
        try:
            write_counters(spark, tables, ctx, batch_id, (time.monotonic() - begun) * 1000.0, error)
        except Exception as unwritten:
            # what ended the batch is what the caller has to see
            if error is None:
                raise
            warnings.warn(f"no counters of batch {batch_id}: {unwritten}", stacklevel=2)


def _process(
    spark: SparkSession, work_messages: DataFrame, tables: Tables, store: Store, ctx: RunContext,
    batch_id: int, packed: bool, sidecar_root: str | None,
) -> None:
    log, owners = version_log(tables), ownership.Index(tables.root)
    # all earlier batches have ended, so what they logged may be folded
    history.fold(spark, log, batch_id)
    prepared = prepare(
        work_messages,
        lambda objects: history.of_objects(spark, log, objects, batch_id),
        # a path carries its date, so only today's paths can have an owner
        lambda located: ownership.owners_of(located, spark, owners, ctx.run_date, batch_id),
        ctx,
    )

    # the settled attempts are written once; everything below starts from them
    write_batch(prepared.guarded, tables.attempts, batch_id)
    attempts = read_batch(spark, tables.attempts, batch_id, prepared.guarded.schema)
    admitted = attempts.filter("admitted").drop("admitted", "path_owner")
    refused = attempts.filter(~F.col("admitted"))
    refusal = guard.collision_reason()
    step = batch_id * 10  # batches of one run share its timestamp and follow each other by seq
    started = lifecycle(attempts, tracking.PROCESSING, ctx, step + 1)
    _record(started, tables, batch_id, 1)

    stored = store(admitted)
    by_dataset = "content" in stored.columns and not packed
    folders = bronze.BRONZE_PARTITIONS if by_dataset else bronze.PACKED_PARTITIONS
    write_batch(
        bronze.with_partitions(stored, ctx.run_date), tables.bronze, batch_id, folders
    )
    kept = read_batch(spark, tables.bronze, batch_id, stored.drop("content").schema)
    kept = kept.drop(*bronze.BRONZE_PARTITIONS)
    copied = kept.filter(F.col("error_class").isNull())
    missing = kept.filter(F.col("error_class").isNotNull())
    ownership.write_owners(copied.select("storage_path", "s3_key"), owners, ctx.run_date, batch_id)

    built = materialize(with_artifacts(copied, ctx), "built")
    sidecar_ok = F.size("metadata_errors") == 0
    event_ok = sidecar_ok & (F.size("envelope_errors") == 0)
    documents = built.filter(sidecar_ok).select(
        "metadata_path", "version", "s3_key", builders.as_json("metadata").alias("metadata_json")
    )
    write_batch(documents, tables.sidecars, batch_id)
    placed = F.lit(True)
    if sidecar_root is not None:
        built = _with_placement(built, sidecars.write_sidecars(documents, sidecar_root))
        placed = F.col("error_class").isNull()
    published = built.filter(event_ok & placed)
    write_batch(event_messages(published, ctx), tables.events, batch_id)

    bad = built.filter(~event_ok & placed)
    failed = (
        _failure(refused, F.lit("store"), refusal, F.lit(False))
        .unionByName(_failure(missing, F.lit("store"), F.col("error_text"), _transient()))
        .unionByName(
            _failure(
                bad,
                F.when(sidecar_ok, "envelope").otherwise("metadata"),
                F.when(sidecar_ok, first_error(F.col("envelope_errors"))).otherwise(
                    first_error(F.col("metadata_errors"))
                ),
                F.lit(False),
            )
        )
    )
    if sidecar_root is not None:
        failed = failed.unionByName(
            _failure(built.filter(~placed), F.lit("store"), F.col("error_text"), _transient())
        )
    routed = failures.route_failures(failed)
    letters = failures.dead_letters(
        routed,
        F.col("correlation_id"),
        F.col("error_type"),
        failures.file_reference(F.col("stage"), F.lit(None), F.lit(None), F.col("s3_key")),
        F.col("reason"),
    ).unionByName(messages.rejected_work_items(prepared.checked))
    write_batch(letters, tables.dead_letters, batch_id, ("error_type",))

    known = ["site_id", "s3_key", "version"]
    _record(
        completed_events(published, ctx, step + 2).unionByName(
            lifecycle(routed.filter("mark_failed").select(*known), tracking.FAILED, ctx, step + 3)
        ),
        tables,
        batch_id,
        2,
    )
    copied_anyway = F.col("stage").isin("metadata", "envelope")
    rejected = prepared.checked.filter(F.col("stage").isNotNull())
    write_batch(
        _outcome(published, F.lit(True), F.lit(True), F.lit(False), _message())
        .unionByName(_outcome(routed, copied_anyway, F.lit(False), F.col("redeliver"), F.col("message")))
        .unionByName(_outcome(rejected, F.lit(False), F.lit(False), F.lit(False), F.lit(None).cast("string"))),
        tables.outcomes,
        batch_id,
    )


def _with_placement(built: DataFrame, put: DataFrame) -> DataFrame:
    """Built items with the error of their sidecar's file; both sides have one row per path."""
    told = put.select(
        "metadata_path", F.col("error_class").alias("_class"), F.col("error_text").alias("_text")
    )
    joined = built.join(told, "metadata_path", "left").withColumns(
        {"error_class": F.col("_class"), "error_text": F.col("_text")}
    )
    return materialize(joined.drop("_class", "_text"), "placed")


def _transient() -> Column:
    link = F.struct(
        F.col("error_class").alias("error_class"),
        F.lit(None).cast("string").alias("error_family"),
        F.col("http_status").alias("http_status"),
    )
    return failures.is_transient(F.array(link))


def _failure(rows: DataFrame, stage: Column, reason: Column, transient: Column) -> DataFrame:
    return rows.select(
        "site_id", "s3_key", "version", "correlation_id",
        stage.alias("stage"), reason.alias("reason"), transient.alias("transient"), _message().alias("message"),
        F.lit(True).alias("identified"),
    )


def _message() -> Column:
    """The accepted work item as a message body that may be sent again; absent fields stay absent."""
    return F.to_json(F.struct(*messages.WORK_ITEM_TYPES))


def _outcome(rows: DataFrame, stored: Column, emitted: Column, redeliver: Column, message: Column) -> DataFrame:
    return rows.select(
        "correlation_id",
        "s3_key",
        F.lit(False).alias("discovered"),
        stored.alias("downloaded"),
        stored.alias("stored"),
        emitted.alias("emitted"),
        (~emitted).alias("failed"),
        redeliver.alias("redeliver"),
        message.alias("message"),
    )


def redelivered(spark: SparkSession, tables: Tables) -> DataFrame:
    """(s3_key, correlation_id, message) whose last attempt failed for a passing reason, to be sent again.

    A later attempt at the key, with whatever end, clears it. Rejected messages
    are no attempts: they have no work item and so no message here.
    """
    attempts = read_table(spark, tables.outcomes, _OUTCOME).filter("message IS NOT NULL")
    last = F.max_by(F.struct("correlation_id", "redeliver", "message"), "batch_id").alias("last")
    open_keys = attempts.groupBy("s3_key").agg(last).filter("last.redeliver")
    return open_keys.select("s3_key", "last.correlation_id", "last.message")


def batch_context(
    spark: SparkSession, tables: Tables, ctx: RunContext, batch_id: int, clock: Callable[[], str]
) -> RunContext:
    """``ctx`` at the time the batch first started; a replayed batch finds that time recorded."""
    held = read_table(spark, f"{tables.batch_times}/batch_id={int(batch_id)}", "run_ts string").first()
    if held is not None:
        return replace(ctx, run_ts=held.run_ts)
    run_ts = clock()
    write_batch(spark.createDataFrame([(run_ts,)], "run_ts string"), tables.batch_times, batch_id)
    return replace(ctx, run_ts=run_ts)


def run_counters(spark: SparkSession, tables: Tables, ctx: RunContext) -> DataFrame:
    """Counters per correlation id over all batches, rejected messages included."""
    log = read_table(spark, tables.outcomes, _OUTCOME).withColumn("ts", F.lit(ctx.run_ts))
    counters = metrics.run_metrics(log, _SOURCE, "ts", "ts")
    return counters.withColumn("duration_ms", F.lit(ctx.elapsed_seconds * 1000.0))


def write_counters(
    spark: SparkSession, tables: Tables, ctx: RunContext, batch_id: int, duration_ms: float, error: str | None
) -> None:
    """Counters of one batch per correlation id, from what it wrote before it ended.

    A batch that ended well has its outcomes. One that raised, ``error``, counts
    what its tables hold: copies and events that were written, all other attempts
    failed; messages it refused are not known then. One that raised before its
    attempts were settled leaves a row of zeros for its run.
    """
    log = _log_of_outcomes(spark, tables, batch_id) if error is None else _log_of_tables(spark, tables, batch_id)
    timed = log.withColumn("ts", F.lit(ctx.run_ts))
    counted = metrics.run_metrics(timed, _SOURCE, "ts", "ts")
    if error is not None:
        zeros = {f"datasets_{stage}": F.lit(0).cast("bigint") for stage in metrics.STAGES}
        none = spark.range(1).select(
            F.lit(_SOURCE).alias("source"), *[v.alias(n) for n, v in zeros.items()],
            F.lit(0.0).alias("duration_ms"), F.lit(ctx.correlation_id).alias("correlation_id"),
        )
        counted = counted if not log.isEmpty() else none
    counted = counted.withColumns({"duration_ms": F.lit(float(duration_ms)), "error": F.lit(error).cast("string")})
    write_batch(counted, tables.batch_metrics, batch_id)


def _log_of_outcomes(spark: SparkSession, tables: Tables, batch_id: int) -> DataFrame:
    return read_batch(spark, tables.outcomes, batch_id, T.StructType.fromDDL(_OUTCOME)).drop("batch_id")


def _log_of_tables(spark: SparkSession, tables: Tables, batch_id: int) -> DataFrame:
    """One row per settled attempt; all three tables have one row per object."""

    def written(path: str, schema: str) -> DataFrame:
        return read_table(spark, f"{path}/batch_id={int(batch_id)}", schema)

    attempts = written(tables.attempts, "correlation_id string, s3_key string, event_id string")
    copied = written(tables.bronze, "s3_key string, error_class string").filter("error_class IS NULL")
    sent = written(tables.events, "key string").select(F.col("key").alias("event_id"), F.lit(True).alias("_sent"))
    joined = attempts.join(copied.select("s3_key", F.lit(True).alias("_copied")), "s3_key", "left").join(sent, "event_id", "left")
    stored, emitted = F.col("_copied").isNotNull(), F.col("_sent").isNotNull()
    return joined.select(
        "correlation_id", "s3_key", F.lit(False).alias("discovered"), stored.alias("downloaded"),
        stored.alias("stored"), emitted.alias("emitted"), (~emitted).alias("failed"),
    )


def batch_counters(spark: SparkSession, tables: Tables) -> DataFrame:
    """Counters of every batch by correlation id, with the error of those that raised; a replay replaces its batch's."""
    return read_table(spark, tables.batch_metrics, _COUNTERS)


def version_log(tables: Tables) -> history.History:
    """The lifecycle events of versions once more, folded every few batches; batches read this one."""
    return history.History(tables.versions)


def _record(events: DataFrame, tables: Tables, batch_id: int, step: int) -> None:
    """Log the events of a step of a batch in a folder of its own: earlier steps stay, whenever the batch ends."""
    events.write.mode("overwrite").parquet(f"{tables.lifecycle}/batch_id={int(batch_id)}/step={int(step)}")
    history.append(events, version_log(tables), batch_id, step)


def compact_log(spark: SparkSession, tables: Tables, target: Tables, at: str) -> None:
    """Write the lifecycle log in short form as batch 0 of ``target``."""
    log = read_table(spark, tables.lifecycle, T.StructType.fromDDL(tracking.EVENT_SCHEMA))
    write_batch(tracking.compact(log, at), target.lifecycle, 0)


def dead_letter_table(spark: SparkSession, tables: Tables) -> DataFrame:
    return read_table(spark, tables.dead_letters, _DEAD_LETTER + ", batch_id int")


def tracking_table(spark: SparkSession, tables: Tables, base: DataFrame | None = None) -> DataFrame:
    """Current base rows: queued marks and lifecycle log folded, on top of a snapshot if given."""
    schema = T.StructType.fromDDL(tracking.EVENT_SCHEMA)
    log = read_table(spark, tables.queued, schema).select(*schema.names)
    log = log.unionByName(read_table(spark, tables.lifecycle, schema).select(*schema.names))
    if base is not None:
        log = tracking.snapshot_events(base, "1970-01-01").unionByName(log)
    return tracking.fold_base(log)
