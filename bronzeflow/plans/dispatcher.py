"""From a listing to work items: the discovery run as one plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bronzeflow.context import RunContext
from bronzeflow.functions import keys
from bronzeflow.operators import builders, incremental, metrics, tracking
from bronzeflow.operators.schema import first_error
from bronzeflow.sinks.messages import work_item_messages
from bronzeflow.sinks.tables import Tables, write_batch
from bronzeflow.workspace import materialize


@dataclass(frozen=True)
class Dispatch:
    """Outputs of a discovery run."""

    work_items: DataFrame
    rejected: DataFrame
    skipped: DataFrame
    queued_events: DataFrame
    site_outcomes: DataFrame
    run_metrics: DataFrame


def dispatch(
    sites: DataFrame,
    listing_status: DataFrame,
    listing: DataFrame,
    tracking_base: DataFrame,
    ctx: RunContext,
) -> Dispatch:
    """Plan a run over the CSV listing (site_id, key, size, last_modified) of the sites.

    A built work item is checked before its object is marked queued, so an
    invalid one is reported and does not come back as stuck on every run. The
    changed files, which all outputs start from, are written once.
    """
    changed = materialize(incremental.detect_changes(listing, tracking_base), "changed")
    dated, skipped = incremental.split_dated(changed)
    checked = builders.check_built_work_items(builders.work_items(dated, ctx))
    valid = checked.filter(F.size("errors") == 0).drop("errors")
    rejected = checked.filter(F.size("errors") > 0).select(
        "site_id", "s3_key", "file_name", first_error(F.col("errors")).alias("failure_reason")
    )
    outcomes = metrics.site_outcomes(sites, listing_status, listing, changed)
    counters = outcomes.agg(F.coalesce(F.sum("discovered"), F.lit(0)).alias("n")).select(
        F.lit("PVDAQ-historical-dispatcher").alias("source"),
        F.col("n").cast("bigint").alias("datasets_discovered"),
        *[
            F.lit(0).cast("bigint").alias(f"datasets_{stage}")
            for stage in ("downloaded", "stored", "emitted", "failed")
        ],
        F.lit(ctx.elapsed_seconds * 1000.0).alias("duration_ms"),
        F.lit(ctx.correlation_id).alias("correlation_id"),
    )
    return Dispatch(
        work_items=valid.drop("size"),
        rejected=rejected,
        skipped=skipped,
        queued_events=queued_events(valid, ctx),
        site_outcomes=outcomes,
        run_metrics=counters,
    )


def emit(run: Dispatch, tables: Tables, batch_id: int) -> None:
    """Write the outputs of a run; objects are marked queued before their messages are sent."""
    write_batch(run.queued_events, tables.queued, batch_id)
    write_batch(work_item_messages(run.work_items), tables.queue, batch_id)
    write_batch(run.skipped.select("site_id", "key"), tables.skipped, batch_id)
    write_batch(run.rejected, tables.rejected, batch_id)
    write_batch(run.site_outcomes, tables.site_outcomes, batch_id)
    write_batch(run.run_metrics, tables.run_metrics, batch_id)


def queued_events(items: DataFrame, ctx: RunContext) -> DataFrame:
    """Lifecycle events that replace the base rows of enqueued objects."""
    names = ["s3_key", "file_name", "category", "size", "last_modified", "enqueued_at",
             "correlation_id"]
    return tracking.as_events(
        items,
        tracking.QUEUED,
        F.lit(ctx.run_ts).cast("timestamp"),
        {
            "partition_key": F.expr(keys.partition_key("site_id")),
            "row_key": F.expr(keys.row_key("s3_key")),
            **{name: F.col(name) for name in names},
        },
    )
