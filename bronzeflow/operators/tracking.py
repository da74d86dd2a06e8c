"""Current tracking state as a fold over lifecycle events.

An event row carries every column below; a kind sets only its own columns:

* ``queued`` replaces the whole base row (columns it does not set become null);
* ``processing`` and ``failed`` set the base status, ``completed`` also ``completed_at``;
* the last three merge into the row of their version, if they have one;
* ``snapshot`` stands for a stored base row, so that new events fold onto it.

Each column keeps the value of the last event that writes it, which is a
``max_by`` over (ts, seq): a partial aggregate, so a key with a third of all
events is combined before the shuffle and no window ever sorts it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

EVENT_SCHEMA = (
    "kind string, ts timestamp, seq bigint, partition_key string, row_key string, "
    "s3_key string, version int, file_name string, category string, size bigint, "
    "last_modified string, enqueued_at string, completed_at string, correlation_id string, "
    "storage_path string, file_hash string, ingestion_id string, source_url string, "
    "ingestion_time string, row_count bigint, metadata_path string, status string"
)

QUEUED, PROCESSING, COMPLETED, FAILED = "queued", "processing", "completed", "failed"
SNAPSHOT = "snapshot"

_QUEUED_COLUMNS = [
    "s3_key", "file_name", "category", "size", "last_modified", "enqueued_at", "correlation_id",
]
_COMPLETED_COLUMNS = [
    "category", "completed_at", "storage_path", "file_hash", "ingestion_id", "source_url",
    "ingestion_time", "row_count", "metadata_path",
]
BASE_COLUMNS = ["partition_key", "row_key", *_QUEUED_COLUMNS, "status", "completed_at"]
VERSION_COLUMNS = [
    "partition_key", "row_key", "s3_key", "file_name", "version", "status", *_COMPLETED_COLUMNS,
]


def _last(value: Column, written: Column) -> Column:
    """Value of the last event for which ``written`` holds; it may be null."""
    order = F.when(written, F.struct("ts", "seq"))
    return F.max_by(value, order)


def fold_base(events: DataFrame) -> DataFrame:
    """One base row per object; works on a batch or, in update mode, on a stream."""
    kind = F.col("kind")
    reset = kind.isin(QUEUED, SNAPSHOT)
    status = F.when(kind == SNAPSHOT, F.col("status")).otherwise(kind)
    folded = events.groupBy("partition_key", "row_key").agg(
        _last(F.struct(*_QUEUED_COLUMNS), reset).alias("_queued"),
        _last(status, F.lit(True)).alias("status"),
        _last(
            F.when(kind != QUEUED, F.col("completed_at")), reset | (kind == COMPLETED)
        ).alias("completed_at"),
    )
    return folded.select(
        "partition_key",
        "row_key",
        *[F.col(f"_queued.{c}").alias(c) for c in _QUEUED_COLUMNS],
        "status",
        "completed_at",
    )


def fold_versions(events: DataFrame) -> DataFrame:
    """One row per object version; version 0 or null means it was never known."""
    kind = F.col("kind")
    folded = (
        events.filter(
            kind.isin(PROCESSING, COMPLETED, FAILED) & (F.coalesce(F.col("version"), F.lit(0)) > 0)
        )
        .groupBy("partition_key", "s3_key", "version")
        .agg(
            _last(kind, F.lit(True)).alias("status"),
            _last(F.struct(*_COMPLETED_COLUMNS), kind == COMPLETED).alias("_done"),
            F.bool_or(kind != FAILED).alias("_named"),
        )
    )
    return folded.select(
        "partition_key",
        F.concat(F.sha2("s3_key", 256), F.lit("_v"), F.col("version")).alias("row_key"),
        "s3_key",
        F.when(F.col("_named"), F.element_at(F.split("s3_key", "/"), -1)).alias("file_name"),
        "version",
        "status",
        *[F.col(f"_done.{c}").alias(c) for c in _COMPLETED_COLUMNS],
    )


def snapshot_events(base: DataFrame, before: str) -> DataFrame:
    """Stored base rows as events older than everything newer than ``before``."""
    return as_events(
        base,
        SNAPSHOT,
        F.lit(before).cast("timestamp"),
        {c: F.col(c) for c in BASE_COLUMNS},
    )


def as_events(
    rows: DataFrame, kind: str, ts: Column, values: dict[str, Column], seq: Column | None = None
) -> DataFrame:
    """Rows as lifecycle events of one kind; columns not in ``values`` are null."""
    given = {
        "kind": F.lit(kind),
        "ts": ts,
        "seq": F.lit(0) if seq is None else seq,
        **values,
    }
    return rows.select(
        *[
            given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in StructType.fromDDL(EVENT_SCHEMA).fields
        ]
    )


def apply_events(base: DataFrame, events: DataFrame, before: str) -> DataFrame:
    """Base table after a batch of events."""
    return fold_base(snapshot_events(base, before).unionByName(events))


def compact(events: DataFrame, at: str) -> DataFrame:
    """A short log that folds to the same base and version rows.

    All events have to be older than ``at``, and later ones newer. Replaces a
    grown log: at most three events per version and one per object remain.
    """
    ts = F.lit(at).cast("timestamp")
    versions = fold_versions(events)
    names = ["partition_key", "s3_key", "version", *_COMPLETED_COLUMNS]
    columns = {c: F.col(c) for c in names} | {"row_key": F.sha2("s3_key", 256)}
    identity = {c: columns[c] for c in ("partition_key", "s3_key", "version", "row_key")}
    details = F.coalesce(*[F.col(c).cast("string") for c in _COMPLETED_COLUMNS])
    detailed = details.isNotNull() | (F.col("status") == COMPLETED)
    named = versions.filter(F.col("file_name").isNotNull())
    log = as_events(named, PROCESSING, ts, identity, F.lit(0)).unionByName(
        as_events(versions.filter(detailed), COMPLETED, ts, columns, F.lit(1))
    )
    for status in (PROCESSING, FAILED):
        ended = versions.filter(F.col("status") == status)
        log = log.unionByName(as_events(ended, status, ts, identity, F.lit(2)))
    base = {c: F.col(c) for c in BASE_COLUMNS}
    return log.unionByName(as_events(fold_base(events), SNAPSHOT, ts, base, F.lit(3)))
