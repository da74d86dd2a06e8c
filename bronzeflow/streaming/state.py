"""Tracking state as keyed stream state with timers.

Each object (partition_key, row_key) holds the last value of what its lifecycle
events write, with the order of the event that wrote it, so events may come in any
order and in any split into batches. A task folds its part of a batch before the
shuffle, so an object with a third of all events sends one row for each input batch
of a task. Timers run on event time: an object that stays queued or processing too
long is reported as stuck, and the state of an ended one is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from bronzeflow.operators import tracking

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_KEY = ["partition_key", "row_key"]
_NEVER = -(1 << 62)
#: Events that a task folds at once.
_ROWS = 100_000
_PARTIAL = (
    "partition_key string, row_key string, event_time timestamp, "
    "queued_at bigint, queued_seq bigint, queued string, status_at bigint, status_seq bigint, status string, "
    "done_at bigint, done_seq bigint, completed_at string"
)
_STATE = (
    "queued_at bigint, queued_seq bigint, queued string, status_at bigint, status_seq bigint, status string, "
    "done_at bigint, done_seq bigint, completed_at string, revision bigint, timer bigint"
)
UPDATE_SCHEMA = (
    "partition_key string, row_key string, queued string, status string, completed_at string, "
    "status_at bigint, status_seq bigint, revision bigint, stuck boolean"
)


def _names(schema: str) -> list[str]:
    """Column names; tasks have no session to parse a schema with."""
    return [column.split()[0] for column in schema.split(", ")]


@dataclass(frozen=True)
class Timing:
    """How late events may come, when open work is stuck, how long the state of ended work is kept.

    Events later than `lateness` are dropped. `keep` should be longer than an object
    rests between two of its changes: after it the object starts from nothing.
    """

    lateness: str = "1 day"
    stuck_after_hours: float = 24.0
    keep_hours: float = 24.0 * 90


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, which timers and keyed state need."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def _gathered(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: list[pd.DataFrame] = []
    for frame in frames:
        held.append(frame)
        if sum(map(len, held)) >= _ROWS:
            yield pd.concat(held, ignore_index=True)
            held = []
    if held:
        yield pd.concat(held, ignore_index=True)


def _folded(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per object and _ROWS events: the last events that write each part."""
    for frame in _gathered(frames):
        frame = frame.sort_values(["at", "seq"], kind="stable")
        last = frame.drop_duplicates(_KEY, keep="last")
        out = last[[*_KEY, "at", "seq", "status"]].rename(columns={"at": "status_at", "seq": "status_seq"})
        out["event_time"] = pd.to_datetime(out["status_at"], unit="us")
        for flag, value, name in (("resets", "queued", "queued"), ("ends", "completed_at", "done")):
            part = frame[frame[flag]].drop_duplicates(_KEY, keep="last")
            part = part[[*_KEY, "at", "seq", value]].rename(columns={"at": f"{name}_at", "seq": f"{name}_seq"})
            out = out.merge(part, on=_KEY, how="left")
            for column in (f"{name}_at", f"{name}_seq"):
                out[column] = out[column].fillna(_NEVER).astype("int64")
        yield out[_names(_PARTIAL)]


class _Tracked(StatefulProcessor):
    def __init__(self, stuck_ms: int, keep_ms: int):
        self.stuck_ms, self.keep_ms = stuck_ms, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("tracked", _STATE)

    def handleInputRows(self, key, rows, timerValues):
        names = _names(_STATE)
        held = self.held.get()
        before = dict(zip(names, held, strict=True)) if held else None
        now = dict(before) if before else {f"{n}_{x}": _NEVER for n in ("queued", "status", "done") for x in ("at", "seq")}
        for row in rows:
            for name, value in (("queued", "queued"), ("status", "status"), ("done", "completed_at")):
                at, seq = row[f"{name}_at"], row[f"{name}_seq"]
                if (at, seq) > (now[f"{name}_at"], now[f"{name}_seq"]) or value not in now:
                    now |= {f"{name}_at": at, f"{name}_seq": seq, value: row[value]}
        if now == before:
            return
        now["revision"] = (before["revision"] if before else 0) + 1
        now["timer"] = self._set_timer(now, before["timer"] if before else 0)
        self.held.update(tuple(now[n] for n in names))
        yield self._row(key, now, False)

    def _due(self, now: dict) -> int:
        open_work = now["status"] in (tracking.QUEUED, tracking.PROCESSING)
        return now["status_at"] // 1000 + (self.stuck_ms if open_work else self.keep_ms)

    def _set_timer(self, now: dict, old: int) -> int:
        """The timer that is set: an older one stays, it is put off when it expires. One that would be late is replaced."""
        due = self._due(now)
        if old and old <= due:
            return old
        if old:
            self.handle.deleteTimer(old)
        self.handle.registerTimer(due)
        return due

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = self.held.get()
        if not held:
            return
        now = dict(zip(_names(_STATE), held, strict=True))
        if now["timer"] != expiredTimerInfo.getExpiryTimeInMs():
            return
        due = self._due(now)
        if due > timerValues.getCurrentWatermarkInMs():
            self.handle.registerTimer(due)
            now["timer"] = due
            self.held.update(tuple(now.values()))
        elif now["status"] in (tracking.QUEUED, tracking.PROCESSING):
            now |= {"revision": now["revision"] + 1, "timer": 0}
            self.held.update(tuple(now.values()))
            yield self._row(key, now, True)
        else:
            self.held.clear()

    def _row(self, key, now: dict, stuck: bool) -> Row:
        return Row(
            partition_key=key[0], row_key=key[1], queued=now["queued"], status=now["status"], completed_at=now["completed_at"],
            status_at=now["status_at"], status_seq=now["status_seq"], revision=now["revision"], stuck=stuck,
        )

    def close(self) -> None:
        pass


def track(events: DataFrame, timing: Timing = Timing()) -> DataFrame:
    """Updates of base rows of a stream of lifecycle events: one for each object and batch that changed it.

    ``updated_rows`` of all updates are the rows of ``tracking.fold_base``. Events
    without a time count as the oldest. Start the stream under ``rocksdb``, in
    append mode.
    """
    kind = F.col("kind")
    resets = kind.isin(tracking.QUEUED, tracking.SNAPSHOT)
    columns = tracking.BASE_COLUMNS[2:-2]
    parts = events.select(
        *_KEY,
        F.coalesce(F.unix_micros("ts"), F.lit(0)).alias("at"),
        F.coalesce("seq", F.lit(0)).alias("seq"),
        F.coalesce(resets, F.lit(False)).alias("resets"),
        F.coalesce(resets | (kind == tracking.COMPLETED), F.lit(False)).alias("ends"),
        F.when(resets, F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})).alias("queued"),
        F.when(kind == tracking.SNAPSHOT, F.col("status")).otherwise(kind).alias("status"),
        F.when(kind != tracking.QUEUED, F.col("completed_at")).alias("completed_at"),
    ).mapInPandas(_folded, _PARTIAL)
    hours = 3_600_000
    return (
        parts.withWatermark("event_time", timing.lateness)
        .groupBy(*_KEY)
        .transformWithState(_Tracked(int(timing.stuck_after_hours * hours), int(timing.keep_hours * hours)), UPDATE_SCHEMA, "append", "eventTime")
    )


def updated_rows(updates: DataFrame) -> DataFrame:
    """Base rows after all updates, the last one of each object, with ``stuck``."""
    order = F.struct("status_at", "status_seq", "revision")
    names = tracking.BASE_COLUMNS[2:-2]
    kinds = {f.name: f.dataType.simpleString() for f in StructType.fromDDL(tracking.EVENT_SCHEMA).fields}
    schema = ", ".join(f"{n} {kinds[n]}" for n in names)
    last = updates.groupBy(*_KEY).agg(F.max_by(F.struct("queued", "status", "completed_at", "stuck"), order).alias("last"))
    read = last.select(*_KEY, F.from_json("last.queued", schema).alias("q"), "last.status", "last.completed_at", "last.stuck")
    return read.select(*_KEY, *[F.col(f"q.{n}").alias(n) for n in names], "status", "completed_at", "stuck")
