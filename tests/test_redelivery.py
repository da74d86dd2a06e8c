"""Passing failures: tried again when due, given up after the last attempt, repeated by a replay."""

import time

from pyspark.sql import functions as F
from test_worker import BATCH, CONTENTS, events, statuses

from bronzeflow.catalog.adapters import CONTEXT
from bronzeflow.plans import redelivery, worker
from bronzeflow.plans.redelivery import Retry
from bronzeflow.sinks import bronze
from bronzeflow.sinks.tables import Tables
from bronzeflow.streaming import queue

AC, IRR = CONTENTS[0][0], CONTENTS[1][0]
BUSY = {"error_class": "HTTPStatusError", "http_status": 503, "error_text": "busy"}


def opened(spark, tables):
    return {r.s3_key: (r.attempts, r.due_at.strftime("%H:%M:%S")) for r in redelivery.open_redeliveries(spark, tables).collect()}


def store_with(spark, busy):
    """A store in which the keys of the next set of ``busy`` answer 503."""
    contents, turns = spark.createDataFrame(CONTENTS, "s3_key string, content binary"), iter(busy)

    def store(items):
        down = F.col("s3_key").isin(list(next(turns)))
        found = bronze.attach_content(items, contents)
        return found.withColumns(
            {n: F.when(down, F.lit(v)).otherwise(F.col(n)) for n, v in BUSY.items()}
            | {n: F.when(~down, F.col(n)) for n in ("content", "file_size", "file_hash", "row_count")}
        )

    return store


def stream_of(spark, folder, bodies):
    for n, body in enumerate(bodies):
        spark.createDataFrame([(body.decode(errors="replace"),)], "value string").coalesce(1).write.parquet(f"{folder}/{n:03}")
        time.sleep(0.01)
    return queue.read_queue(spark, "parquet", {"path": f"{folder}/*", "maxFilesPerTrigger": "1"}, "value string")


def test_a_passing_failure_is_tried_again_when_due(spark, tmp_path):
    tables, hours = Tables(str(tmp_path / "t")), iter(["06:00:00", "06:00:30", "06:02:00"])
    stream = stream_of(spark, tmp_path / "q", [BATCH[0], BATCH[2], BATCH[5]])
    queue.run_worker(
        stream, tables, store_with(spark, [{AC}, {AC}, set()]), CONTEXT, str(tmp_path / "cp"),
        clock=lambda: f"2024-07-01T{next(hours)}+00:00", retry=Retry(3, 60.0),
    ).awaitTermination()
    # The second batch is too early for it, the third, whose own message is refused, tries it again.
    found = statuses(spark, tables)
    assert (found[AC], found[IRR]) == ("completed", "completed")
    assert sorted(e["data"]["category"] for e in events(spark, tables)) == ["ac_power", "irr"]
    assert opened(spark, tables) == {} and redelivery.exhausted(spark, tables).count() == 0
    assert worker.redelivered(spark, tables).count() == 0


def run(spark, tables, store, bodies, batch_id, at, retry):
    ctx = worker.replace(CONTEXT, run_ts=f"2024-07-01T{at}+00:00")
    df = redelivery.with_due(spark.createDataFrame([(b,) for b in bodies], "body binary"), tables, ctx.run_ts, batch_id)
    worker.run_batch(spark, df, tables, store, ctx, batch_id)
    redelivery.settle(spark, tables, retry, ctx.run_ts, batch_id)


def test_waits_double_and_the_last_attempt_gives_up(spark, tmp_path):
    tables, retry = Tables(str(tmp_path)), Retry(3, 60.0)
    down = [{AC}] * 4
    store = store_with(spark, down)
    run(spark, tables, store, [BATCH[0], BATCH[2]], 0, "06:00:00", retry)
    assert opened(spark, tables) == {AC: (1, "06:01:00")}
    run(spark, tables, store, [], 1, "06:01:00", retry)
    assert opened(spark, tables) == {AC: (2, "06:03:00")}
    # A replay starts from the table before it and does not count again.
    run(spark, tables, store, [], 1, "06:01:00", retry)
    assert opened(spark, tables) == {AC: (2, "06:03:00")}
    run(spark, tables, store, [BATCH[0]], 2, "06:03:00", retry)
    assert opened(spark, tables) == {} and statuses(spark, tables)[AC] == "failed"
    letter = redelivery.exhausted(spark, tables).first()
    assert (letter.error_type, letter.file_reference, letter.failure_reason) == (
        redelivery.EXHAUSTED, AC, "failed 3 times for a passing reason"
    )
    assert [e["data"]["category"] for e in events(spark, tables)] == ["irr"]


def test_lasting_failures_end_a_redelivery(spark, tmp_path):
    tables, retry = Tables(str(tmp_path)), Retry()
    gone = "d/9068_gone_data.csv"
    store = store_with(spark, [{gone}, set()])
    run(spark, tables, store, [BATCH[4]], 0, "06:00:00", retry)
    assert opened(spark, tables) == {gone: (1, "06:01:00")}
    run(spark, tables, store, [], 1, "07:00:00", retry)
    assert opened(spark, tables) == {} and statuses(spark, tables)[gone] == "failed"
    assert redelivery.exhausted(spark, tables).count() == 0


def test_a_run_that_goes_on_tries_again_without_new_messages(spark, tmp_path):
    tables = Tables(str(tmp_path / "t"))
    stream = stream_of(spark, tmp_path / "q", [BATCH[0]])
    query = queue.run_worker(
        stream, tables, store_with(spark, [{AC}, *[set()] * 99]), CONTEXT, str(tmp_path / "cp"), every="1 second", retry=Retry(3, 0.1),
    )
    end = time.time() + 120
    while time.time() < end and query.isActive and statuses(spark, tables).get(AC) != "completed":
        time.sleep(1)
    query.stop()
    assert statuses(spark, tables)[AC] == "completed" and len(events(spark, tables)) == 1
