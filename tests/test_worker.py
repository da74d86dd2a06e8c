"""Worker batches: order, replay, refusals, streams."""

import json

import pytest
from pyspark.sql import functions as F

from bronzeflow.catalog.adapters import CONTEXT
from bronzeflow.context import RunContext
from bronzeflow.functions import keys
from bronzeflow.operators import tracking
from bronzeflow.plans import dispatcher, records, worker
from bronzeflow.sinks import bronze
from bronzeflow.sinks.messages import publish, work_item_messages
from bronzeflow.sinks.tables import Tables
from bronzeflow.streaming import queue

ID = "c0ffee00-0000-4000-8000-000000000001"


def body(key, name, **changes):
    item = {"site_id": 9068, "s3_key": key, "file_name": name, "correlation_id": ID,
            "enqueued_at": "2024-01-15T12:00:00Z", "last_modified": "2024-01-15T12:00:00Z", **changes}
    return json.dumps(item).encode()


BATCH = [
    body("d/9068_ac_power_data.csv", "9068_ac_power_data.csv"),
    body("d/9068_ac_power_data.csv", "9068_ac_power_data.csv"),
    body("d/9068_irr_data_2023-01-01_2023-06-30.csv", "9068_irr_data_2023-01-01_2023-06-30.csv"),
    body("d/9068_irr_data_2023-07-01_2023-12-31.csv", "9068_irr_data_2023-07-01_2023-12-31.csv"),
    body("d/9068_gone_data.csv", "9068_gone_data.csv"),
    body("d/x.csv", "x.csv", site_id=0),
    b"\xff",
]
CONTENTS = [
    ("d/9068_ac_power_data.csv", b"a,b\n1,2\n"),
    ("d/9068_irr_data_2023-01-01_2023-06-30.csv", b"x\n"),
    ("d/9068_irr_data_2023-07-01_2023-12-31.csv", b"y\n"),
]


@pytest.fixture
def setup(spark, tmp_path):
    contents = spark.createDataFrame(CONTENTS, "s3_key string, content binary")
    tables = Tables(str(tmp_path))

    def run(bodies, batch_id, ctx=CONTEXT):
        df = spark.createDataFrame([(b,) for b in bodies], "body binary")
        worker.run_batch(spark, df, tables, lambda i: bronze.attach_content(i, contents), ctx, batch_id)

    return run, tables


def statuses(spark, tables):
    folded = worker.tracking_table(spark, tables)
    names = spark.createDataFrame([(k,) for k, _ in CONTENTS] + [("d/9068_gone_data.csv",)], "k string")
    return {
        r.k: r.status
        for r in names.join(folded, F.expr(keys.row_key("k")) == F.col("row_key")).collect()
    }


def events(spark, tables):
    return [json.loads(r.value) for r in spark.read.parquet(tables.events).collect()]


def test_batch(spark, setup):
    run, tables = setup
    run(BATCH, 0)
    assert statuses(spark, tables) == {
        "d/9068_ac_power_data.csv": "completed",
        "d/9068_irr_data_2023-01-01_2023-06-30.csv": "completed",
        "d/9068_irr_data_2023-07-01_2023-12-31.csv": "failed",
        "d/9068_gone_data.csv": "failed",
    }
    sent = {e["data"]["category"]: e for e in events(spark, tables)}
    assert sorted(sent) == ["ac_power", "irr"]
    assert sent["ac_power"]["data"]["file_size"] == 8
    assert sent["ac_power"]["correlation_id"] == ID != sent["ac_power"]["data"]["ingestion_id"]
    letters = sorted((r.error_type, r.file_reference[:20]) for r in worker.dead_letter_table(spark, tables).collect())
    assert letters == [
        ("dataset_failure", "d/9068_gone_data.csv"), ("dataset_failure", "d/9068_irr_data_2023"),
        ("malformed_body", "�"), ("validation_failure", '{"site_id": 0, "s3_k'),
    ]
    assert worker.redelivered(spark, tables).count() == 0
    counters = {r.correlation_id: r for r in worker.run_counters(spark, tables, CONTEXT).collect()}
    row = counters[ID]
    assert (row.datasets_downloaded, row.datasets_stored, row.datasets_emitted, row.datasets_failed) == (2, 2, 2, 3)
    assert counters["unknown"].datasets_failed == 1
    stored = spark.read.parquet(tables.bronze).filter("error_class IS NULL").collect()
    assert {(r.dataset, r.ingestion_date.isoformat(), bytes(r.content)) for r in stored} == {
        ("9068_ac_power", CONTEXT.run_date, b"a,b\n1,2\n"), ("9068_irr", CONTEXT.run_date, b"x\n")
    }


def test_replay_repeats_itself_and_later_batch_counts_up(spark, setup):
    run, tables = setup
    run(BATCH, 0)
    first = sorted(e["id"] for e in events(spark, tables))
    run(BATCH, 0)
    assert sorted(e["id"] for e in events(spark, tables)) == first
    assert {e["data"]["version"] for e in events(spark, tables)} == {1}
    later = RunContext(**{**vars(CONTEXT), "run_ts": "2024-07-02T06:00:00+00:00"})
    run(BATCH[:1], 1, later)
    newest = [e for e in events(spark, tables) if e["data"]["version"] == 2]
    assert [e["data"]["category"] for e in newest] == ["ac_power"]
    assert newest[0]["id"] not in first


def test_compacted_log_folds_to_the_same_state(spark, setup, tmp_path):
    run, tables = setup
    run(BATCH, 0)
    run(BATCH[:3], 1)
    short = Tables(str(tmp_path / "short"))
    worker.compact_log(spark, tables, short, "2025-01-01T00:00:00+00:00")
    logs = [spark.read.parquet(t.lifecycle) for t in (tables, short)]
    for fold in (tracking.fold_base, tracking.fold_versions):
        old, new = [sorted(map(repr, fold(log).collect())) for log in logs]
        assert old == new


def test_path_stays_with_its_first_owner_across_batches(spark, setup):
    run, tables = setup
    run([BATCH[3]], 0)
    run([BATCH[2]], 1)
    assert statuses(spark, tables) == {
        "d/9068_irr_data_2023-07-01_2023-12-31.csv": "completed",
        "d/9068_irr_data_2023-01-01_2023-06-30.csv": "failed",
    }


def test_batches_of_one_run_follow_each_other(spark, setup):
    run, tables = setup
    run([BATCH[2]], 0)
    run([BATCH[2], BATCH[0]], 1)
    log = spark.read.parquet(tables.lifecycle)
    row = tracking.fold_base(log).join(
        spark.createDataFrame([(CONTENTS[1][0],)], "k string"), F.expr(keys.row_key("k")) == F.col("row_key")
    ).first()
    last = log.filter(F.col("s3_key") == CONTENTS[1][0]).orderBy(F.desc("seq")).first()
    assert row.status == last.kind == "completed" and last.version == 2


def test_only_bad_messages(spark, setup):
    run, tables = setup
    run(BATCH[5:], 0)
    assert worker.dead_letter_table(spark, tables).count() == 2
    assert spark.read.parquet(tables.events).count() == 0


def test_transient_store_failure_is_redelivered(spark, tmp_path):
    tables = Tables(str(tmp_path))

    def busy(items):
        return items.selectExpr(
            "*", "CAST(NULL AS BINARY) AS content", "CAST(NULL AS BIGINT) AS file_size",
            "CAST(NULL AS STRING) AS file_hash", "CAST(NULL AS BIGINT) AS row_count",
            "'HTTPStatusError' AS error_class", "503 AS http_status", "'busy' AS error_text",
        )

    df = spark.createDataFrame([(BATCH[0],)], "body binary")
    worker.run_batch(spark, df, tables, busy, CONTEXT, 0)
    again = worker.redelivered(spark, tables).collect()
    assert [r.s3_key for r in again] == ["d/9068_ac_power_data.csv"]
    assert worker.dead_letter_table(spark, tables).first().error_type == "dataset_failure"
    contents = spark.createDataFrame(CONTENTS, "s3_key string, content binary")
    bodies = spark.createDataFrame([(again[0].message.encode(),), (BATCH[5],)], "body binary")
    worker.run_batch(spark, bodies, tables, lambda i: bronze.attach_content(i, contents), CONTEXT, 1)
    assert worker.redelivered(spark, tables).count() == 0
    assert statuses(spark, tables)["d/9068_ac_power_data.csv"] == "completed"


def test_objects_are_processing_while_they_are_copied(spark, tmp_path):
    tables = Tables(str(tmp_path))

    def broken(items):
        raise RuntimeError("ended midway")

    df = spark.createDataFrame([(BATCH[0],)], "body binary")
    with pytest.raises(RuntimeError, match="midway"):
        worker.run_batch(spark, df, tables, broken, CONTEXT, 0)
    assert statuses(spark, tables) == {"d/9068_ac_power_data.csv": "processing"}


def test_a_batch_keeps_the_time_it_first_started(spark, tmp_path):
    tables, ticks = Tables(str(tmp_path)), iter(["2024-07-01T09:00:00+00:00", "2024-07-02T01:00:00+00:00"])
    times = [worker.batch_context(spark, tables, CONTEXT, n, lambda: next(ticks)).run_ts for n in (0, 0, 1, 0)]
    assert times == ["2024-07-01T09:00:00+00:00"] * 2 + ["2024-07-02T01:00:00+00:00", "2024-07-01T09:00:00+00:00"]


def test_a_late_batch_completes_what_was_queued_after_the_worker_started(spark, tmp_path):
    tables = Tables(str(tmp_path / "tables"))
    queued = RunContext(**{**vars(CONTEXT), "run_ts": "2024-07-01T12:00:00+00:00"})
    sites = spark.createDataFrame([(9068,)], "site_id bigint")
    status = spark.createDataFrame([(9068, True)], "site_id bigint, listing_ok boolean")
    files = spark.createDataFrame(
        [(9068, CONTENTS[0][0], 5, "2024-01-15T12:00:00Z")], "site_id bigint, key string, size bigint, last_modified string"
    )
    base = spark.createDataFrame(
        [], "partition_key string, row_key string, s3_key string, size bigint, last_modified string, status string"
    )
    dispatcher.emit(dispatcher.dispatch(sites, status, files, base, queued), tables, 0)
    contents = spark.createDataFrame(CONTENTS, "s3_key string, content binary")
    stream = queue.read_queue(spark, "parquet", {"path": f"{tables.queue}/batch_id=0"}, "value string")
    queue.run_worker(
        stream, tables, lambda i: bronze.attach_content(i, contents), CONTEXT, str(tmp_path / "cp"),
        clock=lambda: "2024-07-01T13:00:00+00:00",
    ).awaitTermination()
    row = worker.tracking_table(spark, tables).first()
    assert (row.status, row.completed_at) == ("completed", "2024-07-01T13:00:00+00:00")


def test_queue_stream_with_file_copies(spark, tmp_path):
    source = tmp_path / "src"
    (source / "d").mkdir(parents=True)
    for key, content in CONTENTS:
        (source / key).write_bytes(content)
    tables = Tables(str(tmp_path / "tables"))
    spark.createDataFrame([(b.decode(),) for b in BATCH[:5]], "value string").coalesce(1).write.parquet(
        str(tmp_path / "queue")
    )

    def store(items):
        located = items.withColumn("origin", F.concat(F.lit(f"{source}/"), "s3_key"))
        return bronze.copy_objects(located, "origin", str(tmp_path / "bronze"), 2).drop("origin")

    stream = queue.read_queue(spark, "parquet", {"path": str(tmp_path / "queue")}, "value string")
    queue.run_worker(stream, tables, store, CONTEXT, str(tmp_path / "cp")).awaitTermination()
    assert statuses(spark, tables)["d/9068_ac_power_data.csv"] == "completed"
    path = f"source=pvdaq/dataset=9068_ac_power/ingestion_date={CONTEXT.run_date}/9068_ac_power_v1.csv"
    assert (tmp_path / "bronze" / path).read_bytes() == b"a,b\n1,2\n"


def test_stream_drops_repeated_records(spark, tmp_path):
    schema = "SiteID int, measdatetime string, n int"
    rows = [(1, "2024-01-01T00:00:00", 1), (1, "2024-01-01T00:00:00", 2), (2, "2024-01-01T00:00:00", 3)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    queue.drain(
        queue.dedupe_records(stream, "SiteID", "measdatetime"), str(tmp_path / "out"), str(tmp_path / "cp")
    )
    assert sorted(r.SiteID for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2]


def test_tracking_fold_of_a_stream(spark, sf_dir, tmp_path):
    from bronzeflow.catalog import adapters

    log = adapters.lifecycle_events(spark, sf_dir)
    log.write.parquet(str(tmp_path / "log"))
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log"))
    query = (
        tracking.fold_base(stream).writeStream.format("memory").queryName("base").outputMode("complete")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(map(repr, spark.table("base").collect())) == sorted(
        map(repr, tracking.fold_base(log).collect())
    )


def test_records_are_emitted_once(spark, tmp_path):
    tables = Tables(str(tmp_path))
    good = '{"SiteID":5,"measdatetime":"2024-01-01T00:00:00"}'
    rows = [(1, good), (2, good), (3, '{"SiteID":6,"measdatetime":"2024-01-01 00:05"}'), (4, "{bad")]
    payloads = spark.createDataFrame(rows, "n int, payload string")

    def run(batch_id):
        planned = records.process_records(payloads, records.read_store(spark, tables), ["n"], CONTEXT)
        records.emit(planned, tables, CONTEXT, batch_id)
        return planned

    run(0)
    emitted = spark.read.parquet(tables.record_events).collect()
    assert sorted((r.n, r.outcome) for r in emitted) == [(1, "NEW"), (3, "NEW")]
    stats = spark.read.parquet(tables.record_metrics).first()
    assert (stats.number_of_records_retrieved, stats.number_valid, stats.number_invalid, stats.number_emitted) == (4, 3, 1, 2)
    assert spark.read.parquet(tables.record_dead_letters).first().original_payload == "{bad"
    run(1)
    assert spark.read.parquet(f"{tables.record_events}/batch_id=1").count() == 0


def test_pending_records_are_emitted_again(spark, tmp_path):
    payloads = spark.createDataFrame([(1, '{"SiteID":5,"measdatetime":"2024-01-01T00:00:00"}')], "n int, payload string")
    store = spark.createDataFrame(
        [("2024-01-01", "5_2024-01-01T00:00:00", "pending")], "partition_date string, record_key string, status string"
    )
    planned = records.process_records(payloads, store, ["n"], CONTEXT)
    assert [r.outcome for r in planned.emitted.collect()] == ["RETRY_EMIT"]


def test_dispatch_to_tables(spark, tmp_path):
    tables = Tables(str(tmp_path))
    sites = spark.createDataFrame([(9068,), (9069,)], "site_id bigint")
    status = spark.createDataFrame([(9068, True), (9069, False)], "site_id bigint, listing_ok boolean")
    files = spark.createDataFrame(
        [(9068, "p/9068_ac_power_data.csv", 5, "2024-01-15T12:00:00Z"), (9068, "p/9068_b_data.csv", 5, ""),
         (9068, "p/9068_c_data.csv", 5, "yesterday")],
        "site_id bigint, key string, size bigint, last_modified string",
    )
    base = spark.createDataFrame(
        [], "partition_key string, row_key string, s3_key string, size bigint, last_modified string, status string"
    )
    dispatcher.emit(dispatcher.dispatch(sites, status, files, base, CONTEXT), tables, 0)
    item = json.loads(spark.read.parquet(tables.queue).first().value)
    assert list(item) == ["site_id", "s3_key", "file_name", "category", "correlation_id", "enqueued_at", "last_modified"]
    assert item["category"] == "ac_power"
    assert [r.key for r in spark.read.parquet(tables.skipped).collect()] == ["p/9068_b_data.csv"]
    assert [r.s3_key for r in spark.read.parquet(tables.rejected).collect()] == ["p/9068_c_data.csv"]
    outcomes = {r.site_id: r.outcome for r in spark.read.parquet(tables.site_outcomes).collect()}
    assert outcomes == {9068: "enqueued", 9069: "failed"}
    assert spark.read.parquet(tables.run_metrics).first().datasets_discovered == 3
    row = worker.tracking_table(spark, tables).first()
    assert (row.status, row.s3_key, row.size) == ("queued", "p/9068_ac_power_data.csv", 5)


def test_publish_appends(spark, tmp_path):
    items = spark.createDataFrame(
        [(1, "k", "f", "c", ID, "t", None)],
        "site_id bigint, s3_key string, file_name string, category string, correlation_id string, "
        "enqueued_at string, last_modified string",
    )
    for _ in range(2):
        publish(work_item_messages(items), "parquet", {"path": str(tmp_path / "out")})
    sent = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(sent) == 2 and json.loads(sent[0].value)["last_modified"] is None
    assert {h.key: bytes(h.value) for h in sent[0].headers}["subject"] == b"historical_work_item"


def test_bodies_with_anything_after_the_value_are_malformed(spark):
    from bronzeflow.operators import messages

    good = '{"site_id": 1}'
    tails = ["", " ", "\n", "]", "],[1", "] junk", " {}", ",1", ',"x"', "}", "] , [ 2", "//"]
    rows = spark.createDataFrame([(i, good + tail) for i, tail in enumerate(tails)], "n int, body string")
    parsed = messages.parse_bodies(rows.withColumn("body", F.encode("body", "UTF-8"))).collect()
    assert sorted(r.n for r in parsed if r.body_problem is None) == [0, 1, 2]
    checked = messages.check_records(rows.withColumnRenamed("body", "payload")).select("n", F.col("document").isNull().alias("bad"))
    assert sorted(r.n for r in checked.collect() if not r.bad) == [0, 1, 2]


def test_a_copy_that_ends_early_is_a_passing_fault_and_leaves_nothing(tmp_path, monkeypatch):
    import io
    import urllib.request

    from bronzeflow.sinks import bronze

    class Cut(io.BytesIO):
        headers = {"Content-Length": "10"}

    asked = []
    monkeypatch.setattr(urllib.request, "urlopen", lambda url, timeout: asked.append(url) or Cut(b"only"))
    copier = bronze._copier("u", str(tmp_path), [f.name for f in bronze.RESULT_FIELDS], 4)
    copy_one = next(c.cell_contents for c in copier.__closure__ if getattr(c.cell_contents, "__name__", "") == "copy_one")
    size, *_, failed, status, _ = copy_one("https://host/a b/é%20c.csv", f"{tmp_path}/out/x.csv", 1)
    assert (size, failed, status) == (None, "TransportError", None)
    assert asked == ["https://host/a%20b/%C3%A9%20c.csv"] and not list((tmp_path / "out").iterdir())
    assert copy_one(f"{tmp_path}/none", f"{tmp_path}/out/x.csv", 1)[3] == "SourceNotFound"
    # an address that names nothing does not pass by waiting
    monkeypatch.undo()
    for bad in ("ftp9://host/x", "http://host:port/x", "https://[1/x"):
        assert copy_one(bad, f"{tmp_path}/out/x.csv", 1)[3] == "ValueError", bad
