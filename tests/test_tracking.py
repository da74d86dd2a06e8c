"""State folds, failure classification and metrics."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from bronzeflow.operators import failures, metrics, profile, tracking

T0 = datetime(2024, 1, 1)


def events(spark, rows):
    """rows: (kind, seq, values)."""
    names = [part.split()[0] for part in tracking.EVENT_SCHEMA.split(", ")]
    full = []
    for kind, seq, values in rows:
        row = {"kind": kind, "seq": seq, "ts": T0 + timedelta(hours=seq), "partition_key": "1",
               "row_key": "r", "s3_key": "a/k.csv", **values}
        full.append(tuple(row.get(n) for n in names))
    return spark.createDataFrame(full, tracking.EVENT_SCHEMA)


QUEUED = {"size": 1, "last_modified": "d1", "category": "c", "file_name": "k.csv", "correlation_id": "x"}
DONE = {"version": 1, "completed_at": "t", "file_hash": "h", "row_count": 7, "category": "c"}


def test_lifecycle(spark):
    log = events(spark, [("queued", 1, QUEUED), ("processing", 2, {"version": 1}), ("completed", 3, DONE)])
    row = tracking.fold_base(log).first()
    assert (row.status, row.size, row.last_modified, row.completed_at) == ("completed", 1, "d1", "t")
    version = tracking.fold_versions(log).first()
    assert (version.version, version.status, version.file_hash, version.file_name) == (1, "completed", "h", "k.csv")
    assert version.row_key.endswith("_v1")


def test_queued_replaces_the_whole_row(spark):
    again = {**QUEUED, "last_modified": "d2", "category": None}
    log = events(spark, [("queued", 1, QUEUED), ("completed", 2, DONE), ("queued", 3, again)])
    row = tracking.fold_base(log).first()
    assert (row.status, row.completed_at, row.last_modified, row.category) == ("queued", None, "d2", None)
    assert tracking.fold_versions(log).first().status == "completed"


def test_merge_without_queued_row(spark):
    row = tracking.fold_base(events(spark, [("processing", 1, {"version": 1})])).first()
    assert (row.status, row.s3_key, row.size) == ("processing", None, None)


def test_failed_with_unknown_version_writes_no_version_row(spark):
    log = events(spark, [("failed", 1, {"version": 0}), ("failed", 2, {"version": None})])
    assert tracking.fold_base(log).first().status == "failed"
    assert tracking.fold_versions(log).count() == 0
    named = tracking.fold_versions(events(spark, [("failed", 1, {"version": 2})])).first()
    assert (named.status, named.file_name) == ("failed", None)


def test_failure_after_completion_keeps_metadata(spark):
    log = events(spark, [("completed", 1, DONE), ("failed", 2, {"version": 1})])
    row = tracking.fold_versions(log).first()
    assert (row.status, row.file_hash, row.row_count) == ("failed", "h", 7)


def test_events_fold_onto_a_stored_base(spark):
    first = [("queued", 1, QUEUED), ("completed", 2, DONE)]
    then = [("processing", 3, {"version": 2}), ("failed", 4, {"version": 2})]
    stored = tracking.fold_base(events(spark, first))
    merged = tracking.apply_events(stored, events(spark, then), "2023-12-31")
    assert merged.first() == tracking.fold_base(events(spark, first + then)).first()


def link(name, status=None, family=None):
    return (name, family, status)


CASES = [
    ([link("ServiceRequestError")], True), ([link("ServiceResponseError")], True),
    *[([link("HttpResponseError", s)], True) for s in (500, 502, 503, 408, 429)],
    *[([link("HttpResponseError", s)], False) for s in (400, 403, 404, 409, None)],
    ([link("ResourceNotFoundError")], False),
    *[([link(n)], True) for n in failures.QUEUE_TRANSIENT],
    *[([link(n)], False) for n in failures.QUEUE_DETERMINISTIC],
    ([link("FutureQueueError", None, "queue")], True),
    *[([link(n)], True) for n in ("ConnectError", "ReadTimeout", "ConnectTimeout")],
    *[([link("HTTPStatusError", s)], True) for s in (500, 503, 429)],
    *[([link("HTTPStatusError", s)], False) for s in (404, 400)],
    *[([link(n)], False) for n in ("ValueError", "KeyError", "RuntimeError", "UploadError")],
    ([link("CommitContentionError"), link("HttpResponseError", 412)], True),
]


def test_classification_raw_and_wrapped(spark):
    rows = [(i, chain) for i, (chain, _) in enumerate(CASES)]
    rows += [(i + 1000, [link("UploadError"), *chain]) for i, (chain, _) in enumerate(CASES)]
    df = spark.createDataFrame(
        rows, "i int, chain array<struct<error_class:string,error_family:string,http_status:int>>"
    )
    got = {r.i: r.t for r in df.select("i", failures.is_transient(F.col("chain")).alias("t")).collect()}
    for i, (_, expected) in enumerate(CASES):
        assert got[i] is expected and got[i + 1000] is expected, CASES[i]


@pytest.mark.parametrize(
    "stage, transient, identified, expected",
    [
        ("config", True, False, (None, False, True, False)),
        ("parse", False, False, ("malformed_body", True, False, False)),
        ("work_item", False, False, ("validation_failure", True, False, False)),
        ("metadata", False, True, ("metadata_validation_failure", True, False, True)),
        ("envelope", False, True, ("envelope_validation_failure", True, False, True)),
        ("upload", True, True, ("dataset_failure", True, True, True)),
        ("upload", False, True, ("dataset_failure", True, False, True)),
        ("store_construction", True, False, ("dataset_failure", True, True, False)),
        ("dead_letter_send", False, False, (None, False, True, False)),
        ("dead_letter_send", False, True, (None, False, True, True)),
    ],
)
def test_disposition(spark, stage, transient, identified, expected):
    df = spark.createDataFrame([(stage, transient, identified)], "stage string, transient boolean, identified boolean")
    row = failures.route_failures(df).first()
    assert (row.error_type, row.dead_letter, row.redeliver, row.mark_failed) == expected


def test_profile_finds_gaps_across_spans(spark):
    step = timedelta(seconds=300)
    rows = [("even", T0 + i * step, 1.0) for i in range(6000)]
    rows += [("gap", T0 + i * step, 1.0) for i in range(6000) if i != 4096]
    rows += [("twice", T0, None), ("twice", T0, None), ("twice", None, 1.0)]
    rows += [("old", datetime(1969, 12, 31, 23, 59, 59) + i * step, 1.0) for i in range(3)]
    df = spark.createDataFrame(rows, "d string, ts timestamp, v double")
    got = {r.dataset: r for r in profile.profile_dataset(df, "d", "ts", ["ts", "v"]).collect()}
    assert not got["even"].time_continuity_suspected_gap
    assert got["even"].expected_records == got["even"].row_count == 6000
    assert got["gap"].time_continuity_suspected_gap
    assert (got["twice"].duplicate_rows, got["twice"].null_percentage) == (1, 0.5)
    assert got["twice"].notes == ["exact duplicate rows present"]
    assert (got["old"].expected_records, got["old"].time_continuity_suspected_gap) == (3, False)


def test_newlines_of_odd_bytes(spark):
    df = spark.createDataFrame(
        [(b"a\nb",), (b"",), (b"\n\n\xff\n",), ("é\r\n".encode(),)], "content binary"
    )
    assert [r.row_count for r in profile.profile_content(df).collect()] == [1, 0, 3, 1]


def test_site_outcomes(spark):
    sites = spark.createDataFrame([(1,), (2,), (3,), (4,)], "site_id bigint")
    status = spark.createDataFrame([(1, True), (2, True), (3, False), (4, True)], "site_id bigint, listing_ok boolean")
    listed = spark.createDataFrame([(1,), (1,), (4,)], "site_id bigint")
    changed = spark.createDataFrame([(1, None), (1, "d")], "site_id bigint, last_modified string")
    outcomes = metrics.site_outcomes(sites, status, listed, changed)
    assert sorted(map(tuple, outcomes.collect())) == [
        (1, "enqueued", 2, 1), (2, "empty", 0, 0), (3, "failed", 0, 0), (4, "unchanged", 1, 0)
    ]
    assert metrics.failed_sites(outcomes).first()[0] == [3]


def test_alert_above_ten_percent(spark):
    rows = [(T0 + timedelta(minutes=i), i >= 1) for i in range(10)]
    rows += [(T0 + timedelta(hours=1, minutes=i), i >= 2) for i in range(10)]
    df = spark.createDataFrame(rows, "ts timestamp, ok boolean")
    rates = metrics.failure_rate_windows(df, "ts", "ok").orderBy("window_start").collect()
    assert [(r.ratio, r.alert) for r in rates] == [(0.1, False), (0.2, True)]
