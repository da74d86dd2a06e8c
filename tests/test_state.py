"""Stream state, bounded history, ownership index, record store and folder listings."""

import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bronzeflow.catalog import adapters
from bronzeflow.operators import ownership, tracking
from bronzeflow.sinks import history, record_store
from bronzeflow.sinks.tables import subfolders
from bronzeflow.sources import folders
from bronzeflow.streaming import queue, state


def rows_of(df):
    return sorted(map(repr, df.collect()))


def filters(df):
    """The partition filters of the first scan of a plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("PartitionFilters: [")[1].split("]")[0]


def event(kind, minute, key="a", **values):
    return {"kind": kind, "ts": f"2024-01-01 {minute // 60:02d}:{minute % 60:02d}:00", "seq": 0, "partition_key": "p", "row_key": key, **values}


def frame(spark, events):
    schema = StructType.fromDDL(tracking.EVENT_SCHEMA)
    raw = spark.createDataFrame([{f.name: e.get(f.name) for f in schema} for e in events], StructType.fromDDL(tracking.EVENT_SCHEMA.replace("timestamp", "string")))
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


@pytest.fixture(scope="module")
def lifecycle(spark, sf_dir):
    return adapters.lifecycle_events(spark, sf_dir).to(StructType.fromDDL(tracking.EVENT_SCHEMA))


def tracked(spark, tmp_path, timing):
    stream = spark.readStream.schema(tracking.EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    with state.rocksdb(spark):
        queue.drain(state.track(stream, timing), str(tmp_path / "out"), str(tmp_path / "cp"))
    return spark.read.schema(state.UPDATE_SCHEMA).parquet(str(tmp_path / "out"))


@pytest.mark.parametrize("files", [1, 5])
def test_any_split_into_batches_gives_the_fold(spark, tmp_path, lifecycle, files):
    lifecycle.repartition(files, F.rand(files)).write.parquet(str(tmp_path / "in"))
    updates = tracked(spark, tmp_path, state.Timing("4000 days"))
    found = state.updated_rows(updates)
    assert found.filter("stuck").count() == 0
    want = tracking.fold_base(lifecycle)
    assert rows_of(found.select(*want.columns)) == rows_of(want)
    # A restart has nothing to repeat; new events go on from the state.
    before = updates.count()
    assert tracked(spark, tmp_path, state.Timing("4000 days")).count() == before
    more = frame(spark, [event("queued", 1, "new", s3_key="new")])
    more.write.mode("append").parquet(str(tmp_path / "in"))
    assert tracked(spark, tmp_path, state.Timing("4000 days")).count() == before + 1


def test_stuck_work_is_reported_and_ended_work_is_dropped(spark, tmp_path):
    timing = state.Timing("1 minute", stuck_after_hours=1, keep_hours=2)
    batches = [
        [event("queued", 0, "stuck", s3_key="s", size=3), event("queued", 0, "done", s3_key="d"), event("completed", 10, "done", completed_at="t")],
        [event("queued", 100, "x", s3_key="x")],
        [event("queued", 300, "x", s3_key="x")],
        [event("processing", 310, "stuck"), event("processing", 310, "done"), event("failed", 20, "late")],
    ]
    for batch in batches:
        frame(spark, batch).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        updates = tracked(spark, tmp_path, timing)
    rows = {r.row_key: r for r in state.updated_rows(updates).collect()}
    told = [(r.row_key, r.status, r.stuck) for r in updates.orderBy("status_at", "revision").collect() if r.row_key == "stuck"]
    assert told[:2] == [("stuck", "queued", False), ("stuck", "queued", True)]
    # Work that goes on keeps its columns; work whose state was dropped starts from nothing; late events are dropped.
    assert (rows["stuck"].status, rows["stuck"].s3_key, rows["stuck"].size, rows["stuck"].stuck) == ("processing", "s", 3, False)
    assert (rows["done"].status, rows["done"].s3_key, rows["done"].completed_at) == ("processing", None, None)
    assert "late" not in rows


def test_history_folds_to_the_same_rows_whatever_was_folded(spark, tmp_path, lifecycle):
    log = history.History(str(tmp_path), buckets=4, every=3)
    day = F.dayofmonth("ts")
    for batch in range(10):
        folded = history.fold(spark, log, batch)
        assert folded == (batch in (3, 6, 9))
        own = lifecycle.filter((day >= 3 * batch + 1) & (day <= (3 * batch + 3 if batch < 9 else 31)))
        history.append(own.filter("kind = 'queued'"), log, batch, 1)
        history.append(own.filter("kind <> 'queued'"), log, batch, 2)
        history.append(own.filter("kind <> 'queued'"), log, batch, 2)
    assert subfolders(spark, log.batches, "batch_id") == [9] and subfolders(spark, log.snapshots, "batch_id") == [8]
    for fold in (tracking.fold_base, tracking.fold_versions):
        assert rows_of(fold(history.read(spark, log))) == rows_of(fold(lifecycle))
    few = lifecycle.filter("s3_key IN ('k/1', 'k/2')").select("partition_key", "row_key")
    some = history.of_objects(spark, log, few.limit(1), 10)
    assert "bucket#" in filters(some)
    key = few.first().row_key
    assert rows_of(tracking.fold_versions(history.of_objects(spark, log, few.filter(F.col("row_key") == key), 10))) == rows_of(
        tracking.fold_versions(lifecycle.join(few.filter(F.col("row_key") == key).distinct(), ["partition_key", "row_key"], "left_semi"))
    )
    with pytest.raises(ValueError):
        history.read(spark, log, before=8)


def test_a_fold_that_ends_before_its_mark_counts_for_nothing(spark, tmp_path, lifecycle, monkeypatch):
    log = history.History(str(tmp_path), buckets=2, every=1)
    history.append(lifecycle, log, 0)

    def broken(*_):
        raise RuntimeError("ended midway")

    monkeypatch.setattr(history, "write_batch", broken)
    with pytest.raises(RuntimeError):
        history.fold(spark, log, 1)
    monkeypatch.undo()
    assert rows_of(tracking.fold_base(history.read(spark, log))) == rows_of(tracking.fold_base(lifecycle))
    assert history.fold(spark, log, 1) and history.covered(spark, log) == 0
    assert rows_of(tracking.fold_base(history.read(spark, log))) == rows_of(tracking.fold_base(lifecycle))


def test_ownership_index_finds_owners_and_little_else(spark, tmp_path):
    index = ownership.Index(str(tmp_path), words=4096, buckets=4)
    paths = lambda lead, n: [(f"{lead}/{i}", f"key-{lead}-{i}") for i in range(n)]
    schema = "storage_path string, s3_key string"
    held = spark.createDataFrame([*paths("a", 3000), ("blank", ""), ("none", None), (None, "k")], schema)
    ownership.write_owners(held, index, "2024-01-01", 0)
    ownership.write_owners(spark.createDataFrame(paths("b", 10), schema), index, "2024-01-01", 1)
    ownership.write_owners(spark.createDataFrame(paths("c", 10), schema), index, "2024-01-02", 2)
    asked = spark.createDataFrame([*paths("a", 20), *paths("b", 2), *paths("c", 1), *paths("x", 5000), ("blank", "k"), ("none", "k")], schema)
    found = {r.storage_path: r.s3_key for r in ownership.owners_of(asked, spark, index, "2024-01-01", 1).collect()}
    assert found == dict(paths("a", 20))
    hits = ownership.maybe_owned(asked, spark, index, "2024-01-01", 9).count()
    assert 22 <= hits < 22 + 150
    # Paths that no filter word fits open no owner file at all.
    fresh = spark.createDataFrame(paths("fresh", 3), schema)
    none = ownership.owners_of(fresh, spark, index, "2024-01-03", 5)
    assert none.count() == 0 and "owners" not in none._jdf.queryExecution().executedPlan().toString()


def test_record_store_reads_days_folds_and_purges(spark, tmp_path):
    store = record_store.RecordStore(str(tmp_path), ttl_days=2)
    rng = random.Random(1)
    keys = [(f"2024-01-0{d}", f"{d}-{i}", "c", "t") for d in (1, 2, 3) for i in range(20)]
    schema = "partition_date string, record_key string, correlation_id string, created_at string"
    frame = spark.createDataFrame(keys, schema)
    done = spark.createDataFrame([k for k in keys if rng.random() < 0.5], schema)
    record_store.add(frame, store, record_store.PENDING, 0)
    record_store.add(done, store, record_store.PENDING, 1)
    record_store.add(done, store, record_store.COMPLETED, 1)
    days = record_store.read_days(spark, store, ["2024-01-02"])
    assert "(partition_date#" in filters(days)
    state_of = lambda: rows_of(record_store.read_days(spark, store).groupBy("partition_date", "record_key").agg(F.min("status")))
    before = state_of()
    record_store.compact(spark, store, "2024-01-02", 1)
    assert state_of() == before
    assert subfolders(spark, f"{store.root}/partition_date=2024-01-02", "batch_id") == [1]
    assert record_store.read_days(spark, store, ["2024-01-02"]).count() == 20
    assert record_store.read_days(spark, store, ["2024-01-01"], without=1).filter("status = 'completed'").count() == 0
    assert record_store.purge(spark, store, "2024-01-04T10:00:00+00:00") == ["2024-01-01"]
    assert record_store.days_of(record_store.read_days(spark, store)) == ["2024-01-02", "2024-01-03"]
    with pytest.raises(ValueError):
        record_store.RecordStore("x", 0)


def test_listings_at_any_depth_are_the_files(spark, tmp_path):
    want = {}
    for name, size in {"top.csv": 0, "a/x.csv": 3, "a/b/y.csv": 0, "a/b/c/z é%+.csv": 5, "k=_1/p.csv": 1, "a/skip.txt": 1, "_temporary/q.csv": 1, "a/.hid.csv": 1}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x" * size)
        if name.endswith(".csv") and "_temp" not in name and ".hid" not in name:
            want[f"file:{tmp_path}/{name}"] = size
    for depth in range(4):
        rows = folders.list_folder(spark, str(tmp_path), depth=depth).collect()
        assert {r.key: r["size"] for r in rows} == want and len(rows) == len(want)
        assert all(r.last_modified.endswith("+00:00") for r in rows)
    assert folders.list_folder(spark, str(tmp_path / "absent")).count() == 0


def test_new_objects_come_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()

    def drain():
        queue.drain(folders.new_objects(spark, str(source), "*.csv", settle=0.2), str(tmp_path / "out"), str(tmp_path / "cp"))
        return sorted(r.path.rsplit("/", 1)[1] for r in spark.read.schema(folders.SCHEMA).parquet(str(tmp_path / "out")).collect())

    (source / "a.csv").write_bytes(b"1")
    (source / "b.csv").write_bytes(b"")
    time.sleep(0.5)
    assert drain() == ["a.csv", "b.csv"]
    (source / "c.csv").write_bytes(b"3")
    time.sleep(0.5)
    assert drain() == drain() == ["a.csv", "b.csv", "c.csv"]


class _Counted:
    """State and timers of one key, with the calls they took."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), []

    def __getattr__(self, name):
        def call(*args):
            self.calls.append(name)
            if name == "get":
                return self.value
            if name == "update":
                self.value = args[0]
            elif name == "clear":
                self.value = None
            elif name == "registerTimer":
                self.timers.add(args[0])
            elif name == "deleteTimer":
                self.timers.discard(args[0])

        return call


class _Watermark:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    getExpiryTimeInMs = getCurrentWatermarkInMs


def _event(at, status):
    return {"queued_at": at, "queued_seq": 0, "queued": "{}", "status_at": at, "status_seq": 0, "status": status, "done_at": at, "done_seq": 0, "completed_at": None}


def test_a_change_sets_no_timer_while_an_earlier_one_stands():
    kept = _Counted()
    tracked = state._Tracked(stuck_ms=100, keep_ms=1000)
    tracked.handle = tracked.held = kept
    rows = lambda at, status: list(tracked.handleInputRows(("p", "r"), [_event(at * 1000, status)], None))
    expire = lambda at, mark: list(tracked.handleExpiredTimer(("p", "r"), _Watermark(mark), _Watermark(at)))
    rows(10, "queued")
    kept.calls.clear()
    assert rows(50, "processing")[0].revision == 2
    assert kept.calls == ["get", "update"] and kept.timers == {110}
    # The earlier timer is put off to the time of the last change, which then counts.
    kept.timers.discard(110)
    assert expire(110, 120) == [] and kept.timers == {150}
    kept.timers.discard(150)
    assert expire(150, 150)[0].stuck and kept.timers == set()
    # Ended work is kept longer; work that is opened again is due before that.
    rows(200, "completed")
    assert kept.timers == {1200}
    rows(300, "queued")
    assert kept.timers == {400}
    # A timer that comes late counts at once if the work is due as well.
    rows(350, "processing")
    kept.timers.discard(400)
    assert expire(400, 460)[0].stuck


def test_a_task_folds_events_of_several_frames_at_once():
    frames = [
        pd.DataFrame({"partition_key": "p", "row_key": "r", "at": [at], "seq": [0], "resets": [True], "ends": [True], "queued": [str(at)], "status": ["queued"], "completed_at": [None]})
        for at in (3, 1, 2)
    ]
    folded = list(state._folded(iter(frames)))
    assert [len(f) for f in folded] == [1]
    assert folded[0][["status_at", "queued", "done_at"]].values.tolist() == [[3, "3", 3]]
